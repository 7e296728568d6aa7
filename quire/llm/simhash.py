"""SimHash near-duplicates: pigeonhole blocks over 64-bit fingerprints.

Fingerprints of all documents come from one pass over the texts.  Two
fingerprints at most ``max_bits`` apart agree on at least two of
``max_bits + 2`` blocks, so every fingerprint is dealt out once per pair of
blocks (key = the bits of the two blocks) and each group of equal keys is
searched for links with an exact Hamming check.  Work is on *distinct*
fingerprints, so a text copied a million times is one row here.

Hot groups: a group only emits the edges of a spanning forest (never its
pairs), and a group of more than ``GROUP`` distinct fingerprints is dealt out
again on finer blocks of its free bits; those sub-groups hold at most
``2 ** FREE_BITS`` distinct fingerprints by construction.  No link is lost.

Defined results: a null text counts as empty; no words give fingerprint 0,
linked like any other; repeated rows are returned once per row; null ids take
part, and never name a component unless the component has no other id.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
from pyspark.sql import DataFrame, functions as F

from quire.llm.base import payloads, stash, word_pieces
from quire.operators.dedupe import components

SEED = 42
GROUP = 8192          # distinct fingerprints searched in one go
FREE_BITS = 15        # free bits of a second-level group
FLUSH = 1 << 19       # shingle hashes counted together

# byte -> its 8 bits, one per byte lane of a 64-bit word
_LANES = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], dtype=np.uint64)


def shingle_hashes(text: bytes, k: int):
    """Arrays of unsigned XXH64 of the k-word shingles of a lower-cased text,
    repeats included; fewer than k words give one shingle, none give none."""
    import xxhash
    h = xxhash.xxh64_intdigest
    carry: list = []
    seen = 0
    for words in word_pieces(text):
        words = carry + words
        n = len(words) - k + 1
        if n > 0:
            seen += n
            grams = map(b" ".join, zip(*(words[i:] for i in range(k))))
            yield np.fromiter(map(h, grams, repeat(SEED)), dtype=np.uint64, count=n)
            words = words[n:]
        carry = words
    if not seen and carry:
        yield np.array([h(b" ".join(carry), SEED)], dtype=np.uint64)


def _bit_counts(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per segment (``sizes`` > 0, back to back) the number of hashes with
    each of the 64 bits set."""
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    # cut segments into runs of at most 255 rows: byte lanes cannot overflow
    runs = -(-sizes // 255)
    owner = np.repeat(np.arange(len(sizes)), runs)
    first = np.concatenate(([0], np.cumsum(runs)[:-1]))
    cut = starts[owner] + (np.arange(len(owner)) - first[owner]) * 255
    by = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    out = np.empty((len(sizes), 64), dtype=np.int64)
    for j in range(8):
        lanes = np.add.reduceat(_LANES[by[:, j]], cut).astype("<u8").view(np.uint8).reshape(-1, 8)
        out[:, 8 * j:8 * j + 8] = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
    return out


def majority(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Bit set where more than half of the ``n`` hashes have it."""
    bits = (counts * 2 > n[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def text_fingerprints(texts: list, k: int) -> np.ndarray:
    """Fingerprints (uint64) of a list of bytes / None; memory is bounded by
    ``FLUSH`` hashes plus one text."""
    total = np.zeros((len(texts), 64), dtype=np.int64)
    n = np.zeros(len(texts), dtype=np.int64)
    parts, sizes, owners, held = [], [], [], 0

    def flush():
        nonlocal held
        if parts:
            c = _bit_counts(np.concatenate(parts), np.array(sizes))
            np.add.at(total, owners, c)
            parts.clear(), sizes.clear(), owners.clear()
            held = 0

    for i, t in enumerate(texts):
        for h in shingle_hashes(t or b"", k):
            parts.append(h), sizes.append(len(h)), owners.append(i)
            n[i] += len(h)
            held += len(h)
            if held >= FLUSH:
                flush()
    flush()
    return majority(total, n)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                 row: str | None = None) -> DataFrame:
    """``key, fp bigint`` (the unsigned fingerprint's bits) for every row;
    with ``row``, a bigint column, ``key, row, fp``."""
    import pyarrow as pa
    names = [key] if row is None else [key, row]

    def run(batches):
        for b in batches:
            fp = text_fingerprints(payloads(b.column(len(names))), shingle)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp.view(np.int64))], names=[*names, "fp"])

    src = docs.select(*[F.col(c).cast("bigint").alias(c) for c in names], F.col(text).cast("string").alias("_t"))
    return src.mapInArrow(run, ", ".join(f"`{c}` bigint" for c in [*names, "fp"]))


def split_bits(bits: list, n: int) -> list:
    """Cut a list of bit positions into ``n`` runs of nearly equal length,
    as 64-bit masks."""
    return [sum(1 << int(b) for b in part) for part in np.array_split(np.array(bits), n)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def first_masks(max_bits: int) -> list:
    blocks = split_bits(list(range(64)), max_bits + 2)
    return [a | b for a, b in combinations(blocks, 2)]


def second_masks(mask: int, max_bits: int) -> list:
    """Finer keys inside a group that agrees on ``mask``."""
    free = [b for b in range(64) if not mask >> b & 1]
    n = max_bits + 1
    while n < len(free) and max_bits * -(-len(free) // n) > FREE_BITS:
        n += 1
    blocks = split_bits(free, n)
    return [mask | sum(c) for c in combinations(blocks, n - max_bits)]


def _forest(fp: np.ndarray, max_bits: int):
    """Edges of a spanning forest of the links among distinct ``fp``."""
    rest = fp
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= max_bits
            if near.any():
                for y in rest[near]:
                    queue.append(y)
                    yield x, y
                rest = rest[~near]


def _links(max_bits: int, limit: int):
    """Partition function over rows (t, key, fp) sorted by (t, key): groups of
    up to ``limit`` rows give forest edges (a, b, null); larger ones are
    passed on as (null, fp, t)."""
    import pyarrow as pa

    def emit(a, b, t):
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(t, pa.int32())], names=["a", "b", "t"])

    def run(batches):
        held: list = []                # fp arrays of the open group
        size, open_key, deferred = 0, None, False
        ea: list = []
        eb: list = []

        def close():
            nonlocal held, size
            if not deferred and size > 1:
                fp = np.concatenate(held).view(np.uint64)
                for x, y in _forest(fp, max_bits):
                    ea.append(int(x.view(np.int64))), eb.append(int(y.view(np.int64)))
            held, size = [], 0

        for b in batches:
            t, k, fp = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(t):
                continue
            cut = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1
            edges = np.concatenate(([0], cut, [len(t)]))
            first = (int(t[0]), int(k[0]))
            # single-row groups inside the batch need no work at all
            width = np.diff(edges)
            todo = np.flatnonzero((width > 1) | (np.arange(len(width)) == 0) | (np.arange(len(width)) == len(width) - 1))
            for g in todo:
                s, e = edges[g], edges[g + 1]
                this = first if g == 0 else (int(t[s]), int(k[s]))
                if this != open_key:
                    close()
                    open_key, deferred = this, False
                size += e - s
                if not deferred and size > limit:
                    deferred = True
                    for h in held:
                        yield emit([None] * len(h), h, [this[0]] * len(h))
                    held = []
                if deferred:
                    yield emit([None] * (e - s), fp[s:e], [this[0]] * (e - s))
                else:
                    held.append(fp[s:e])
            if len(ea) > 50_000:
                yield emit(ea, eb, [None] * len(ea))
                ea, eb = [], []
        close()
        if ea:
            yield emit(ea, eb, [None] * len(ea))

    return run


def _dealt(rows: DataFrame, max_bits: int, limit: int) -> DataFrame:
    part = rows.repartition("t", "key").sortWithinPartitions("t", "key")
    return part.select("t", "key", "fp").mapInArrow(_links(max_bits, limit), "a bigint, b bigint, t int")


def links(fps: DataFrame, max_bits: int = 3, group: int = GROUP) -> DataFrame:
    """``a, b`` — edges of spanning forests whose union connects exactly the
    distinct fingerprints reachable over links of ``max_bits`` or fewer."""
    masks = first_masks(max_bits)
    keyed = F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("bigint")).alias("key"))
        for i, m in enumerate(masks)]))
    rows = fps.select("fp", keyed.alias("_k")).select("_k.t", "_k.key", "fp")
    got = stash(_dealt(rows, max_bits, group), "links")
    edges = got.where("a is not null").select("a", "b")
    hot = got.where("a is null").select("t", F.col("b").alias("fp"))
    if hot.limit(1).count():
        finer = [second_masks(m, max_bits) for m in masks]
        # masks per first-level key, as a literal table (bounded by max_bits)
        arr = F.array(*[F.array(*[F.lit(_signed(x)).cast("bigint") for x in f]) for f in finer])
        x = hot.select("t", "fp", F.posexplode(F.element_at(arr, F.col("t") + 1)).alias("u", "m"))
        x = x.select((F.col("t") * F.lit(len(finer[0])) + F.col("u")).cast("int").alias("t"),
                     F.col("fp").bitwiseAND(F.col("m")).alias("key"), "fp")
        more = _dealt(x, max_bits, max(1 << FREE_BITS, group)).select("a", "b")
        edges = stash(edges.unionByName(more), "links2")
    return edges.distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 3, group: int = GROUP, row: str | None = None) -> DataFrame:
    """``doc_id, fp bigint, component_id`` — one row per row of ``docs``;
    ``component_id`` is the smallest id of the connected component.

    Rows of one id can lie in several components.  With ``row``, a bigint
    column that tells them apart, the result is ``doc_id, row, fp,
    component_id, component_row``: the smallest (id, row) of the component,
    null ids last, which no other component has."""
    marked = stash(fingerprints(docs, key, text, shingle, row), "simhash")
    first = F.col(key) if row is None else F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col(row).alias("row"))
    fps = stash(marked.groupBy("fp").agg(F.min(first).alias("_first")), "fps")
    edges = stash(links(fps.select("fp"), max_bits, group), "edges")
    lab = components(edges)                      # node, label: linked fingerprints only
    linked = fps.join(lab.select(F.col("node").alias("fp"), "label"), "fp")
    ids = linked.groupBy("label").agg(F.min("_first").alias("_c"))
    linked = linked.select("fp", "label").join(ids, "label").select("fp", "_c")
    # stored, so that the join below reads two plain exchanges and Spark can
    # split the partition of a fingerprint that very many rows share
    of = stash(fps.join(linked, "fp", "left").select("fp", F.coalesce("_c", "_first").alias("component_id")), "component")
    if row is None:
        return marked.join(of, "fp").select(key, "fp", "component_id")
    return marked.join(of, "fp").select(key, row, "fp", F.col("component_id.id").alias("component_id"),
                                        F.col("component_id.row").alias("component_row"))


def op6_simhash_near_dup(spark, sf_dir: str) -> DataFrame:
    from quire.llm.base import table
    d = near_duplicates(table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
