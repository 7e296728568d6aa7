"""Deduplication: exact (F1), near-duplicate by MinHash LSH (F2), exact
similarity join (F3) and duplicate clusters to survivors (F4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quire.functions.text import content_hash, py_strip
from quire.session import fits, materialize


BROADCAST_COPIES = 500_000
BROADCAST_ENDS = 2_000_000


def first_rows(x: DataFrame, order: str, by: list) -> DataFrame:
    """The rows of ``x`` that come first in ``order`` among equal ``by``.

    Only the narrow key columns are aggregated (hash aggregation, combined
    map-side: a text copied into a third of all rows costs one row per task);
    the values that occur more than once then meet the rows again, broadcast
    behind a size check, else in a shuffle join.  ``order`` is unique.
    """
    again = (x.groupBy(*by).agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > 1).drop("_n"))
    again = materialize(again)
    side = F.broadcast(again) if fits(again, BROADCAST_COPIES) else again
    return x.join(side, by, "left").where(F.col("_first").isNull() | (F.col("_first") == F.col(order))).drop("_first")


def exact_dedupe(df: DataFrame, text: str = "text", order: str = "doc_id", group=None,
                 strip: bool = True, hash_col: str | None = None) -> DataFrame:
    """keep the first row (in ``order``) of every distinct stripped text;
    blank texts are dropped, as in the source."""
    group = [group] if isinstance(group, str) else list(group or [])
    x = df.withColumn(text, py_strip(text)) if strip else df
    x = x.where(F.col(text) != F.lit("")).withColumn("_h", content_hash(text))
    out = first_rows(x, order, [*group, "_h"])
    out = out.select(*group, "_h", *[c for c in x.columns if c not in ("_h", *group)])
    return out.withColumnRenamed("_h", hash_col) if hash_col else out.drop("_h")


# --------------------------------------------------------------------------
# Near duplicates (F2-F4).  Work happens on *distinct* texts: exact copies
# are folded into one representative first, so a text copied a billion times
# is one row here and never yields pairs among its copies.
# --------------------------------------------------------------------------
from quire.functions.text import ws_tokens  # noqa: E402


def shingles(text_col, k: int = 3):
    """Distinct lower-cased word k-grams as strings; a text with fewer than
    k words is one shingle (itself), an empty text has none.  (Reference
    form; the join paths use :func:`shingle_hashes`.)"""
    toks = ws_tokens(F.lower(text_col))
    n = F.size(toks)
    z = F.arrays_zip(*[F.slice(toks, j + 1, F.greatest(n, F.lit(1))) for j in range(k)])
    grams = F.transform(F.filter(z, lambda e: e[str(k - 1)].isNotNull()),
                        lambda e: F.concat_ws(" ", *[e[str(j)] for j in range(k)]))
    return F.array_distinct(F.when(n == 0, F.array().cast("array<string>"))
                             .when(n < k, F.array(F.array_join(toks, " ")))
                             .otherwise(grams))


def token_hashes(text_col):
    """xxhash64 of every lower-cased whitespace token."""
    return F.transform(ws_tokens(F.lower(text_col)), lambda t: F.xxhash64(t))


def shingle_hashes(h, k: int = 3):
    """The shingle sets of :func:`shingles` as 64-bit hashes, from a column
    ``h`` of token hashes: a shingle is the hash of its k token hashes
    (zipped shifted slices; no shingle string is built).  A text of fewer
    than k words is one shingle, the hash of its token hashes."""
    n = F.size(h)
    z = F.arrays_zip(*[F.slice(h, j + 1, F.greatest(n, F.lit(1))) for j in range(k)])
    grams = F.transform(F.filter(z, lambda e: e[str(k - 1)].isNotNull()),
                        lambda e: F.xxhash64(*[e[str(j)] for j in range(k)]))
    return F.array_distinct(F.when(n == 0, F.array().cast("array<bigint>"))
                             .when(n < k, F.array(F.xxhash64(h)))
                             .otherwise(grams))


def representatives(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``rep, text``: one row per distinct stripped text, named by its first
    ``key``."""
    x = exact_dedupe(df.select(F.col(key).alias("rep"), F.col(text).alias("text")), order="rep")
    return x.select("rep", "text")


def shingle_sets(reps: DataFrame, k: int = 3) -> DataFrame:
    """``rep, s array<bigint>`` (distinct shingle hashes), checkpointed."""
    return materialize(_sets(reps, k))


def _sets(reps: DataFrame, k: int) -> DataFrame:
    # two projections: the token-hash array is built once, then read by the
    # shingle expression several times (Catalyst keeps an expensive
    # expression that is used more than once in its own projection)
    h = reps.select("rep", token_hashes(F.col("text")).alias("_h"))
    return h.select("rep", shingle_hashes(F.col("_h"), k).alias("s"))


def shingle_table(sets: DataFrame) -> DataFrame:
    """``rep, sh`` — one row per (document, distinct shingle)."""
    return sets.select("rep", F.explode("s").alias("sh"))


SHARED_BITS = 29               # bits of the hashes that the bitmap of shared shingles tells apart at most: 64 MiB
PIECE = 4 << 20                # shingles of a task, and of a part of the hash range, that are sorted together


def maybe_shared(sets: DataFrame, total: int) -> DataFrame:
    """``rep, _n, s``: the sets with their sizes, without most shingles of one set only.

    Tasks sort the leading bits of their shingles' hashes and send four bytes for each
    to its part of the hash range (eight for what they saw in several sets); what
    comes to a part twice sets a bit in a bitmap of at most ``SHARED_BITS``, which all
    tasks then ask.  A shingle of several sets always stays; one that shares its bit
    with such a one stays too, more of them the more shared shingles there are.
    ``total``: about how many shingles there are."""
    import numpy as np
    import pyarrow as pa
    spark = sets.sparkSession
    bits = min(SHARED_BITS, max(16, total.bit_length() + 2))
    parts = min(bits - 3, max(6, (total // PIECE).bit_length()))           # as a power of two
    limit = PIECE

    def leading(batches):
        held, n = [], 0

        def pieces():
            h = np.sort(np.concatenate(held))
            first = np.concatenate(([True], h[1:] != h[:-1]))
            second = ~first & np.concatenate(([True], first[:-1]))         # of a run, two are enough
            h = h[first | second]
            ends = np.searchsorted(h, np.arange(1 << parts, dtype=np.uint64) << np.uint64(64 - parts)).tolist() + [len(h)]
            low = (h >> np.uint64(32 - parts)).astype("<u4")
            got = [(i, low[a:b].tobytes()) for i, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
            return pa.RecordBatch.from_arrays([pa.array([i for i, _ in got], pa.int32()), pa.array([v for _, v in got], pa.binary())], names=["_part", "_low"])

        for b in batches:
            held.append(b.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64))
            n += len(held[-1])
            if n >= limit:
                yield pieces()
                held, n = [], 0
        if n:
            yield pieces()

    def marked(part):
        low = np.sort(np.concatenate([np.frombuffer(v, "<u4") for v in part.column("_low").to_pylist()]))
        twice = low[1:][low[1:] == low[:-1]] >> np.uint32(32 - (bits - parts))
        found = np.zeros(1 << (bits - parts), bool)
        found[twice] = True
        return pa.table({"_part": part.column("_part")[:1], "_bits": pa.array([np.packbits(found, bitorder="little").tobytes()], pa.binary())})

    low = sets.select("s").mapInArrow(leading, "_part int, _low binary")
    found = low.groupBy("_part").applyInArrow(marked, "_part int, _bits binary").collect()     # 64 MiB at most
    table = bytearray(1 << (bits - 3))
    for r in found:
        table[r["_part"] << (bits - parts - 3):(r["_part"] + 1) << (bits - parts - 3)] = r["_bits"]
    shared = spark.sparkContext.broadcast(bytes(table))

    def kept(batches):
        known = np.frombuffer(shared.value, np.uint8)
        for b in batches:
            s = b.column(1)
            n = s.value_lengths().to_numpy(zero_copy_only=False)
            v = s.flatten().to_numpy(zero_copy_only=False)
            at = v.view(np.uint64) >> np.uint64(64 - bits)
            hit = ((known[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
            ends = np.concatenate(([0], np.cumsum(hit)))[np.concatenate(([0], np.cumsum(n)))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()),
                                              pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v[hit], pa.int64()))], names=["rep", "_n", "s"])

    return sets.mapInArrow(kept, f"rep {dict(sets.dtypes)['rep']}, _n bigint, s array<bigint>")


# products of set sizes and thresholds are not exact in doubles; the filters
# allow for it, the verification decides
SLACK = 1e-6


def similar_pairs(df: DataFrame, threshold: float = 0.8, text: str = "text", key: str = "doc_id",
                  k: int = 3, reps: DataFrame | None = None) -> DataFrame:
    """every pair of distinct texts whose shingle-set Jaccard is at
    least ``threshold``: ``a < b`` (representative ids), ``inter``, ``uni``.

    Prefix filtering: order each set by shingle rarity and index only its
    first ``|A| - ceil(t |A|) + 1`` shingles — two sets reaching ``t`` must
    share one of them — then verify candidates exactly.  No recall loss.
    Shingles of one set only come first in that order and meet nothing, so only
    the others go on: a set with fewer than ``ceil(t |A|)`` of them has no partner.
    Most of them go before any shuffle (:func:`maybe_shared`), and the sets are built
    anew for the texts that have a candidate instead of being kept on disk.
    """
    t = F.lit(float(threshold))
    reps = reps if reps is not None else representatives(df, text, key)
    size = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("b")).first()["b"]
    some = materialize(maybe_shared(_sets(reps, k), size // 6))
    able = some.groupBy("rep").agg(F.sum("_n").alias("_n"), F.sum(F.size("s")).alias("_k"))
    able = able.where(F.col("_k") >= F.ceil(F.col("_n") * t - F.lit(SLACK))).select("rep", "_n")
    able = F.broadcast(able) if fits(able, BROADCAST_ENDS) else able
    sh = shingle_table(some.join(able.select("rep"), "rep", "left_semi"))
    often = sh.groupBy("sh").agg(F.count(F.lit(1)).alias("_df")).where("_df > 1")
    x = sh.join(often, "sh").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("_df", "sh"))).alias("_s"))
    x = x.join(able, "rep")
    x = x.withColumn("_p", (F.size("_s") - F.ceil(F.col("_n") * t - F.lit(SLACK)) + 1).cast("int")).where("_p > 0")
    pref = materialize(x.select("rep", "_n", F.explode(F.slice("_s.sh", F.lit(1), F.col("_p"))).alias("sh")))
    a, b = pref.alias("a"), pref.alias("b")
    cand = (a.join(b, "sh")
             .where(F.col("a.rep") < F.col("b.rep"))
             .where((F.col("a._n") >= F.col("b._n") * t - F.lit(SLACK))
                    & (F.col("b._n") >= F.col("a._n") * t - F.lit(SLACK)))
             .select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b"))
             .distinct())
    cand = materialize(cand)
    ends = cand.select(F.col("a").alias("rep")).unionByName(cand.select(F.col("b").alias("rep"))).distinct()
    ends = F.broadcast(ends) if fits(ends, BROADCAST_ENDS) else ends
    return _verify(cand, shingle_sets(reps.join(ends, "rep", "left_semi"), k), threshold)


def _verify(cand: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    sa = sets.select(F.col("rep").alias("a"), F.col("s").alias("_sa"))
    sb = sets.select(F.col("rep").alias("b"), F.col("s").alias("_sb"))
    v = cand.join(sa, "a").join(sb, "b")
    inter = F.size(F.array_intersect("_sa", "_sb")).cast("bigint")
    v = v.select("a", "b", inter.alias("inter"), F.size("_sa").alias("_na"), F.size("_sb").alias("_nb"))
    v = v.withColumn("uni", (F.col("_na") + F.col("_nb") - F.col("inter")).cast("bigint"))
    return v.where(F.col("inter") / F.col("uni") >= F.lit(float(threshold))).select("a", "b", "inter", "uni")


BUCKET = ["_band", "_key"]
HEADS = 256                    # members of a bucket a round compares with all others at most
HEAD_PAIRS = 40_000            # pairs of a bucket a round may take whether they are needed or not
PRIME = (1 << 31) - 1          # shingle hashes of the signatures are residues


def signature_factors(k: int) -> list[int]:
    """Multiplier of each word of a shingle (powers of a primitive root)."""
    return [pow(48271, j + 1, PRIME) for j in range(k)]


def residues(c, k: int = 3):
    """Sorted distinct 31-bit shingle hashes from a column ``c`` of the words'
    CRC-32: a shingle is an affine sum of its words' residues.  A text of fewer
    than k words is one shingle."""
    n = F.size(c)
    z = F.arrays_zip(*[F.slice(c, j + 1, F.greatest(n, F.lit(1))) for j in range(k)])

    def affine(e):
        parts = [F.coalesce(e[str(j)], F.lit(0)) % PRIME * F.lit(a) % PRIME for j, a in enumerate(signature_factors(k))]
        return sum(parts[1:], parts[0]) % PRIME

    grams = F.transform(F.filter(z, lambda e: e[str(k - 1)].isNotNull()), affine)
    return F.array_sort(F.array_distinct(F.when(n == 0, F.array().cast("array<bigint>"))
                                          .when(n < k, F.transform(F.slice(z, 1, 1), affine)).otherwise(grams)))


def signatures(reps: DataFrame, k: int, bins: int) -> DataFrame:
    """``rep, sig array<bigint>``: one-permutation min-hash, null for a text
    without a shingle.  The range of the hash is cut into ``bins`` equal parts; a
    part holds its smallest hash, an empty one borrows that of the next part
    that has any (the last ones from the first).  One hash per shingle, whatever
    the number of bins."""
    width = -(-PRIME // bins)
    # every array is a projection of its own: built once, read several times; no
    # filter on them, which would build them once more below
    x = reps.select("rep", F.transform(ws_tokens(F.lower("text")), lambda t: F.crc32(t)).alias("_c"))
    x = x.select("rep", residues(F.col("_c"), k).alias("_v"))
    v, m = F.col("_v"), F.col("_m")
    x = x.select("rep", F.filter(v, lambda h, i: (i == 0) | (F.floor(h / width) != F.floor(F.get(v, i - 1) / width))).alias("_m"))
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(bins.bit_length()))])

    def at_or_after(j):                                   # minima below bin j: binary search
        low = F.aggregate(steps, F.lit(0), lambda at, s: F.when(
            (at + s <= F.size(m)) & (F.get(m, at + s - 1) < j * F.lit(width)), at + s).otherwise(at))
        return F.coalesce(F.get(m, low), F.get(m, F.lit(0)))

    every = F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))
    return x.select("rep", F.when(F.size(m) > 0, F.transform(every, at_or_after)).alias("sig"))


def minhash_edges(df: DataFrame, threshold: float = 0.8, text: str = "text", key: str = "doc_id",
                  k: int = 3, bands: int = 20, rows: int = 6,
                  reps: DataFrame | None = None) -> DataFrame:
    """MinHash LSH over one-permutation signatures of ``bands x rows``
    bins; band ``b`` reads the bins ``b, b + bands, ...``, so that bins that
    borrow from one another fall into different bands.  Each band bucket links
    its members to the bucket's smallest id, verified exactly; members that
    are not like it stay and are linked to the smallest of those that remain,
    until every bucket is settled.  A bucket costs its size times the number
    of unlike texts in it, never its square for near copies: a round tries the
    first members of a bucket as such heads, four times as many as were heads in
    the round before, or as many as give ``HEAD_PAIRS`` pairs (``HEADS`` at most),
    and keeps those that are like no earlier head.
    Shingle sets are built for the members of shared buckets only and read for
    pairs whose sizes allow the threshold.  Output ``a < b, inter, uni``
    like :func:`similar_pairs`: the same clusters with high probability, not
    every pair inside a cluster."""
    reps = reps if reps is not None else materialize(representatives(df, text, key))
    x = signatures(reps, k, bands * rows)
    bk = F.array(*[F.xxhash64(*[F.get("sig", F.lit(b + bands * i)) for i in range(rows)]) for b in range(bands)])
    x = materialize(x.select("rep", F.posexplode(F.when(F.col("sig").isNotNull(), bk)).alias("_band", "_key")))
    # only keys that occur twice can give a candidate
    n = x.groupBy("_band", "_key").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").drop("_c")
    x = materialize(x.join(n, ["_band", "_key"], "left_semi"))
    sets = shingle_sets(reps.join(x.select("rep").distinct(), "rep", "left_semi"), k)
    x = materialize(x.join(sets.select("rep", F.size("s").alias("_n")), "rep").withColumn("_try", F.lit(1)))
    like = links = None
    while x.limit(1).count():
        heads, hits, like = _tried_heads(x, sets, like, threshold)
        # a tried head that is like an earlier head is none; pairs of them come
        # in the order of the later one, when the earlier one is settled
        among = hits.join(heads.select(*BUCKET, F.col("_head").alias("rep"), F.col("_i").alias("_j")), [*BUCKET, "rep"])
        none = among.groupBy(*BUCKET).agg(F.array_sort(F.collect_list(F.struct("_j", "_i"))).alias("_p"))
        none = none.select(*BUCKET, F.aggregate("_p", F.array().cast("array<int>"), lambda no, p: F.when(
            F.array_contains(no, p["_i"]) | F.array_contains(no, p["_j"]), no).otherwise(F.array_append(no, p["_j"]))).alias("_none"))
        heads = materialize(heads.join(none, BUCKET, "left"))
        # every other member is linked to the first head that it is like
        real = heads.where(F.col("_none").isNull() | ~F.array_contains("_none", F.col("_i"))).select(*BUCKET, "_head")
        first = materialize(hits.join(real, [*BUCKET, "_head"]).groupBy(*BUCKET, "rep").agg(F.min("_head").alias("_head")))
        new = first.select(F.col("_head").alias("a"), F.col("rep").alias("b"))
        links = new if links is None else links.unionByName(new)
        tried = heads.groupBy(*BUCKET).agg((4 * (F.max("_i") - F.max(F.coalesce(F.size("_none"), F.lit(0))))).alias("_try"))
        gone = first.select(*BUCKET, "rep").unionByName(heads.select(*BUCKET, F.col("_head").alias("rep")))
        x = materialize(x.drop("_try").join(gone, [*BUCKET, "rep"], "left_anti").join(tried, BUCKET).select(*x.columns))
    if like is None:
        return _verify(x.select(F.col("rep").alias("a"), F.col("rep").alias("b")), sets, threshold)
    return like.join(links, ["a", "b"], "left_semi")


def _tried_heads(x: DataFrame, sets: DataFrame, like: DataFrame | None, threshold: float):
    """One round of :func:`minhash_edges`: the first ``_try`` members of each
    bucket (``_head``, numbered ``_i``), the later members that are like them
    (``hits``), and all pairs found to be alike up to now."""
    t = F.lit(float(threshold))
    w = Window.partitionBy(*BUCKET).orderBy("rep")
    heads = x.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= HEADS)
    if like is not None:                                  # copies of the first head have left
        room = x.groupBy(*BUCKET).agg(F.floor(F.lit(HEAD_PAIRS) / F.count(F.lit(1))).alias("_room"))
        heads = heads.join(room, BUCKET).withColumn("_try", F.greatest("_try", "_room"))
    heads = heads.where(F.col("_i") <= F.col("_try"))
    heads = materialize(heads.select(*BUCKET, F.col("rep").alias("_head"), F.col("_n").alias("_m"), "_i"))
    y = x.join(heads, BUCKET).where((F.col("rep") > F.col("_head"))
                                    & (F.col("_n") >= F.col("_m") * t - F.lit(SLACK)) & (F.col("_m") >= F.col("_n") * t - F.lit(SLACK)))
    cand = y.select(F.col("_head").alias("a"), F.col("rep").alias("b")).distinct()
    if like is not None:
        cand = cand.join(like.select("a", "b"), ["a", "b"], "left_anti")
    got = materialize(_verify(cand, sets, threshold))
    like = got if like is None else materialize(like.unionByName(got))
    pairs = like.select(F.col("a").alias("_head"), F.col("b").alias("rep"))
    return heads, materialize(y.join(pairs, ["_head", "rep"]).select(*BUCKET, "_head", "_i", "rep")), like


def _sym(e: DataFrame) -> DataFrame:
    return e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).where(F.col("u") != F.col("v"))


def _large_star(e: DataFrame) -> DataFrame:
    """Link every larger neighbour of u to the smallest of u and its neighbours."""
    m = e.groupBy("u").agg(F.min("v").alias("_m"))             # partial aggregation
    x = e.where(F.col("v") > F.col("u")).join(m, "u")
    return x.select(F.col("v").alias("u"), F.least(F.col("u"), F.col("_m")).alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """Link u and its smaller neighbours to the smallest of them."""
    lo = e.where(F.col("v") < F.col("u"))
    m = lo.groupBy("u").agg(F.min("v").alias("_m"))
    x = lo.join(m, "u")
    nbr = x.select(F.col("v").alias("u"), F.col("_m").alias("v"))
    own = m.select("u", F.col("_m").alias("v"))
    return nbr.unionByName(own)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` with label = smallest node id of its connected
    component.  Alternating large-star / small-star steps (Kiveris et al.,
    2014) reach a star around each component minimum in a logarithmic number
    of rounds; each step is a partial aggregate plus a join, and the edge set
    is checkpointed every round.  Stops when a round leaves it unchanged."""
    def digest(t):
        r = t.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40)).alias("h")).first()
        return r["n"], r["h"]

    def orient(t):
        # undirected edges kept once, as (larger, smaller); self loops dropped
        return t.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
                .where(F.col("u") != F.col("v")).distinct()

    e = materialize(orient(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))))
    de = digest(e)
    while True:
        ls = orient(_large_star(_sym(e)))          # large-star needs whole neighbourhoods
        ss = materialize(orient(_small_star(ls)))  # small-star only the smaller neighbours
        ds = digest(ss)
        # cheap test first (count and hash sum); the exact set comparison
        # runs only when they agree, i.e. once at convergence
        same = ds == de and (ss.join(e, ["u", "v"], "left_anti").limit(1).count() == 0
                             and e.join(ss, ["u", "v"], "left_anti").limit(1).count() == 0)
        e, de = ss, ds
        if same:
            break
    lab = _sym(e).groupBy("u").agg(F.min("v").alias("_m"))
    lab = lab.select(F.col("u").alias("node"), F.least(F.col("u"), F.col("_m")).alias("label"))
    # nodes that only have self loops are their own component
    ends = edges.select(F.col(a).alias("node")).unionByName(edges.select(F.col(b).alias("node"))).distinct()
    return ends.join(lab, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def near_dup_survivors(df: DataFrame, threshold: float = 0.8, text: str = "text", key: str = "doc_id",
                       method: str = "lsh") -> DataFrame:
    """drop every document that is an exact or near copy of an earlier
    one ("first wins").  ``method`` = ``exact`` (F3 pairs) or ``lsh`` (F2)."""
    finder = similar_pairs if method == "exact" else minhash_edges
    reps = materialize(representatives(df, text, key))       # distinct texts, hashed once
    lab = components(finder(df, threshold, text, key, reps=reps))
    dropped = lab.where(F.col("node") != F.col("label")).select(F.col("node").alias("rep"))
    keep = reps.select("rep").join(dropped, "rep", "left_anti")
    return df.join(keep.select(F.col("rep").alias(key)), key, "left_semi")
