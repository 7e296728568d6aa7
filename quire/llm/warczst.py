"""WARC archives compressed record by record with an embedded dictionary.

A Zstandard dictionary is built from a bounded sample of the records to be
archived.  Every archive file starts with a skippable frame (magic 0x184D2A5D)
that holds it, so a file is readable on its own; every record is one frame
compressed with it.  Frames are kept apart by empty skippable frames, which
Zstandard readers pass over: this lets Spark's own text writer (any file
system, task commit, retries) write the binary files with that frame as its
line separator.  Reading takes whole files and walks their frames; archives
are kept near ``ARCHIVE`` bytes of payload by the number of partitions.

Equal payloads of ``min_bytes`` or more are stored once: the record with the
largest id is the response, the others are revisits that refer to it.  Only
digests are grouped (map-side combine, so a payload repeated in a third of
the pages is one row per task); the repeated digests join back broadcast
behind a size check, else by a shuffle join whose skewed partitions Spark
splits.

Defined results: a null html is an empty payload; a null url has no target
header; rows that share the largest id of equal payloads are all responses;
equal payloads whose ids are all null are all responses; a null id is kept as
null; an empty table writes and reads no record.
"""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, functions as F

from quire.llm.base import scratch, table

DICT_MAGIC = 0x184D2A5D      # leading frame with the dictionary
GAP = struct.pack("<II", 0x184D2A50, 0)      # empty skippable frame, plain ASCII bytes
ARCHIVE = 256 << 20          # payload bytes per archive, about
SAMPLE_RECORDS, SAMPLE_BYTES, DICT_BYTES = 1000, 16 << 10, 112_640     # of the dictionary only
LEVEL = 3
BROADCAST_ROWS = 200_000     # rows of 90 bytes
WHEN = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_digests(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    x = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).alias("url"),
                     F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    return x.select("*", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
                    F.sha1("payload").alias("payload_digest"), F.xxhash64("payload").alias("_h"))


def repeated(x: DataFrame, min_bytes: int) -> DataFrame:
    """Digests of payloads that occur more than once, with the largest id."""
    g = x.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "_h", "payload_bytes")
    return g.agg(F.count(F.lit(1)).alias("_n"), F.max("page_id").alias("_keep")) \
            .where("_n > 1 and _keep is not null").drop("_n")


def http_head(n: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n


def record(page_id, url, payload, n: int, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP head without payload."""
    block = http_head(n) + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Date: {WHEN}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record as written by :func:`record`."""
    head, _, rest = data.partition(b"\r\n\r\n")
    f = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(f["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    n = int(http.rpartition(b": ")[2])

    def ref(name):
        v = f.get(name)
        return None if v is None or v == "<urn:page:null>" else int(v[10:-1])
    return {"page_id": ref("WARC-Record-ID"), "url": f.get("WARC-Target-URI"), "record_type": f["WARC-Type"],
            "payload_bytes": n, "payload_digest": f["WARC-Payload-Digest"][5:], "refers_to": ref("WARC-Refers-To"),
            "payload": payload if f["WARC-Type"] == "response" else None}


def frame_end(buf, at: int) -> int:
    """End of the Zstandard frame that starts at ``at``."""
    import zstandard
    checksum = buf[at + 4] >> 2 & 1
    at += zstandard.frame_header_size(buf[at:at + 18])
    while True:
        h = int.from_bytes(buf[at:at + 3], "little")
        at += 3 + (1 if h >> 1 & 3 == 1 else h >> 3)      # a run-length block has one byte
        if h & 1:
            return at + 4 * checksum


def records(buf):
    """Decompressed records of one archive, by its own dictionary."""
    import zstandard
    at, dec = 0, None
    while at < len(buf):
        magic, size = struct.unpack_from("<II", buf, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if magic == DICT_MAGIC:
                dec = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(buf[at + 8:at + 8 + size])))
            at += 8 + size
            continue
        end = frame_end(buf, at)
        yield dec.decompress(buf[at:end])
        at = end


def build_dictionary(x: DataFrame, n: int) -> bytes:
    """Dictionary from a bounded sample of the ``n`` records: one in
    ``n / SAMPLE_RECORDS`` by digest, ``SAMPLE_BYTES`` of each."""
    import zstandard
    rows = (x.where(F.pmod("_h", F.lit(max(1, n // SAMPLE_RECORDS))) == 0)
             .select("page_id", "url", F.expr(f"substring(payload, 1, {SAMPLE_BYTES})").alias("p"), "payload_digest")
             .limit(2 * SAMPLE_RECORDS).collect())
    data = [record(r.page_id, r.url, bytes(r.p), len(r.p), r.payload_digest, None) for r in rows]
    try:
        return zstandard.train_dictionary(DICT_BYTES, data, k=256, d=8).as_bytes()
    except zstandard.ZstdError:                      # too little to train on: plain content
        return (b"".join(data) + record(0, "http://", b"", 0, "", None))[-DICT_BYTES:]


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 1000) -> None:
    import pyarrow as pa
    spark = pages.sparkSession
    x = with_digests(pages, key, url, html)
    dups = repeated(x, min_bytes)
    if dups.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        dups = F.broadcast(dups)
    y = x.join(dups, ["payload_digest", "_h", "payload_bytes"], "left")
    revisit = F.col("_keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_keep"))
    y = y.select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes",
                 "payload_digest", F.when(revisit, F.col("_keep")).alias("refers_to"))
    n, total = x.agg(F.count(F.lit(1)), F.coalesce(F.sum("payload_bytes"), F.lit(0))).first()
    if total // ARCHIVE + 1 > pages.rdd.getNumPartitions():
        y = y.repartition(int(total // ARCHIVE + 1))
    words = spark.sparkContext.broadcast(build_dictionary(x, n))

    def run(batches):
        import zstandard
        d = zstandard.ZstdCompressionDict(words.value)
        d.precompute_compress(level=LEVEL)
        z = zstandard.ZstdCompressor(dict_data=d, write_checksum=True)
        lead = [struct.pack("<II", DICT_MAGIC, len(words.value)) + words.value]
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(6)]
            for s in range(0, len(cols[0]), 256):
                out = [z.compress(record(*r)) for r in zip(*(c[s:s + 256] for c in cols))]
                yield pa.RecordBatch.from_arrays([pa.array(lead + out, pa.binary())], names=["rec"])
                lead = []

    out = y.mapInArrow(run, "rec binary").select(F.col("rec").cast("string").alias("value"))
    out.write.option("lineSep", GAP.decode("ascii")).text(path)


def read_archives(spark, path: str, payload: bool = True) -> DataFrame:
    """All records of the archives under ``path``."""
    import pyarrow as pa
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                        ("payload", pa.binary())])

    def run(batches):
        import hashlib
        for b in batches:
            for content in b.column(0):
                rows = []
                for data in records(memoryview(content.as_buffer())):
                    r = parse(data)
                    if r["payload"] is not None and hashlib.sha1(r["payload"]).hexdigest() != r["payload_digest"]:
                        raise ValueError(f"record of page {r['page_id']} does not match its digest")
                    rows.append(r if payload else r | {"payload": None})
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "page_id bigint, url string, record_type string, payload_bytes bigint, "
                                 "payload_digest string, refers_to bigint, payload binary")


def op5_warc_dictionary(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    got = read_archives(spark, path, payload=False)
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
m AS (SELECT h, max(page_id) AS keep FROM p WHERE strlen(h) >= 1000 GROUP BY h HAVING count(*) > 1)
SELECT p.page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN keep IS NULL OR keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keep <> page_id THEN keep END AS refers_to
FROM p LEFT JOIN m ON p.h = m.h
"""
