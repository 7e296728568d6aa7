"""Registered queries: Spark DataFrame builders and their DuckDB oracles.

Every query reads the driver tables (``documents``, ``pages``,
``conversations``) in full.  Long texts are returned as SHA-256 hashes so the
comparison stays cheap without cutting anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quire.functions import html as H
from quire.functions.pii import scrub, scrub_rule
from quire.functions.text import collapse_lines, content_hash, ids_to_text, py_strip, token_count
from quire.operators import crawl as C
from quire.operators.boilerplate import drop_repeated_lines
from quire.operators.dedupe import exact_dedupe
from quire.operators.filters import (SECURITY_KEYWORDS, collapse_documents, filter_keywords,
                                     filter_language, filter_min_len, reject_malformed, split_documents)
from quire.operators.order import dense_index, shard_mod, train_test_split
from quire.operators.pack import pack_sequences
from quire.operators.vocab import encode, whitespace_vocab
from quire.plans import sqlfrag as S
from quire.plans.prep import PrepConfig, tokenize_and_pack
from quire.session import materialize, spread, store, tune

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def T(spark: SparkSession, sf: str, name: str) -> DataFrame:
    tune(spark)
    return spread(spark.read.parquet(f"{sf}/{name}.parquet"))


def docs_lines(spark, sf) -> DataFrame:
    """Documents as the line documents of the source (strip, drop blank, collapse)."""
    return collapse_documents(T(spark, sf, "documents").select("doc_id", "text"))


# ---------------------------------------------------------------- SQL CTEs
LINES_SQL = (f"lines AS (SELECT doc_id, {S.collapse(S.strip('text'))} AS text FROM documents "
             f"WHERE {S.strip('text')} <> '')")
DEDUP_SQL = ("dd AS (SELECT min(doc_id) AS doc_id, text FROM lines GROUP BY sha256(text), text)")


# ---------------------------------------------------------------- C3-C5, C12
@register("collapse_lines", f"""WITH {LINES_SQL}
SELECT doc_id, sha256(text) AS text_sha256, CAST(strlen(text) AS BIGINT) AS n_bytes FROM lines""")
def q_collapse_lines(spark, sf):
    d = docs_lines(spark, sf)
    return d.select("doc_id", content_hash("text").alias("text_sha256"),
                    F.octet_length("text").cast("bigint").alias("n_bytes"))


@register("token_counts", f"""SELECT doc_id, {S.token_count('text')} AS n_tokens FROM documents""")
def q_token_counts(spark, sf):
    return T(spark, sf, "documents").select("doc_id", token_count("text").alias("n_tokens"))


# ---------------------------------------------------------------- F1
@register("exact_dedupe", f"""WITH s AS (SELECT doc_id, {S.strip('text')} AS t FROM documents)
SELECT min(doc_id) AS doc_id, sha256(t) AS text_sha256 FROM s WHERE t <> '' GROUP BY sha256(t)""")
def q_exact_dedupe(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", "text")
    return exact_dedupe(d, hash_col="text_sha256").select("doc_id", "text_sha256")


# ---------------------------------------------------------------- C6-C9
@register("scrub_pii", f"""SELECT doc_id, sha256({S.scrub('text')}) AS text_sha256,
{S.scrub('text')} <> text AS changed FROM documents""")
def q_scrub_pii(spark, sf):
    d = T(spark, sf, "documents")
    s = scrub("text")
    return d.select("doc_id", content_hash(s).alias("text_sha256"), (s != F.col("text")).alias("changed"))


@register("scrub_counts", f"""WITH a AS (SELECT text AS t0, {S.scrub_rule('text', 'ip')} AS t1 FROM documents),
b AS (SELECT t0, t1, {S.scrub_rule('t1', 'email')} AS t2 FROM a),
c AS (SELECT t0, t1, t2, {S.scrub_rule('t2', 'phone')} AS t3 FROM b)
SELECT CAST(count(*) FILTER (WHERE t1 <> t0) AS BIGINT) AS n_ip,
       CAST(count(*) FILTER (WHERE t2 <> t1) AS BIGINT) AS n_email,
       CAST(count(*) FILTER (WHERE t3 <> t2) AS BIGINT) AS n_phone,
       CAST(count(*) FILTER (WHERE t3 <> t0) AS BIGINT) AS n_changed FROM c""")
def q_scrub_counts(spark, sf):
    d = T(spark, sf, "documents").select(F.col("text").alias("t0"))
    d = d.withColumn("t1", scrub_rule("t0", "ip")).withColumn("t2", scrub_rule("t1", "email")) \
         .withColumn("t3", scrub_rule("t2", "phone"))

    def n(c):
        return F.count(F.when(c, 1)).cast("bigint")
    return d.agg(n(F.col("t1") != F.col("t0")).alias("n_ip"), n(F.col("t2") != F.col("t1")).alias("n_email"),
                 n(F.col("t3") != F.col("t2")).alias("n_phone"), n(F.col("t3") != F.col("t0")).alias("n_changed"))


# ---------------------------------------------------------------- D2-D4
@register("filter_min_len", f"""WITH {LINES_SQL}
SELECT doc_id, {S.token_count('text')} AS n_tokens FROM lines WHERE {S.token_count('text')} >= 100""")
def q_filter_min_len(spark, sf):
    return filter_min_len(docs_lines(spark, sf), 100).select("doc_id", token_count("text").alias("n_tokens"))


def _kw_list(words):
    return "[" + ", ".join(S.q(w.lower()) for w in words) + "]"


# a keyword is a whole white-space token without its outer punctuation, or
# (substring) occurs anywhere: list functions and contains(), no alternation
KW_UNITS_SQL = (f"list_transform({S.tokens('lower(text)')}, lambda t: "
                "regexp_replace(regexp_replace(t, '^[\\p{P}\\p{S}]+', ''), '[\\p{P}\\p{S}]+$', ''))")


def _kw_sql(words, src="lines"):
    return f"SELECT doc_id FROM {src} WHERE list_has_any({KW_UNITS_SQL}, {_kw_list(words)})"


@register("filter_keywords", f"WITH {LINES_SQL} {_kw_sql(SECURITY_KEYWORDS)}")
def q_filter_keywords(spark, sf):
    return filter_keywords(docs_lines(spark, sf), SECURITY_KEYWORDS).select("doc_id")


@register("filter_keywords_substring", f"""WITH {LINES_SQL} SELECT doc_id FROM lines
WHERE len(list_filter({_kw_list(SECURITY_KEYWORDS)}, lambda k: contains(lower(text), k))) > 0""")
def q_filter_keywords_substring(spark, sf):
    return filter_keywords(docs_lines(spark, sf), SECURITY_KEYWORDS, mode="substring").select("doc_id")


@register("filter_keywords_table", f"""WITH {LINES_SQL}, u AS (SELECT doc_id, unnest({KW_UNITS_SQL}) AS u FROM lines),
df AS (SELECT u, count(DISTINCT doc_id) AS n FROM u WHERE u <> '' GROUP BY u)
SELECT DISTINCT doc_id FROM u JOIN df USING (u) WHERE n BETWEEN 2 AND 3""")
def q_filter_keywords_table(spark, sf):
    """D3 with a long keyword table: the units of two or three documents."""
    from quire.operators.filters import keyword_tokens
    lines = materialize(docs_lines(spark, sf))
    u = lines.select("doc_id", F.explode(F.array_distinct(keyword_tokens("text"))).alias("keyword")).where("keyword <> ''")
    rare = u.groupBy("keyword").agg(F.count(F.lit(1)).alias("n")).where("n between 2 and 3").select("keyword")
    return filter_keywords(lines, rare).select("doc_id")


@register("filter_lang_column", "SELECT doc_id, lang FROM documents WHERE lang = 'en'")
def q_filter_lang_column(spark, sf):
    return filter_language(T(spark, sf, "documents"), "en").select("doc_id", "lang")


# ---------------------------------------------------------------- E1, E5
@register("shard_mod", f"""WITH {LINES_SQL}
SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 4 AS INTEGER) AS shard FROM lines""")
def q_shard_mod(spark, sf):
    return shard_mod(docs_lines(spark, sf), ["doc_id"], 4).select("doc_id", "shard")


@register("train_test_split", f"""WITH {LINES_SQL}
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 < floor(count(*) OVER () * 0.9)
       THEN 'train' ELSE 'test' END AS split FROM lines""")
def q_train_test_split(spark, sf):
    return train_test_split(docs_lines(spark, sf), ["doc_id"], 0.9).select("doc_id", "split")


# ---------------------------------------------------------------- G3, G2, H1
VOCAB_SQL = (f"vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY freq DESC, token) - 1 AS BIGINT) AS id, freq "
             f"FROM (SELECT token, count(*) AS freq FROM (SELECT unnest({S.tokens('text')}) AS token FROM @SRC@) "
             f"GROUP BY token))")


@register("vocab_whitespace", f"""WITH {VOCAB_SQL.replace('@SRC@', 'documents')}
SELECT token, id, CAST(freq AS BIGINT) AS freq FROM vocab""")
def q_vocab_whitespace(spark, sf):
    return whitespace_vocab(T(spark, sf, "documents"))


ENCODE_SQL = ("toks AS (SELECT doc_id, unnest(tk) AS token, generate_subscripts(tk, 1) AS pos "
              f"FROM (SELECT doc_id, {S.tokens('text')} AS tk FROM @SRC@))")


@register("encode_whitespace", f"""WITH {VOCAB_SQL.replace('@SRC@', 'documents')}, {ENCODE_SQL.replace('@SRC@', 'documents')}
SELECT d.doc_id, coalesce(e.ids, '') AS ids FROM documents d LEFT JOIN
 (SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids FROM toks JOIN vocab USING (token)
  GROUP BY doc_id) e USING (doc_id)""")
def q_encode_whitespace(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", "text")
    v = whitespace_vocab(d)
    return encode(d, v).select("doc_id", ids_to_text("input_ids").alias("ids"))


PACK_SQL = f"""WITH {LINES_SQL}, {DEDUP_SQL}, {VOCAB_SQL.replace('@SRC@', 'dd')},
sp AS (SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 < floor(count(*) OVER () * 0.9)
       THEN 'train' ELSE 'test' END AS split FROM dd),
{ENCODE_SQL.replace('@SRC@', 'dd')},
g AS (SELECT split, id, row_number() OVER (PARTITION BY split ORDER BY doc_id, pos) - 1 AS gpos
      FROM toks JOIN vocab USING (token) JOIN sp USING (doc_id)),
w AS (SELECT split, gpos // @L@ AS seq_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY gpos) AS ids,
      count(*) AS n FROM g GROUP BY split, gpos // @L@)
SELECT split, CAST(seq_id AS BIGINT) AS seq_id, ids FROM w WHERE n = @L@"""


def packed_docs(spark, sf, seq_len):
    d = exact_dedupe(docs_lines(spark, sf))
    return tokenize_and_pack(d, PrepConfig(seq_len=seq_len))


@register("pack_sequences", PACK_SQL.replace("@L@", "64"))
def q_pack_sequences(spark, sf):
    _, packed = packed_docs(spark, sf, 64)
    return packed.select("split", "seq_id", ids_to_text("input_ids").alias("ids"))


@register("pack_sequences_4096", PACK_SQL.replace("@L@", "4096"))
def q_pack_sequences_4096(spark, sf):
    _, packed = packed_docs(spark, sf, 4096)
    return packed.select("split", "seq_id", ids_to_text("input_ids").alias("ids"))


# ---------------------------------------------------------------- C1, C10, C11, D6
from quire.functions.content import main_content, without_dropped  # noqa: E402


@register("extract_text", f"""SELECT page_id, sha256({S.extract_text('html')}) AS text_sha256,
CAST(strlen({S.extract_text('html')}) AS BIGINT) AS n_bytes FROM pages""")
def q_extract_text(spark, sf):
    t = H.extract_text("html")
    return T(spark, sf, "pages").select("page_id", content_hash(t).alias("text_sha256"),
                                        F.octet_length(t).cast("bigint").alias("n_bytes"))


@register("extract_main", f"""WITH k AS (SELECT page_id, {S.keep_content('html')} AS kept FROM pages),
m AS (SELECT page_id, {S.main_content('kept')} AS text FROM k)
SELECT page_id, sha256(text) AS text_sha256, CAST(strlen(text) AS BIGINT) AS n_bytes FROM m""")
def q_extract_main(spark, sf):
    """C1 with nested subtrees and link density."""
    p = T(spark, sf, "pages").select("page_id", without_dropped("html").alias("kept"))
    p = p.select("page_id", main_content("kept").alias("text"))
    return p.select("page_id", content_hash("text").alias("text_sha256"), F.octet_length("text").cast("bigint").alias("n_bytes"))


@register("extract_text_boilerplate", f"""WITH ex AS (SELECT page_id, lower({S.host('url')}) AS host, {S.extract_text('html')} AS text FROM pages),
ln AS (SELECT page_id, host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM ex),
bad AS (SELECT host, line FROM ln JOIN (SELECT host, count(*) AS pages FROM ex GROUP BY host) USING (host) WHERE line <> ''
  GROUP BY host, line, pages HAVING count(DISTINCT page_id) >= 3 AND count(DISTINCT page_id) * 2 >= pages)
SELECT page_id, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE (host, line) NOT IN (SELECT (host, line) FROM bad)), '')) AS text_sha256
FROM ln GROUP BY page_id""")
def q_extract_text_boilerplate(spark, sf):
    """C1, both passes."""
    p = materialize(T(spark, sf, "pages").select("page_id", "url", H.extract_text("html").alias("text")))
    return drop_repeated_lines(p).select("page_id", content_hash("text").alias("text_sha256"))


LINKS_SQL = (f"lk AS (SELECT page_id, url, unnest(l) AS href, generate_subscripts(l, 1) AS pos "
             f"FROM (SELECT page_id, url, {S.links('html')} AS l FROM pages))")


@register("extract_links", f"""WITH {LINKS_SQL}
SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, href FROM lk""")
def q_extract_links(spark, sf):
    p = T(spark, sf, "pages")
    return p.select("page_id", F.posexplode(H.extract_links("html")).alias("pos", "href"))


@register("resolve_links", f"""WITH {LINKS_SQL}
SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, {S.resolve_url('url', 'href')} AS target FROM lk""")
def q_resolve_links(spark, sf):
    p = T(spark, sf, "pages")
    x = p.select("page_id", "url", F.posexplode(H.extract_links("html")).alias("pos", "href"))
    return x.select("page_id", "pos", H.resolve_url("url", "href").alias("target"))


@register("allowed_links", f"""WITH {LINKS_SQL},
t AS (SELECT page_id, pos, {S.resolve_url('url', 'href')} AS target FROM lk),
pre AS (SELECT DISTINCT {S.origin('url')} || '/' AS prefix FROM pages WHERE url LIKE 'https://%')
SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, target FROM t
WHERE EXISTS (SELECT 1 FROM pre WHERE starts_with(t.target, pre.prefix))""")
def q_allowed_links(spark, sf):
    p = T(spark, sf, "pages")
    x = p.select("page_id", "url", F.posexplode(H.extract_links("html")).alias("pos", "href"))
    x = x.select("page_id", "pos", H.resolve_url("url", "href").alias("target"))
    # allow-list: the https origins of the stored pages
    pre = p.where(F.col("url").startswith("https://")).select(
        F.concat(F.regexp_extract("url", "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1), F.lit("/")).alias("prefix"))
    return C.allowed(x, pre, url="target")


# ---------------------------------------------------------------- E4, I4
from quire.operators.shards import reshard_by_tokens, reshard_summary  # noqa: E402
from quire.operators.batches import batch_and_pad, budget_batches, step_log  # noqa: E402
from quire.operators.report import end_report, lines_bytes, stage_funnel, token_totals  # noqa: E402
from quire.plans.prep import clean_documents, pages_to_documents, prepare_corpus  # noqa: E402

RESHARD_SQL = f"""WITH RECURSIVE s AS (SELECT doc_id, n, sum(n) OVER (ORDER BY doc_id) - n AS cb, sum(n) OVER () AS tot
  FROM (SELECT doc_id, {S.token_count('text')} AS n FROM documents) WHERE n > 0),
b(k, st) AS (SELECT 0, CAST(0 AS BIGINT)
   UNION ALL SELECT k + 1, (SELECT min(cb) FROM s WHERE (s.cb - b.st) * 8 >= s.tot) FROM b WHERE k < 7 AND b.st IS NOT NULL),
r AS (SELECT doc_id, n, CAST((SELECT max(k) FROM b WHERE b.st <= s.cb) AS INTEGER) AS shard FROM s)"""


def _doc_seqs(spark, sf):
    return T(spark, sf, "documents").select(F.col("doc_id"), token_count("text").alias("n_tokens"))


@register("reshard_by_tokens", RESHARD_SQL + "\nSELECT doc_id, shard FROM r")
def q_reshard_by_tokens(spark, sf):
    return reshard_by_tokens(_doc_seqs(spark, sf), 8, order="doc_id").select("doc_id", "shard")


@register("reshard_summary", RESHARD_SQL + """
SELECT shard, CAST(count(*) AS BIGINT) AS lines, CAST(sum(n) AS BIGINT) AS tokens,
 CAST(sum(sum(n)) OVER () AS BIGINT) AS total_tokens, sum(sum(n)) OVER () / 8.0 AS target FROM r GROUP BY shard""")
def q_reshard_summary(spark, sf):
    r = reshard_by_tokens(_doc_seqs(spark, sf), 8, order="doc_id")
    return reshard_summary(r, 8)


@register("reshard_packed", PACK_SQL.replace("@L@", "64").replace(
    "SELECT split, CAST(seq_id AS BIGINT) AS seq_id, ids FROM w WHERE n = 64",
    "SELECT seq_id, CAST(least(7, (row_number() OVER (ORDER BY seq_id) - 1) // CAST(ceil(count(*) OVER () / 8.0) AS BIGINT)) AS INTEGER)"
    " AS shard FROM w WHERE n = 64 AND split = 'train'"))
def q_reshard_packed(spark, sf):
    _, packed = packed_docs(spark, sf, 64)
    tr = packed.where(F.col("split") == "train").select("seq_id", F.size("input_ids").alias("n_tokens"))
    return reshard_by_tokens(tr, 8).select("seq_id", "shard")


# ---------------------------------------------------------------- K2, K3, I5
@register("batch_and_pad", f"""WITH {VOCAB_SQL.replace('@SRC@', 'documents')}, {ENCODE_SQL.replace('@SRC@', 'documents')},
e AS (SELECT d.doc_id, coalesce(x.ids, []) AS ids FROM documents d LEFT JOIN
   (SELECT doc_id, list(id ORDER BY pos) AS ids FROM toks JOIN vocab USING (token) GROUP BY doc_id) x USING (doc_id)),
i AS (SELECT doc_id, ids, row_number() OVER (ORDER BY doc_id) - 1 AS ix FROM e),
w AS (SELECT *, ix // 8 AS batch_id, max(len(ids)) OVER (PARTITION BY ix // 8) AS width FROM i)
SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(ix % 8 AS INTEGER) AS row, doc_id, CAST(len(ids) AS INTEGER) AS n,
 CAST(width AS INTEGER) AS width,
 sha256(array_to_string(list_concat(ids, list_transform(range(width - len(ids)), lambda z: 0)), ' ')) AS ids_sha256
FROM w""")
def q_batch_and_pad(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", "text")
    enc = encode(d, whitespace_vocab(d))
    b = batch_and_pad(enc, 8, order="doc_id")
    return b.select("batch_id", "row", "doc_id", "n", "width",
                    content_hash(ids_to_text("input_ids")).alias("ids_sha256"))


BUDGET_SQL = f"""WITH s AS (SELECT doc_id, n, row_number() OVER (ORDER BY doc_id) - 1 AS ix, count(*) OVER () AS cnt,
   sum(n) OVER () AS tok FROM (SELECT doc_id, {S.token_count('text')} AS n FROM documents)),
rep AS (SELECT s.*, e.e AS ep FROM s, (SELECT unnest(range(CAST(ceil(2.5 * (SELECT max(tok) FROM s) / (SELECT max(tok) FROM s)) AS BIGINT) + 2)) AS e) e),
bt AS (SELECT (ep * cnt + ix) // 16 AS batch, count(*) AS rows, max(n) AS width, min(ep) AS epoch FROM rep GROUP BY 1),
c AS (SELECT batch, rows, width, epoch, rows * width AS tokens, sum(rows * width) OVER (ORDER BY batch) AS cum FROM bt WHERE rows = 16)
SELECT CAST(batch + 1 AS BIGINT) AS step, CAST(epoch AS INTEGER) AS epoch, CAST(rows AS BIGINT) AS rows, CAST(width AS INTEGER) AS width,
 CAST(tokens AS BIGINT) AS tokens, CAST(cum AS BIGINT) AS cum_tokens FROM c
WHERE cum - tokens < (SELECT CAST(floor(2.5 * max(tok)) AS BIGINT) FROM s)"""


def _budget(spark, sf):
    seqs = _doc_seqs(spark, sf)
    tok = seqs.agg(F.sum("n_tokens")).first()[0]
    return budget_batches(seqs, 16, int(2.5 * tok), order="doc_id")


@register("token_budget", BUDGET_SQL)
def q_token_budget(spark, sf):
    return _budget(spark, sf)


@register("train_log", f"SELECT step, cum_tokens FROM ({BUDGET_SQL}) WHERE step % 10 = 0")
def q_train_log(spark, sf):
    return step_log(_budget(spark, sf), 10)


# ---------------------------------------------------------------- I1, I3, I6
@register("shard_report", f"""WITH {LINES_SQL},
s AS (SELECT text, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 6 AS INTEGER) AS shard FROM lines)
SELECT g.shard, CAST(coalesce(count(s.text), 0) AS BIGINT) AS lines,
 CAST(coalesce(sum(strlen(s.text) + 1), 0) AS BIGINT) AS bytes
FROM (SELECT CAST(unnest(range(8)) AS INTEGER) AS shard) g LEFT JOIN s USING (shard) GROUP BY g.shard""")
def q_shard_report(spark, sf):
    s = shard_mod(docs_lines(spark, sf), ["doc_id"], 6)
    return lines_bytes(s, by="shard", num_shards=8)


@register("token_totals", PACK_SQL.replace("@L@", "64").replace(
    "SELECT split, CAST(seq_id AS BIGINT) AS seq_id, ids FROM w WHERE n = 64",
    """, t AS (SELECT seq_id, n, CAST(least(3, (row_number() OVER (ORDER BY seq_id) - 1) // CAST(ceil(count(*) OVER () / 4.0) AS BIGINT)) AS INTEGER)
    AS shard FROM w WHERE n = 64 AND split = 'train')
SELECT shard, CAST(sum(n) AS BIGINT) AS tokens, CAST(count(*) AS BIGINT) AS sequences FROM t GROUP BY ROLLUP (shard)""").replace(
    "GROUP BY split, gpos // 64)\n,", "GROUP BY split, gpos // 64)\n,"))
def q_token_totals(spark, sf):
    _, packed = packed_docs(spark, sf, 64)
    tr = packed.where(F.col("split") == "train").withColumn("n_tokens", F.size("input_ids"))
    return token_totals(reshard_by_tokens(tr, 4), by="shard")


FUNNEL_SQL = f"""WITH ex AS (SELECT page_id AS doc_id, {S.extract_text('html')} AS text FROM pages),
fl AS (SELECT doc_id, {S.collapse(S.strip('text'))} AS text FROM ex WHERE {S.strip('text')} <> ''),
dd AS (SELECT min(doc_id) AS doc_id, text FROM fl GROUP BY text),
sc AS (SELECT doc_id, {S.scrub('text')} AS text FROM dd),
u AS (SELECT 0 AS step, 'raw' AS stage, count(*) AS docs, sum(strlen(text) + 1) AS bytes FROM ex
 UNION ALL SELECT 1, 'filtered', count(*), sum(strlen(text) + 1) FROM fl
 UNION ALL SELECT 2, 'deduped', count(*), sum(strlen(text) + 1) FROM dd
 UNION ALL SELECT 3, 'scrubbed', count(*), sum(strlen(text) + 1) FROM sc)
SELECT step, stage, CAST(docs AS BIGINT) AS docs, CAST(coalesce(bytes, 0) AS BIGINT) AS bytes,
 CAST(floor(docs * 1000 / (SELECT docs FROM u WHERE step = 0)) AS BIGINT) AS kept_per_mille FROM u"""


@register("corpus_funnel", FUNNEL_SQL)
def q_corpus_funnel(spark, sf):
    # the extracted stage feeds four aggregates: extract once
    st = clean_documents(materialize(pages_to_documents(T(spark, sf, "pages"))))
    return stage_funnel([(k, st[k]) for k in ("raw", "filtered", "deduped", "scrubbed")])


# ---------------------------------------------------------------- F2-F4
from quire.operators.dedupe import PRIME, minhash_edges, near_dup_survivors, signature_factors, similar_pairs  # noqa: E402

SHINGLE_SQL = f"""reps AS (SELECT min(doc_id) AS rep, t FROM (SELECT doc_id, {S.strip('text')} AS t FROM documents)
  WHERE t <> '' GROUP BY sha256(t), t),
tk AS (SELECT rep, {S.tokens('lower(t)')} AS w FROM reps),
sh AS (SELECT DISTINCT rep, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
   ELSE list_transform(range(0, len(w) - 2), lambda i: array_to_string(w[i + 1:i + 3], ' ')) END) AS g FROM tk),
n AS (SELECT rep, count(*) AS c FROM sh GROUP BY rep),
pairs AS (SELECT a.rep AS a, b.rep AS b, count(*) AS inter FROM sh a JOIN sh b ON a.g = b.g AND a.rep < b.rep GROUP BY 1, 2),
sim AS (SELECT a, b, CAST(inter AS BIGINT) AS inter, CAST(na.c + nb.c - inter AS BIGINT) AS uni FROM pairs
   JOIN n na ON na.rep = a JOIN n nb ON nb.rep = b WHERE inter / (na.c + nb.c - inter) >= 0.8)"""


@register("near_dup_exact", f"WITH {SHINGLE_SQL} SELECT a, b, inter, uni FROM sim")
def q_near_dup_exact(spark, sf):
    return similar_pairs(T(spark, sf, "documents").select("doc_id", "text"), 0.8)


# the buckets of the signatures, then bucket by bucket the smallest id and what
# is not like it, until none is left
LSH_SQL = f"""WITH RECURSIVE {SHINGLE_SQL}, {S.CRC_TABLE},
words AS (SELECT DISTINCT unnest(w) AS word FROM tk),
crc AS MATERIALIZED (SELECT word, {S.crc32('word')} % {PRIME} AS c FROM words, crc_table),
pos AS (SELECT rep, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM tk),
run AS (SELECT rep, i, c, lead(c, 1) OVER o AS c1, lead(c, 2) OVER o AS c2, count(*) OVER (PARTITION BY rep) AS n
  FROM pos JOIN crc USING (word) WINDOW o AS (PARTITION BY rep ORDER BY i)),
v AS (SELECT DISTINCT rep, (c * @0@ % {PRIME} + coalesce(c1 * @1@ % {PRIME}, 0) + coalesce(c2 * @2@ % {PRIME}, 0)) % {PRIME} AS h
  FROM run WHERE c2 IS NOT NULL OR (n < 3 AND i = 1)),
lo AS (SELECT rep, min(h) AS m FROM v GROUP BY rep, h // @W@),
sig AS (SELECT rep, j, coalesce(min(m) FILTER (WHERE m >= j * @W@), min(m)) AS s FROM lo, range(120) r(j) GROUP BY rep, j),
bk AS (SELECT rep, j % 20 AS band, list(s ORDER BY j) AS bucket FROM sig GROUP BY rep, j % 20),
shared AS MATERIALIZED (SELECT * FROM bk QUALIFY count(*) OVER (PARTITION BY band, bucket) > 1),
simm AS MATERIALIZED (SELECT * FROM sim),
x AS (SELECT rep, band, bucket, min(rep) OVER (PARTITION BY band, bucket) AS head FROM shared
  UNION ALL SELECT rep, band, bucket, min(rep) OVER (PARTITION BY band, bucket) FROM x
  WHERE rep <> head AND NOT EXISTS (SELECT 1 FROM simm WHERE a = head AND b = rep))
SELECT DISTINCT a, b, inter, uni FROM x JOIN simm ON a = head AND b = rep"""
for _j, _a in enumerate(signature_factors(3)):
    LSH_SQL = LSH_SQL.replace(f"@{_j}@", str(_a))
LSH_SQL = LSH_SQL.replace("@W@", str(-(-PRIME // 120)))


@register("near_dup_lsh", LSH_SQL)
def q_near_dup_lsh(spark, sf):
    return minhash_edges(T(spark, sf, "documents").select("doc_id", "text"), 0.8)


@register("near_dup_survivors", f"""WITH RECURSIVE {SHINGLE_SQL},
e AS (SELECT a AS u, b AS v FROM sim UNION SELECT b, a FROM sim),
r(node, reach) AS (SELECT u, u FROM e UNION SELECT r.node, e.v FROM r JOIN e ON e.u = r.reach),
lab AS (SELECT node, min(reach) AS label FROM r GROUP BY node)
SELECT rep AS doc_id FROM reps WHERE rep NOT IN (SELECT node FROM lab WHERE node <> label)""")
def q_near_dup_survivors(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", "text")
    return near_dup_survivors(d, 0.8).select("doc_id")


# ---------------------------------------------------------------- D5
from quire.operators.lang import detect_language, train_profile  # noqa: E402


def _grams_sql(src):
    from quire.operators.lang import GRAM_SPACE
    t = f"regexp_replace(lower(text), {S.q(GRAM_SPACE)}, ' ', 'g')"
    return (f"(SELECT doc_id, g, count(*) AS cnt FROM (SELECT doc_id, unnest(list_transform(range(0, "
            f"greatest(len(c) - 2, 0)), lambda i: c[i + 1] || c[i + 2] || c[i + 3])) AS g "
            f"FROM (SELECT doc_id, string_split({t}, '') AS c FROM {src})) GROUP BY doc_id, g)")


LANG_SQL = f"""WITH tr AS (SELECT doc_id, text, lang FROM documents QUALIFY row_number() OVER (ORDER BY doc_id) - 1
   < floor(count(*) OVER () * 0.9)),
tg AS {_grams_sql('tr')},
lg AS (SELECT lang, g, sum(cnt) AS c FROM tg JOIN tr USING (doc_id) GROUP BY lang, g),
v AS (SELECT count(DISTINCT g) AS v FROM lg),
cs AS (SELECT lang, -ln(sum(c) + (SELECT v FROM v)) AS base FROM lg GROUP BY lang),
pr AS (SELECT lang, ln(count(*) / sum(count(*)) OVER ()) AS prior FROM tr GROUP BY lang),
dg AS {_grams_sql('documents')},
ng AS (SELECT doc_id, sum(cnt) AS ng FROM dg GROUP BY doc_id),
hit AS (SELECT doc_id, lang, sum(cnt * ln(c + 1)) AS h FROM dg JOIN lg USING (g) GROUP BY doc_id, lang),
sc AS (SELECT d.doc_id, cs.lang, coalesce(hit.h, 0) + coalesce(ng.ng, 0) * cs.base + pr.prior AS score
   FROM (SELECT doc_id FROM documents) d CROSS JOIN cs JOIN pr USING (lang) LEFT JOIN ng USING (doc_id) LEFT JOIN hit ON hit.doc_id = d.doc_id AND hit.lang = cs.lang)
SELECT doc_id, lang AS lang_pred FROM sc QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) = 1"""


@register("language_id", LANG_SQL)
def q_language_id(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", "text", "lang")
    tr = train_test_split(d, ["doc_id"], 0.9).where(F.col("split") == "train")
    prof, consts = train_profile(tr)
    return detect_language(d, prof, consts).select("doc_id", "lang_pred")


# ---------------------------------------------------------------- A8, C14
from quire.operators.sft import conversation_lines, conversation_pairs, sft_text  # noqa: E402


@register("conversation_format", """SELECT conv_id, turn,
 upper(substr(role, 1, 1)) || substr(role, 2) || ': ' || text AS line FROM conversations""")
def q_conversation_format(spark, sf):
    return conversation_lines(T(spark, sf, "conversations"))


@register("sft_format", """SELECT u.conv_id, u.turn,
 sha256('Q: ' || u.text || chr(10) || 'Reasoning:' || chr(10) || '' || chr(10) || 'Answer: ' || a.text) AS text_sha256
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'""")
def q_sft_format(spark, sf):
    p = sft_text(conversation_pairs(T(spark, sf, "conversations")))
    return p.select("conv_id", "turn", content_hash("text").alias("text_sha256"))


# ---------------------------------------------------------------- E2, F6, K4
def _ring_edges(spark, sf):
    """Synthetic link graph over the stored pages: page i links to pages
    (7i+1) mod n and (3i+2) mod n."""
    p = T(spark, sf, "pages").select("page_id", "url")
    n = p.count()
    src = p.select(F.col("page_id").alias("i"), F.col("url").alias("src"))
    dst = p.select(F.col("page_id").alias("j"), F.col("url").alias("dst"))
    e1 = src.join(dst, F.pmod(F.col("i") * 7 + 1, F.lit(n)) == F.col("j"))
    e2 = src.join(dst, F.pmod(F.col("i") * 3 + 2, F.lit(n)) == F.col("j"))
    return p, e1.select("src", "dst").unionByName(e2.select("src", "dst")).distinct()


RING_SQL = """WITH RECURSIVE n AS (SELECT count(*) AS n FROM pages),
e AS (SELECT s.url AS src, d.url AS dst FROM pages s JOIN pages d ON d.page_id = (s.page_id * 7 + 1) % (SELECT n FROM n)
      UNION SELECT s.url, d.url FROM pages s JOIN pages d ON d.page_id = (s.page_id * 3 + 2) % (SELECT n FROM n)),
r(url, depth) AS (SELECT url, 0 FROM pages WHERE page_id = (SELECT min(page_id) FROM pages)
   UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.url WHERE r.depth < (SELECT n FROM n)),
c AS (SELECT url, min(depth) AS depth FROM r GROUP BY url)"""


@register("crawl_closure", RING_SQL + "\nSELECT url, CAST(depth AS INTEGER) AS depth, true AS fetched FROM c")
def q_crawl_closure(spark, sf):
    p, e = _ring_edges(spark, sf)
    seeds = p.where(F.col("page_id") == p.agg(F.min("page_id")).first()[0]).select("url")
    return C.crawl(seeds, e, p)


@register("crawl_budget", RING_SQL + """
SELECT url, CAST(depth AS INTEGER) AS depth, true AS fetched FROM c
QUALIFY row_number() OVER (ORDER BY depth, url) <= 100""")
def q_crawl_budget(spark, sf):
    p, e = _ring_edges(spark, sf)
    seeds = p.where(F.col("page_id") == p.agg(F.min("page_id")).first()[0]).select("url")
    return C.crawl(seeds, e, p, max_pages=100)


@register("crawl_links", f"""WITH {LINKS_SQL},
t AS (SELECT DISTINCT {S.resolve_url('url', 'href')} AS target FROM lk),
pre AS (SELECT DISTINCT {S.origin('url')} || '/' AS prefix FROM pages),
a AS (SELECT target FROM t WHERE EXISTS (SELECT 1 FROM pre WHERE starts_with(t.target, pre.prefix)))
SELECT url, 0 AS depth, true AS fetched FROM pages
UNION ALL SELECT target, 1, false FROM a WHERE target NOT IN (SELECT url FROM pages)""")
def q_crawl_links(spark, sf):
    p = T(spark, sf, "pages").select("url", "html")
    pre = p.select(F.concat(F.regexp_extract("url", "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1),
                            F.lit("/")).alias("prefix"))
    e = C.link_edges(p, pre)
    return C.crawl(p.select("url"), e, p)


@register("url_crc_shard", f"""WITH {LINKS_SQL}, {S.CRC_TABLE},
seeds AS (SELECT DISTINCT {S.origin('url')} || '/' AS url FROM pages),
urls AS (SELECT DISTINCT {S.resolve_url('url', 'href')} AS url FROM lk UNION SELECT url FROM seeds)
SELECT url, CAST(p AS INTEGER) AS part FROM seeds, range(4) r(p)
UNION ALL SELECT url, CAST({S.crc32('url')} % 4 AS INTEGER) FROM urls, crc_table WHERE url NOT IN (SELECT url FROM seeds)""")
def q_url_crc_shard(spark, sf):
    p = T(spark, sf, "pages").select("url", "html")
    e = C.link_edges(p)
    seeds = p.select(F.concat(F.regexp_extract("url", "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1),
                              F.lit("/")).alias("url")).distinct()
    urls = e.select(F.col("dst").alias("url")).unionByName(seeds).distinct()
    return C.crc_shard(urls, 4, seeds=seeds)


# ---------------------------------------------------------------- G1, G2, G4
from quire.operators.bpe import bpe_encode, train_bpe  # noqa: E402
from quire.operators.vocab import vocab_size  # noqa: E402

BPE_PIECES = 32_000         # characters plus merges, as the reference


@register("bpe_train")
def q_bpe_train(spark, sf):
    m, _ = train_bpe(T(spark, sf, "documents").select("doc_id", "text"), vocab_size=BPE_PIECES)
    return m


@register("bpe_encode")
def q_bpe_encode(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", "text")
    m, v = train_bpe(d, vocab_size=BPE_PIECES)
    return bpe_encode(d, m, v).select("doc_id", F.size("input_ids").alias("n_ids"),
                                      content_hash(ids_to_text("input_ids")).alias("ids_sha256"))


@register("vocab_size", f"""WITH {VOCAB_SQL.replace('@SRC@', 'documents')}
SELECT CAST(count(*) AS BIGINT) AS vocab_size FROM vocab""")
def q_vocab_size(spark, sf):
    return vocab_size(whitespace_vocab(T(spark, sf, "documents")))


# ---------------------------------------------------------------- M1-M4
from quire.streaming import incremental as M  # noqa: E402


def _feed(spark, sf, name, order):
    """The table as a stream of at least three files, one per micro-batch."""
    t = T(spark, sf, name)
    return M.drop_stream(spark, M.drops(t, order), t.schema)


@register("stream_ingest", f"""WITH ex AS (SELECT page_id AS doc_id, {S.strip(S.extract_text('html'))} AS text FROM pages)
SELECT doc_id, sha256({S.scrub(S.collapse('text'))}) AS text_sha256 FROM ex WHERE text <> ''""")
def q_stream_ingest(spark, sf):
    out = M.run_to_table(M.ingest(_feed(spark, sf, "pages", "page_id")))
    return out.select("doc_id", content_hash("text").alias("text_sha256"))


@register("stream_dedupe", f"""WITH {LINES_SQL} SELECT DISTINCT sha256(text) AS h FROM lines""")
def q_stream_dedupe(spark, sf):
    s = _feed(spark, sf, "documents", "doc_id").select("doc_id", collapse_lines(py_strip("text")).alias("text"))
    return M.StreamDedupe(spark).run(s).select("h")


@register("stream_counters", f"""WITH {LINES_SQL},
u AS (SELECT doc_id, 'raw' AS stage, strlen(text) AS b FROM documents
      UNION ALL SELECT doc_id, 'kept', strlen(text) FROM lines
      UNION ALL SELECT doc_id, 'long', strlen(text) FROM lines WHERE {S.token_count('text')} >= 100)
SELECT doc_id % 3 AS shard, stage, CAST(count(*) AS BIGINT) AS docs, CAST(sum(b + 1) AS BIGINT) AS bytes FROM u GROUP BY ALL""")
def q_stream_counters(spark, sf):
    s = _feed(spark, sf, "documents", "doc_id")
    x = s.select((F.col("doc_id") % 3).alias("shard"), "text", py_strip("text").alias("_t"))
    x = x.select("shard", "text", collapse_lines("_t").alias("line"))
    kept = F.col("line") != ""
    stages = {"raw": (F.lit(True), "text"), "kept": (kept, "line"), "long": (kept & (token_count("line") >= 100), "line")}
    return M.run_to_table(M.stage_counts(x, stages, by=["shard"]), mode="update", keys=["shard", "stage"])


@register("stream_pack", f"""WITH {LINES_SQL}, {DEDUP_SQL}, {VOCAB_SQL.replace('@SRC@', 'dd')},
{ENCODE_SQL.replace('@SRC@', 'dd')},
g AS (SELECT id, row_number() OVER (ORDER BY doc_id, pos) - 1 AS gpos FROM toks JOIN vocab USING (token)),
w AS (SELECT gpos // 64 AS seq_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY gpos) AS ids, count(*) AS n
      FROM g GROUP BY gpos // 64)
SELECT CAST(seq_id AS BIGINT) AS seq_id, ids FROM w WHERE n = 64""")
def q_stream_pack(spark, sf):
    tune(spark)
    d = store(exact_dedupe(docs_lines(spark, sf)), "docs")
    p = M.StreamPacker(spark, whitespace_vocab(d), 64)
    s = M.drop_stream(spark, M.drops(d, "doc_id"), d.schema)
    return p.run(s).select("seq_id", ids_to_text("input_ids").alias("ids"))


# ---------------------------------------------------------------- A1-A10, B1-B6: written and read back
from quire.sources import readers as R, sinks as K  # noqa: E402


@register("roundtrip_dump", """SELECT row_number() OVER (ORDER BY page_id) - 1 AS ord, url, sha256(html) AS html_sha256
FROM pages WHERE html <> ''""")
def q_roundtrip_dump(spark, sf):
    """B1 + A2: every page as a dump record, read back in order."""
    path = M.scratch(spark, "dump")
    pages = T(spark, sf, "pages")
    K.write_text(pages.select("page_id", K.page_dump_value().alias("value")), path, order="page_id")
    back = R.read_page_dump(spark, path)
    return back.select("ord", "url", content_hash("html").alias("html_sha256"))


@register("roundtrip_sentinel", f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS ord, sha256(text) AS text_sha256
FROM (SELECT doc_id, {S.strip('text')} AS text FROM documents) WHERE text <> ''""")
def q_roundtrip_sentinel(spark, sf):
    """B2 + A3: every document as sentinel text, read back."""
    path = M.scratch(spark, "sentinel")
    docs = T(spark, sf, "documents")
    K.write_text(docs.select("doc_id", K.sentinel_value().alias("value")), path, order="doc_id")
    back = R.read_sentinel_docs(spark, path)
    x = dense_index(back.withColumnRenamed("doc_id", "_o"), ["_o"], out="ord")
    return x.select("ord", content_hash("text").alias("text_sha256"))


@register("roundtrip_lines", f"""WITH {LINES_SQL}
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS ord, sha256(trim(text, {S.WS_CHARS})) AS text_sha256 FROM lines""")
def q_roundtrip_lines(spark, sf):
    """B3 + A4: one document per line."""
    path = M.scratch(spark, "lines")
    K.write_text(docs_lines(spark, sf).select("doc_id", F.col("text").alias("value")), path, order="doc_id")
    back = R.read_line_docs(spark, path)
    return back.select(F.col("doc_id").alias("ord"), content_hash("text").alias("text_sha256"))


@register("roundtrip_seq", f"""WITH {VOCAB_SQL.replace('@SRC@', 'documents')}, {ENCODE_SQL.replace('@SRC@', 'documents')},
e AS (SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids FROM toks JOIN vocab USING (token) GROUP BY doc_id)
SELECT row_number() OVER (ORDER BY doc_id % 4, doc_id) - 1 AS seq_id, sha256(ids) AS ids_sha256 FROM e""")
def q_roundtrip_seq(spark, sf):
    """B4, B5 + A5, A7: ids of four shards in numbered files, read back strictly
    in the order of the manifest."""
    path = M.scratch(spark, "seq")
    d = T(spark, sf, "documents").select("doc_id", "text")
    enc = encode(d, whitespace_vocab(d)).where(F.size("input_ids") > 0)
    x = enc.select("doc_id", (F.col("doc_id") % 4).cast("int").alias("shard"), ids_to_text("input_ids").alias("value"))
    K.write_shard_files(materialize(x), path, "ids", order="doc_id")
    back = R.read_sequence_shards(spark, path, "ids")
    return back.select("seq_id", content_hash(ids_to_text("input_ids")).alias("ids_sha256"))


@register("split_documents", f"""WITH p AS (SELECT page_id, {S.extract_text('html')} AS t FROM pages),
s AS (SELECT page_id, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM p),
k AS (SELECT page_id, i, {S.strip('x')} AS text FROM s)
SELECT row_number() OVER (ORDER BY page_id, i) - 1 AS doc_id, sha256(text) AS text_sha256 FROM k WHERE text <> ''""")
def q_split_documents(spark, sf):
    """The blocks of every page as documents of their own."""
    p = pages_to_documents(T(spark, sf, "pages"))
    return split_documents(p, marker="\n").select("doc_id", content_hash("text").alias("text_sha256"))


@register("tolerant_sequences", f"""WITH t AS (SELECT doc_id, list_transform({S.tokens('text')}, lambda t: TRY_CAST(t AS BIGINT)) AS k FROM documents)
SELECT CAST(count(*) FILTER (WHERE len(list_filter(k, lambda x: x IS NULL)) = 0) AS BIGINT) AS good,
       CAST(count(*) FILTER (WHERE len(list_filter(k, lambda x: x IS NULL)) > 0) AS BIGINT) AS rejected
FROM t WHERE len(k) > 0""")
def q_tolerant_sequences(spark, sf):
    """A6 + D8: document lines read as id lines; malformed ones are rejected."""
    path = M.scratch(spark, "badseq")
    K.write_text(docs_lines(spark, sf).select("doc_id", F.col("text").alias("value")), path, order="doc_id")
    good, bad = reject_malformed(R.read_sequences(spark, path, tolerant=True))
    both = good.select(F.lit(True).alias("ok")).unionByName(bad.select(F.lit(False).alias("ok")))
    return both.agg(F.count_if(F.col("ok")).alias("good"), F.count_if(~F.col("ok")).alias("rejected"))


# ---------------------------------------------------------------- H3, I2, G5, L2, L4
from quire.operators.pack import with_labels  # noqa: E402
from quire.operators.vocab import add_special_tokens, special_ids  # noqa: E402
from quire.plans.prep import STRICT  # noqa: E402

PACK_OLD_SQL = PACK_SQL.replace("floor(count(*) OVER () * 0.9)", "floor(count(*) OVER () * 0.99)").replace("@L@", "4096")


@register("pack_older", PACK_OLD_SQL)
def q_pack_older(spark, sf):
    """H3: the older packer — 4096-id windows, ``int(0.99 * n)`` documents to train."""
    d = exact_dedupe(docs_lines(spark, sf))
    _, packed = tokenize_and_pack(d, PrepConfig(seq_len=4096, train_frac=0.99))
    return packed.select("split", "seq_id", ids_to_text("input_ids").alias("ids"))


@register("split_shard_report", PACK_SQL.replace("@L@", "64").replace(
    "SELECT split, CAST(seq_id AS BIGINT) AS seq_id, ids FROM w WHERE n = 64",
    """, f AS (SELECT split, ids, CAST((row_number() OVER (PARTITION BY split ORDER BY seq_id) - 1) % 3 AS INTEGER) AS shard
   FROM w WHERE n = 64)
SELECT split, shard, CAST(count(*) AS BIGINT) AS lines, CAST(sum(strlen(ids) + 1) AS BIGINT) AS bytes FROM f GROUP BY split, shard"""))
def q_split_shard_report(spark, sf):
    """``wc -l`` / ``wc -c`` of the .seq outputs per (split, shard)."""
    _, packed = packed_docs(spark, sf, 64)
    lines = packed.select("split", "seq_id", ids_to_text("input_ids").alias("text"))
    sharded = shard_mod(lines, ["seq_id"], 3, group=["split"])
    return lines_bytes(sharded, by=("split", "shard"))


@register("written_report", PACK_SQL.replace("@L@", "64").replace(
    "SELECT split, CAST(seq_id AS BIGINT) AS seq_id, ids FROM w WHERE n = 64",
    """, f AS (SELECT split, n, ids, (row_number() OVER (PARTITION BY split ORDER BY seq_id) - 1) % 3 AS shard FROM w WHERE n = 64),
d AS (SELECT s.shard, t.split, t.o FROM range(4) s(shard), (VALUES ('train', 0), ('test', 1)) t(split, o)),
c AS (SELECT shard, split, o, count(ids) AS l, CAST(coalesce(sum(strlen(ids) + 1), 0) AS BIGINT) AS b,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS k FROM d LEFT JOIN f USING (shard, split) GROUP BY shard, split, o),
u AS (SELECT 0 AS p, 0 AS shard, 0 AS o, ' type  | shard | lines | bytes' AS value
  UNION ALL SELECT 1, shard, o, printf('%6s | %5d | %5d | %5d', split, shard, l, b) FROM c
  UNION ALL SELECT 2, shard, 0, printf(' Thread %d: %d tokens', shard, k) FROM c WHERE split = 'train'
  UNION ALL SELECT 3, 0, 0, printf(' Total tokens across all threads: %d', CAST(sum(k) AS BIGINT)) FROM c WHERE split = 'train')
SELECT row_number() OVER (ORDER BY p, shard, o) - 1 AS ord, value FROM u"""))
def q_written_report(spark, sf):
    """The end report over four shards (the last without rows), written as text and read back."""
    _, packed = packed_docs(spark, sf, 64)
    path = M.scratch(spark, "report")
    K.write_text(end_report(shard_mod(packed, ["seq_id"], 3, group=["split"]), 4), path, order="ord")
    return R.read_text_ordered(spark, path).select("ord", "value")


# The special-token contents of the source's map.
SPECIALS = [("bos_token", "<|begin_of_text|>"), ("eos_token", "<|end_of_text|>")]


@register("vocab_special", f"""WITH {VOCAB_SQL.replace('@SRC@', 'documents')}, n AS (SELECT count(*) AS v FROM vocab)
SELECT CAST((SELECT v FROM n) AS BIGINT) AS bos_id, CAST((SELECT v FROM n) + 1 AS BIGINT) AS eos_id,
 CAST((SELECT v FROM n) + 1 AS BIGINT) AS pad_id, CAST((SELECT v FROM n) + 2 AS BIGINT) AS vocab_size""")
def q_vocab_special(spark, sf):
    """G4 + G5: specials appended after the corpus vocabulary; pad falls back to eos."""
    sp = spark.createDataFrame(SPECIALS, "name string, content string")
    v = add_special_tokens(whitespace_vocab(T(spark, sf, "documents")), sp)
    ids = special_ids(v, sp)
    n = vocab_size(v).first()[0]
    return ids.select("bos_id", "eos_id", "pad_id",
                      F.lit(n).cast("bigint").alias("vocab_size"))


def _strict_sql():
    near = SHINGLE_SQL.replace("FROM documents)", "FROM dd)")
    return f"""WITH RECURSIVE {LINES_SQL},
kw AS (SELECT * FROM lines WHERE doc_id IN ({_kw_sql(SECURITY_KEYWORDS)})),
ml AS (SELECT doc_id, text FROM kw WHERE {S.token_count('text')} >= 100),
dd AS (SELECT min(doc_id) AS doc_id, text FROM ml GROUP BY sha256(text), text),
{near},
e AS (SELECT a AS u, b AS v FROM sim UNION SELECT b, a FROM sim),
r(node, reach) AS (SELECT u, u FROM e UNION SELECT r.node, e.v FROM r JOIN e ON e.u = r.reach),
lab AS (SELECT node, min(reach) AS label FROM r GROUP BY node),
sc AS (SELECT doc_id, {S.scrub('text')} AS text FROM dd WHERE doc_id NOT IN (SELECT node FROM lab WHERE node <> label)),
{_pack_sql('sc', 4096)}
SELECT split, CAST(seq_id AS BIGINT) AS seq_id, sha256(ids) AS ids_sha256 FROM w WHERE n = 4096"""


def _pack_sql(src, length):
    """CTEs from scrubbed documents ``src`` to windows ``w``."""
    return f"""{VOCAB_SQL.replace('@SRC@', src)},
sp AS (SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 < floor(count(*) OVER () * 0.9)
       THEN 'train' ELSE 'test' END AS split FROM {src}),
{ENCODE_SQL.replace('@SRC@', src)},
g AS (SELECT split, id, row_number() OVER (PARTITION BY split ORDER BY doc_id, pos) - 1 AS gpos
      FROM toks JOIN vocab USING (token) JOIN sp USING (doc_id)),
w AS (SELECT split, gpos // {length} AS seq_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY gpos) AS ids, count(*) AS n
      FROM g GROUP BY split, gpos // {length})"""


@register("strict_corpus", _strict_sql())
def q_strict_corpus(spark, sf):
    """L2: keywords + min length 100 + near-dup 0.8 + 4096 windows, on the
    documents."""
    st = clean_documents(T(spark, sf, "documents").select("doc_id", "text"), STRICT)
    _, packed = tokenize_and_pack(st["scrubbed"], STRICT)
    return packed.select("split", "seq_id", content_hash(ids_to_text("input_ids")).alias("ids_sha256"))


# ---------------------------------------------------------------- L1
PAGES_SQL = FUNNEL_SQL[len("WITH "):FUNNEL_SQL.index(",\nu AS")]


@register("pipeline_default", f"""WITH {PAGES_SQL}, {_pack_sql('sc', 64)}
SELECT split, CAST(seq_id AS BIGINT) AS seq_id, ids FROM w WHERE n = 64""")
def q_pipeline_default(spark, sf):
    """L1: pages -> extract -> collapse -> dedupe -> scrub -> split -> encode
    -> windows of 64, ids in the output."""
    st = prepare_corpus(T(spark, sf, "pages"))
    return st["packed"].select("split", "seq_id", ids_to_text("input_ids").alias("ids"))


@register("pipeline_sharded", f"""WITH ex AS (SELECT page_id AS doc_id, page_id % 4 AS shard, {S.extract_text('html')} AS text FROM pages),
fl AS (SELECT doc_id, shard, {S.collapse(S.strip('text'))} AS text FROM ex WHERE {S.strip('text')} <> ''),
dd AS (SELECT min(doc_id) AS doc_id, shard, text FROM fl GROUP BY shard, text),
sc AS (SELECT doc_id, shard, {S.scrub('text')} AS text FROM dd),
{VOCAB_SQL.replace('@SRC@', 'sc')},
sp AS (SELECT doc_id, shard, CASE WHEN row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1
       < floor(count(*) OVER (PARTITION BY shard) * 0.9) THEN 'train' ELSE 'test' END AS split FROM sc),
{ENCODE_SQL.replace('@SRC@', 'sc')},
g AS (SELECT shard, split, id, row_number() OVER (PARTITION BY shard, split ORDER BY doc_id, pos) - 1 AS gpos
      FROM toks JOIN vocab USING (token) JOIN sp USING (doc_id))
SELECT shard, split, CAST(gpos // 64 AS BIGINT) AS seq_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY gpos) AS ids
FROM g GROUP BY shard, split, gpos // 64 HAVING count(*) = 64""")
def q_pipeline_sharded(spark, sf):
    """The whole flow inside four shards of the pages (one vocabulary)."""
    pages = T(spark, sf, "pages").withColumn("shard", F.col("page_id") % 4)
    st = prepare_corpus(pages, PrepConfig(shard="shard"))
    return st["packed"].select("shard", "split", "seq_id", ids_to_text("input_ids").alias("ids"))


@register("pipeline_counts", f"""WITH {PAGES_SQL}, {_pack_sql('sc', 64)}
SELECT 0 AS step, 'extracted' AS stage, CAST(count(*) AS BIGINT) AS n, CAST(sum(strlen(text)) AS BIGINT) AS size FROM ex
UNION ALL SELECT 1, 'filtered', count(*), CAST(sum(strlen(text)) AS BIGINT) FROM fl
UNION ALL SELECT 2, 'deduped', count(*), CAST(sum(strlen(text)) AS BIGINT) FROM dd
UNION ALL SELECT 3, 'scrubbed', count(*), CAST(sum(strlen(text)) AS BIGINT) FROM sc
UNION ALL SELECT 4, 'vocab', count(*), CAST(sum(freq) AS BIGINT) FROM vocab
UNION ALL SELECT 5, 'packed', count(*), CAST(sum(n) AS BIGINT) FROM w WHERE n = 64""")
def q_pipeline_counts(spark, sf):
    """L1 counts: documents and bytes per stage, vocabulary, sequences and ids."""
    st = prepare_corpus(T(spark, sf, "pages"))
    sizes = {"extracted": F.octet_length("text"), "filtered": F.octet_length("text"), "deduped": F.octet_length("text"),
             "scrubbed": F.octet_length("text"), "vocab": F.col("freq"), "packed": F.size("input_ids")}
    out = None
    for i, (name, size) in enumerate(sizes.items()):
        x = st[name].agg(F.count(F.lit(1)).alias("n"), F.sum(size.cast("bigint")).alias("size"))
        x = x.select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "n", "size")
        out = x if out is None else out.unionByName(x)
    return out


TRAIN_PREP_SQL = PACK_SQL.replace("@L@", "64").replace(
    "SELECT split, CAST(seq_id AS BIGINT) AS seq_id, ids FROM w WHERE n = 64",
    """, t AS (SELECT seq_id, ids, n, row_number() OVER (ORDER BY seq_id) - 1 AS ix FROM w WHERE n = 64 AND split = 'train')
SELECT CAST(ix // 8 AS BIGINT) AS batch_id, CAST(ix % 8 AS INTEGER) AS row, CAST(seq_id AS BIGINT) AS seq_id,
 CAST(max(n) OVER (PARTITION BY ix // 8) AS INTEGER) AS width, sha256(ids) AS ids_sha256, sha256(ids) AS labels_sha256 FROM t""")


@register("train_prep", TRAIN_PREP_SQL)
def q_train_prep(spark, sf):
    """L4: packed sequences -> samples with labels -> padded batches of 8."""
    _, packed = packed_docs(spark, sf, 64)
    tr = with_labels(packed.where(F.col("split") == "train"))
    b = batch_and_pad(tr, 8)
    return b.select("batch_id", "row", "seq_id", "width", content_hash(ids_to_text("input_ids")).alias("ids_sha256"),
                    content_hash(ids_to_text("labels")).alias("labels_sha256"))
