"""The registered queries of this package and, where SQL can say it, their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleframe.llm import (
    ann, automaton, importance, mixing, passages, pii, quality, secrets, simhash, toxicity, warc, whitening, winnowing,
)
from ruleframe.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: The key of the pseudonyms where the session sets none in ``ruleframe.pii.key``.
PII_KEY = "set ruleframe.pii.key"


def _query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pii_key(spark: SparkSession) -> bytes:
    return spark.conf.get("ruleframe.pii.key", PII_KEY).encode()


def not_part(id: str, parts: int, left_out: int):
    """Rows whose crc32(id as text) leaves another remainder; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % parts != left_out


@_query("op1_feistel_pseudonyms")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise_documents(docs, pii_key(spark))


@_query("op2_winnowing_decontamination", r"""
WITH dw AS (SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(lower_ascii(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower_ascii(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS n FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS x FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
sizes AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT row_no, n, i, array_to_string(w[i:i + n - 1], ' ') AS x FROM (SELECT row_no, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hit AS (SELECT row_no, dwin.n, i, x FROM dwin WHERE EXISTS (SELECT 1 FROM win WHERE win.n = dwin.n AND win.x = dwin.x)),
cover AS (SELECT row_no, count(DISTINCT p) AS n_hit FROM (SELECT row_no, unnest(range(i, i + n)) AS p FROM hit) GROUP BY row_no),
named AS (SELECT row_no, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit JOIN win USING (n, x) GROUP BY row_no)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM dw LEFT JOIN cover USING (row_no) LEFT JOIN named USING (row_no)
""".replace("lower_ascii(text)", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"))
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), winnowing.is_contaminated().alias("contaminated"),
    )


@_query("op3_source_mixing", r"""
WITH d AS (SELECT doc_id, text, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 3.0::DOUBLE * source_size AS stop, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight FROM s),
o AS (SELECT *, (sum(source_size) OVER ())::DOUBLE AS total, coalesce(sum(stop) OVER (ORDER BY stop / weight, stop, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before,
  sum(weight) OVER (ORDER BY stop / weight, stop, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w WHERE source_size > 0),
l AS (SELECT max((total - before) / rest) AS level FROM o),
t AS (SELECT source, source_size, CASE WHEN source_size > 0 THEN least(stop, weight * level) ELSE 0.0 END AS target FROM w, l),
r AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
  CAST('0x' || substr(md5(concat_ws(':', '7', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0 AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * (CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS taken FROM r
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.plan_mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@_query("op4_simhash_groups")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["''']?\x20*[:=]\x20*["''']?([A-Za-z0-9+/_.=-]+)""".replace("'''", "''")
_FORMAT = secrets.FORMATS[1]


def _spans_sql(kind: str, order: int, pattern: str, group: str, least: int) -> str:
    return f"""SELECT row_no, source, doc_id, {order} AS ord, '{kind}' AS kind, unnest(range(1, len(v) + 1)) AS i, v, e, b, {least} AS least FROM (
  SELECT row_no, source, doc_id, regexp_extract_all(text, '{pattern}'{group}) AS v, regexp_extract_all(text, '{pattern}') AS e, string_split_regex(text, '{pattern}') AS b FROM d)"""


@_query("op5_secret_ownership", f"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, source, coalesce(text, '') AS text FROM documents),
m AS ({_spans_sql('assign', 0, _ASSIGN, ', 1', 6)} UNION ALL {_spans_sql('access', 1, 'AKIA[A-Z0-9]{16,}', '', 20)}
  UNION ALL {_spans_sql('hex', 2, '[0-9a-f]{24,}', '', 24)} UNION ALL {_spans_sql('format', 3, _FORMAT, '', 10)}),
s AS (SELECT row_no, doc_id, source, ord, kind, v[i] AS value, list_sum([len(x) FOR x IN b[1:i]]) + list_sum([len(x) FOR x IN e[1:i]]) AS e1, len(e[i]) AS n
  FROM m WHERE len(v[i]) >= least),
k AS (SELECT *, CAST(e1 - n AS BIGINT) AS s1, kind || ':' || CAST(CAST(e1 - n AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(e1 AS BIGINT) AS VARCHAR) AS span FROM s),
o AS (SELECT value, count(DISTINCT coalesce(source, chr(0))) AS owners,
  count(DISTINCT (coalesce(source, chr(0)), coalesce(CAST(doc_id AS VARCHAR), chr(0)))) AS repositories FROM k GROUP BY value),
j AS (SELECT k.*, repositories, CASE WHEN owners >= 3 OR repositories >= 50 THEN 'example' WHEN kind = 'format' OR (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND len(list_distinct(string_split(value, ''))) >= 8) THEN 'live' ELSE 'weak' END AS verdict
  FROM k JOIN o USING (value)),
a AS (SELECT row_no, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(span, ',' ORDER BY s1, ord) FILTER (ord < 3) AS base, string_agg(span, ',' ORDER BY s1, ord) AS spans,
  count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example, max(repositories) AS most_repositories FROM j GROUP BY row_no)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(most_repositories, 0) AS most_repositories FROM d LEFT JOIN a USING (row_no)
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@_query("op6_warc_records", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
bits AS (SELECT page_id, html, h, list_transform(range(0, 32), lambda i: CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) // CAST(power(32, 3 - i % 4) AS BIGINT) % 32) AS v FROM p),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, array_to_string(list_transform(v, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(x AS INTEGER) + 1, 1)), '') AS payload_digest,
  min(page_id) OVER (PARTITION BY h) AS first FROM bits)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to FROM d
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), path)
    return warc.read_pages(spark, path)


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    return toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"), not_part("doc_id", 3, 1))


#: Score from which a document counts as toxic.
TOXIC = 0.7


@_query("op7_toxicity_lexicon")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", (~not_part("doc_id", 3, 1)).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


@_query("op8_backoff_automaton")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = automaton.score_texts(_table(spark, sf_dir, "documents"), not_part("doc_id", 7, 2))
    return scored.select(
        F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@_query("op9_kmeans_tree")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ann.usable_vectors(_table(spark, sf_dir, "embeddings"))
    found = ann.nearest(vectors, vectors.where("id % 100 = 0"))
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), F.col("distance").alias("score"))


@_query("op10_compact_window_passages")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("start").alias("start_word"), F.col("end").alias("end_word"),
        F.col("passage").alias("class_id"), F.col("documents").alias("n_documents"),
    )


@_query("op11_quality_rules")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_report(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), *quality.COUNTS, "base_failed", "kept", "lang", "log_perplexity", "low", "high",
        "letter_perplexity", "letter_low", "letter_high",
    )


@_query("op12_importance_resampling", r"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(lower_ascii(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(lower_ascii(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS (SELECT row_no, unnest(flatten([[array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)] FOR k IN [1, 2, 3]])) AS x FROM d),
bf AS (SELECT unnest(flatten([[array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)] FOR k IN [1, 2, 3]])) AS x FROM b),
dn AS (SELECT row_no, x, count(*) AS n FROM df GROUP BY row_no, x),
f AS (SELECT DISTINCT x FROM (SELECT x FROM dn UNION ALL SELECT x FROM bf)),
bytes AS (SELECT x, hex(encode(x)) AS h FROM f),
steps AS (SELECT x, flatten([[CAST('0x' || substr(h, i, 2) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] FOR i IN range(1, len(h), 2)]) AS s FROM bytes),
k AS (SELECT x, xor(list_reduce(list_prepend(4294967295::BIGINT, s), lambda a, v: CASE WHEN v >= 0 THEN xor(a, v) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) % 10000 AS bucket FROM steps),
s AS (SELECT bucket, sum(n) AS s FROM dn JOIN k USING (x) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN k USING (x) GROUP BY bucket),
total AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::DOUBLE AS all_s, coalesce((SELECT sum(t) FROM t), 0)::DOUBLE AS all_t),
gains AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (all_s + 10000) / ((coalesce(s, 0)::DOUBLE + 1) * (all_t + 10000)))) AS BIGINT) AS gain
  FROM (SELECT unnest(range(10000)) AS bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), total),
weights AS (SELECT row_no, sum(n) AS n_features, sum(n * gain) AS weight FROM dn JOIN k USING (x) JOIN gains USING (bucket) GROUP BY row_no),
scored AS (SELECT row_no, doc_id, len(w) >= 20 AS eligible, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)::DOUBLE + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (row_no)),
ranked AS (SELECT *, row_number() OVER (ORDER BY coalesce(eligible, false) DESC, score DESC, doc_id NULLS LAST) AS number, count(*) FILTER (eligible) OVER () AS n FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN number <= 5 * n // 100 THEN CAST(number AS BIGINT) END AS rank FROM ranked
""".replace("lower_ascii(text)", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"))
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return importance.importance_resample(documents, benchmark).withColumnRenamed("id", "doc_id")


@_query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
