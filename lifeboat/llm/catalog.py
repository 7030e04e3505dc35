"""The queries of the operators, and their DuckDB SQL where SQL can state them."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeboat.llm import byte_bpe, centroid_cluster, chat, decontaminate, divergence, exact_dedup, html_extract, packing, secret_scan, simhash, substring_dedup, token_count, toxicity
from lifeboat.llm.common import file_row, table

QUERIES: dict = {}
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


_CHAT_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
e AS (SELECT t.*, p.perspective,
             CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role,
             CASE WHEN speaker <> 'system' AND speaker <> perspective THEN speaker END AS name
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, '{chat.START}' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM e)
SELECT conv_id, perspective, turn, role, name, head || text || '{chat.END}' || chr(10) AS rendered,
       CASE WHEN role = 'assistant' THEN length(head) ELSE 0 END AS loss_start,
       CASE WHEN role = 'assistant' THEN length(head) + length(text) + {len(chat.END)} ELSE 0 END AS loss_end,
       role = 'assistant' AS trained
FROM h
"""


@query("op1_chat_rotation", _CHAT_SQL)
def op1_chat_rotation(spark: SparkSession, sf: str) -> DataFrame:
    return chat.rotate(table(spark, sf, "conversations"))


@query("op2_best_fit")
def op2_best_fit(spark: SparkSession, sf: str) -> DataFrame:
    return packing.best_fit(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


@query("op3_token_count")
def op3_token_count(spark: SparkSession, sf: str) -> DataFrame:
    counts = token_count.count_tokens(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))
    return counts.withColumnRenamed("id", "doc_id")


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = simhash.near_duplicates(docs, row=file_row(docs))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query("op5_decontaminate")
def op5_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = decontaminate.leaks(docs, table(spark, sf, "benchmark"), row=file_row(docs))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.round("cosine", 4).alias("cosine"),
                        F.round("lcs", 6).alias("lcs"), F.round("answer", 6).alias("answer"), "start_word", "end_word")


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"), F.col("toxic"))
    scored = docs.select("doc_id", toxicity.severity(model, toxicity.text_or_empty("text")).alias("s"))
    return scored.select("doc_id", "s.severity", "s.p_toxic", "s.grade", (F.col("s.p_toxic") >= 0.5).alias("rejected"))


@query("op7_substring_dedup")
def op7_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = substring_dedup.remove_repeats(docs, row=file_row(docs))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@query("op8_html_extract")
def op8_html_extract(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return html_extract.extract(pages, row=file_row(pages)).withColumnRenamed("id", "page_id")


def _secret_sql() -> str:
    kinds = secret_scan.BASE + secret_scan.ADDED
    q = lambda s: s.replace("'", "''")
    each = " UNION ALL ".join(f"""
SELECT doc_id, row_id, source, lang, {i} AS kind_no, '{k.name}' AS kind, no,
       list_sum(list_transform(gaps[1:no], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:no - 1], lambda x: length(x))), 0) AS st,
       length(whole[no]) AS len, val[no] AS value
FROM (SELECT doc_id, row_id, source, lang, string_split_regex(text, '{q(k.pattern)}') AS gaps,
             regexp_extract_all(text, '{q(k.pattern)}', 0) AS whole, regexp_extract_all(text, '{q(k.pattern)}', {k.group}) AS val
      FROM d), unnest(range(1, len(whole) + 1)) AS u(no)
WHERE length(val[no]) >= {k.least}""" for i, k in enumerate(kinds))
    base = "kind_no < 3"
    text = "string_agg(kind || ':' || CAST(st AS BIGINT) || ':' || CAST(st + len AS BIGINT), ',' ORDER BY st, kind_no)"
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row_id, source, lang, coalesce(text, '') AS text FROM documents),
s AS ({each}),
f AS (SELECT value, count(DISTINCT coalesce(source, '')) AS owners FROM s GROUP BY value),
g AS (SELECT row_id, count(*) FILTER (kind_no = 0) AS n_assign, count(*) FILTER (kind_no = 1) AS n_access,
             count(*) FILTER (kind_no = 2) AS n_hex, {text} FILTER ({base}) AS b, {text} AS spans,
             count(*) FILTER (owners >= {secret_scan.COPIED_OWNERS}) AS n_copied,
             count(*) FILTER (owners < {secret_scan.COPIED_OWNERS}) AS n_live
      FROM s JOIN f USING (value) GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_copied, 0) AS n_copied, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN g USING (row_id)
"""


@query("op9_secret_scan", _secret_sql())
def op9_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Owner: the source; repository: the source's part in one language."""
    found = secret_scan.secret_scan(table(spark, sf, "documents"), owner=F.col("source"),
                                    repository=F.concat_ws("/", "source", "lang"))
    n = lambda test: F.size(F.filter("found", test)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"), n(lambda s: s["kind_no"] == 0).alias("n_assign"),
        n(lambda s: s["kind_no"] == 1).alias("n_access"), n(lambda s: s["kind_no"] == 2).alias("n_hex"),
        F.sha2(secret_scan.spans_text(F.filter("found", lambda s: s["kind_no"] < 3)), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("found")).alias("spans"),
        n(lambda s: s["copied"]).alias("n_copied"), n(lambda s: ~s["copied"]).alias("n_live"))


@query("op10_exact_dedup", """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT doc_id, keep_id, group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST, r DESC) = 1 AS kept, sha256(text) AS text_sha256
FROM d JOIN g USING (text)
""")
def op10_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = exact_dedup.exact_dedup(docs, row=file_row(docs))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def _divergence_sql(s: divergence.Settings) -> str:
    share = lambda n, total: f"1 + (CAST({s.unit} AS HUGEINT) * ({n} + {s.smooth})) // ({total} + {s.smooth} * v)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {s.least_docs}),
l AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
n AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d)
      LEFT JOIN (SELECT lang, source, sum(n) AS total FROM n GROUP BY lang, source) USING (lang, source)),
f AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n, CAST({share("coalesce(n.n, 0)", "g.total")} AS BIGINT) AS p,
             CAST({share("k.lang_n", "l.lang_total")} AS BIGINT) AS q
      FROM g JOIN l ON l.lang = g.lang JOIN kept k ON k.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce((SELECT sum(abs(x.p - y.p)) FROM f x JOIN f y ON x.lang = y.lang AND x.term = y.term
                 WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
terms AS (SELECT lang, source, term AS item, p - q AS value FROM f WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank
FROM terms QUALIFY rank <= {s.top}
"""


@query("op12_source_divergence", _divergence_sql(divergence.Settings()))
def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))


@query("op13_byte_bpe")
def op13_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    coded = byte_bpe.decode(byte_bpe.encode(table(spark, sf, "documents"), ranks, pattern), ranks, pattern)
    return coded.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("bytes", 256).alias("decoded_sha256"))


def _cluster_sql(s: centroid_cluster.Settings) -> str:
    distance = "CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    assign = lambda n: f"""
a{n} AS (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT k.r, c.c, {distance} AS d FROM k, c{n} c) GROUP BY r)"""  # noqa: E731
    update = lambda n: f"""
m{n} AS (SELECT a.c, i, sum(k.v[i]) AS s, count(*) AS n FROM k JOIN a{n} a USING (r), unnest(range(1, {s.dimensions + 1})) AS u(i) GROUP BY a.c, i),
c{n + 1} AS (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN
             (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM m{n} GROUP BY c) m ON m.c = c.c)"""  # noqa: E731
    steps = ",".join(assign(n) + "," + update(n) for n in range(s.rounds)) + "," + assign(s.rounds)
    return f"""
WITH k AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({s.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE len(embedding) = {s.dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {s.dimensions}),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('{s.seed}:' || vec_id) NULLS LAST, vec_id NULLS LAST, v) - 1 AS c, v FROM k QUALIFY c < {s.clusters}),{steps},
f AS (SELECT c, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a{s.rounds} GROUP BY c)
SELECT vec_id, CAST(a.c AS INT) AS cluster, a.d AS distance, cluster_inertia, (SELECT CAST(sum(d) AS BIGINT) FROM a{s.rounds}) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM k JOIN a{s.rounds} a USING (r) JOIN f ON f.c = a.c JOIN c{s.rounds} c ON c.c = a.c
"""


CLUSTERS = centroid_cluster.Settings()


@query("op11_centroid_cluster", _cluster_sql(CLUSTERS))
def op11_centroid_cluster(spark: SparkSession, sf: str) -> DataFrame:
    rows, clusters, _ = centroid_cluster.cluster(table(spark, sf, "embeddings"), CLUSTERS)
    total = sum(c["inertia"] for c in clusters)
    digest = [(c["cluster"], c["inertia"], total, hashlib.sha256(",".join(map(str, c["centroid"])).encode()).hexdigest()) for c in clusters]
    each = spark.createDataFrame(digest, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per cluster, at most CLUSTERS.clusters.
    return rows.join(F.broadcast(each), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
