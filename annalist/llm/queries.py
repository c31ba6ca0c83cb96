"""One thin query for each operator: its whole table in, its whole result out."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm import bpe, conversations, decontamination, exact, fingerprints, jaccard, lines, negatives, spelling, token_counts, toxicity, url_filters, warc
from annalist.llm.common import owned, read, scratch

SQL: dict[str, str] = {}

RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, sf_dir, "documents"), 3, (9, 10))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.link_quotes(read(spark, sf_dir, "conversations"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL["op3_line_dedup"] = """
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM t),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, coalesce(c.keeper <> k.doc_id, FALSE) AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").where(~toxicity.held_out()).select("doc_id", F.col("toxic").alias("label"))
    found = toxicity.score(docs, toxicity.fit(docs, labels))
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "neighbours")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_leaks(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.item_id", "x.cosine", "x.share")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(read(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return url_filters.judge(read(spark, sf_dir, "pages"), labels, RULES)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write(warc.resolve(warc.capture(read(spark, sf_dir, "pages"))), path)
    owned(spark, path)
    found = warc.read(spark, path, payloads=False)
    return found.select(F.col("id").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")


SQL["op9_warc"] = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT payload_digest, min(page_id) AS original FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN p.page_id <> o.original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id <> o.original THEN o.original END AS refers_to
FROM p LEFT JOIN o ON p.payload_digest = o.payload_digest AND p.payload_bytes >= 100
"""


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), keep_ids=False).drop("text")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"), damage=97)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), label.alias("label"), negatives.quantised(F.col("embedding")).alias("vector"))
    return negatives.mine(vectors, F.col("id") % 100 == 0)


SQL["op12_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, CAST(list_dot_product(a.c, b.c) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.alike AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup(read(spark, sf_dir, "documents"))


SQL["op13_exact_dedup"] = """
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS content FROM documents),
g AS (SELECT content, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM t GROUP BY content)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.content) AS text_sha256 FROM t JOIN g ON t.content = g.content
"""
