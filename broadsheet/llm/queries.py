"""The operators' queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import (
    bytepair,
    embedding_dedup,
    exact_dedup,
    hard_negatives,
    langid,
    mixing,
    packing,
    quality,
    resampling,
    secret_scan,
    simhash,
    toxicity,
    warc,
)
from broadsheet.llm.common import in_fold, table


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.DigestIndex(spark)
    out = index.deduplicate(table(spark, sf_dir, "documents"))
    index.close()
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP2_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC) = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


#: Target shares of tokens by domain, the classes of the labels table.
MIX_WEIGHTS = {"clean": 0.94, "noisy": 0.04, "toxic": 0.02}


def domain_of_labels():
    toxic, quality = F.col("toxic").cast("int"), F.col("quality").cast("int")
    return F.when(toxic == 1, "toxic").when(quality == 0, "noisy").when(quality == 1, "clean")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = mixing.fit_domains(docs, table(spark, sf_dir, "labels"), domain_of_labels())
    rows, _ = mixing.mix(docs, model, MIX_WEIGHTS)
    return rows.select("doc_id", "tokens", "posteriors", "domain", "rate", "copies")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    read = warc.read_back(warc.archive(pages), payloads=False)
    number = lambda c: F.nullif(F.col(c), F.lit("")).cast(kind).alias(c)
    return read.select(number("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def _folds(folds: int, held_out: int):
    return (lambda c: ~in_fold(c, folds, held_out)), in_fold(F.col("doc_id"), folds, held_out).alias("held_out")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn, held_out = _folds(5, 0)
    found = langid.identify(docs, langid.train(docs, learn(docs["doc_id"])))
    return found.select("doc_id", held_out, "lang_pred", "score", "margin", "accepted")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn, held_out = _folds(5, 0)
    found = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), learn))
    return found.select("doc_id", held_out, "score", "predicted")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn, held_out = _folds(4, 2)
    found = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels"), learn))
    return found.select("doc_id", held_out, "score", "predicted")


BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bytepair.encode(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    out = bytepair.decode(encoded, BYTE_RANKS, public_tokenizers.PATTERN)
    line = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(line, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(rows["vec_id"] % 7 == 0, (rows["label"] + 1) % 10).otherwise(rows["label"])
    rows = rows.select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(rows, rows["vec_id"] % 100 == 0)


#: Brute force over all pairs.
OP12_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM n WHERE rank <= 10
"""


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


#: crc32 is a table of 256 remainders and one step a byte, for the distinct words only.
OP13_SQL = r"""
WITH crc AS (SELECT list_transform(range(256), lambda c: list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
v AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
a AS (SELECT doc_id, unnest(ws) AS word FROM w), b AS (SELECT unnest(ws) AS word FROM v),
k AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(word))), lambda i: ('0x' || substr(hex(word), 2 * i::INTEGER + 1, 2))::BIGINT)),
  lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 10000 AS bucket FROM (SELECT word FROM a UNION SELECT word FROM b), crc),
s AS (SELECT bucket, count(*) AS s FROM a JOIN k USING (word) GROUP BY 1), t AS (SELECT bucket, count(*) AS t FROM b JOIN k USING (word) GROUP BY 1),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM a) + 10000)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM b) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
d AS (SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM a JOIN k USING (word) JOIN g USING (bucket) GROUP BY 1),
z AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN d USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM z WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM r) * 10 // 100 THEN rank END AS rank FROM z LEFT JOIN r USING (doc_id)
"""

QUERIES = {f.__name__: f for f in (op1_packing, op2_exact_dedup, op3_mixing, op4_warc, op5_simhash_near_dedup, op6_language_id, op7_toxicity, op8_embedding_near_dedup, op9_secret_scan, op10_quality, op11_byte_bpe, op12_hard_negatives, op13_importance_resampling)}
OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, list_reduce(list_transform(range(8), lambda i: list_reduce(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  ((('0x' || substr(h, i::INTEGER * 5 + 1, 5))::INTEGER >> s) & 31) + 1, 1)), lambda a, b: a || b)), lambda a, b: a || b) AS payload_digest FROM p)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, payload_digest, CASE WHEN page_id = max(page_id) OVER g THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER g THEN max(page_id) OVER g END AS refers_to
FROM d WINDOW g AS (PARTITION BY h)
"""
#: Brute force over all pairs.
OP8_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
u AS (SELECT vec_id, v FROM e WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a, u b WHERE a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
r(a, b) AS (SELECT vec_id, vec_id FROM e UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM c
"""
ORACLES = {"op2_exact_dedup": OP2_SQL, "op4_warc": OP4_SQL, "op8_embedding_near_dedup": OP8_SQL, "op12_hard_negatives": OP12_SQL, "op13_importance_resampling": OP13_SQL}
