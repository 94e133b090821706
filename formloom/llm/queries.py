"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, langid, lm, mixture, order_minhash, packing, pii, quality, simhash, token_rollup
from ._shared import Scratch, tables


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(tables(spark, sf_dir, "documents"), width=4, radius=4)


def op2_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture.mix(tables(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(tables(spark, sf_dir, "documents"))


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compared(tables(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "labels"))


def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches over all documents: words counted, four-character groups counted, all but the first
    of equal texts deleted, and words revised where lines repeat, to those of the distinct lines."""
    docs = tables(spark, sf_dir, "documents")
    store = token_rollup.Rollup(spark, Scratch(spark, "rollup").root)
    words = token_rollup.counted(docs, "words", "insert")
    store.commit("words", words)
    store.commit("words", words)  # the second time does nothing
    store.commit("quads", token_rollup.counted(docs, "quads", "insert"))
    texts = docs.select("doc_id", "source", "lang", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("sum"))
    firsts = texts.groupBy("sum").agg(F.min("doc_id").alias("first"))
    again = texts.join(firsts.withColumnRenamed("first", "doc_id"), ["sum", "doc_id"], "left_anti")
    none = F.lit(None)
    store.commit("copies", again.select(F.lit("delete").alias("op"), "doc_id", "source", "lang", none.cast("string").alias("version"), none.alias("tokens"), none.alias("chars")))
    lines = docs.withColumn("lines", F.split("text", "\n", -1)).withColumn("own", F.array_distinct("lines")).where(F.size("own") < F.size("lines"))
    store.commit("lines", token_rollup.counted(lines.withColumn("text", F.array_join("own", "\n")), "words", "revise"))
    return store.totals()


TOKEN_ROLLUP_SQL = r"""
WITH firsts AS (
  SELECT *, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
  QUALIFY row_number() OVER (PARTITION BY md5(coalesce(text, '')) ORDER BY doc_id) = 1
), texts AS (
  SELECT source, lang, 'words' AS version,
         CASE WHEN len(list_distinct(lines)) < len(lines) THEN array_to_string(list_distinct(lines), chr(10)) ELSE text END AS text FROM firsts
  UNION ALL SELECT source, lang, 'quads', text FROM firsts
)
SELECT source, lang, version, count(*)::BIGINT AS docs,
       sum(CASE WHEN version = 'words' THEN coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)
                ELSE ceil(coalesce(length(text), 0) / 4) END)::BIGINT AS tokens,
       sum(coalesce(length(text), 0))::BIGINT AS chars
FROM texts GROUP BY source, lang, version
"""


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(tables(spark, sf_dir, "embeddings"), "vec_id", "embedding", lambda i: i % 20 == 0)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(tables(spark, sf_dir, "documents"), pii.key_of(spark)).select("doc_id", "text", "n_entities")


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm.score(tables(spark, sf_dir, "documents"))
    return scores.select("doc_id", "n_words", F.round("score", 5).alias("score"), F.round("mean_score", 6).alias("mean_score"))


#: Counts of words and pairs without the document's own; '' is the start mark.
LM_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), tokens AS (SELECT r, unnest(w) AS b, unnest(list_prepend('', w[:-2])) AS a FROM docs WHERE len(w) > 0
), words AS (SELECT b AS w, r, count(*) AS n FROM tokens GROUP BY ALL UNION ALL SELECT '', r, 1 FROM docs WHERE len(w) > 0
), pairs AS (SELECT a, b, r, count(*) AS n FROM tokens GROUP BY ALL
), own AS (SELECT r, w, n, sum(n) OVER (PARTITION BY w) - n AS c FROM words
), total AS (SELECT sum(len(w)) AS n FROM docs
), each AS (
  SELECT p.r, p.n, p.c AS pair, x.c AS context, y.c AS word, greatest((SELECT n FROM total) - len(d.w), 1) AS others
  FROM (SELECT *, sum(n) OVER (PARTITION BY a, b) - n AS c FROM pairs) p JOIN own x ON x.r = p.r AND x.w = p.a JOIN own y ON y.r = p.r AND y.w = p.b JOIN docs d ON d.r = p.r
), sums AS (
  SELECT r, sum(n * CASE WHEN pair > 0 THEN log10(pair::DOUBLE / context) ELSE log10(0.4::DOUBLE) + log10(CASE WHEN word > 0 THEN word::DOUBLE ELSE 0.4::DOUBLE END / others) END) AS s FROM each GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, round(coalesce(s, 0), 5) AS score, round(s / len(w), 6) AS mean_score FROM docs LEFT JOIN sums USING (r)
"""


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text", "lang", langid.held_out().alias("held_out"))
    prototypes = langid.learn(docs.where("not held_out"))
    return langid.predict(docs, prototypes, keep=("doc_id", "held_out"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_mixture": op2_mixture,
    "op3_packing": op3_packing,
    "op4_quality": op4_quality,
    "op5_token_rollup": op5_token_rollup,
    "op6_ann": op6_ann,
    "op7_pii": op7_pii,
    "op8_lm": op8_lm,
    "op9_order_minhash": op9_order_minhash,
    "op10_langid": op10_langid,
}
ORACLE_SQL: dict[str, str] = {"op5_token_rollup": TOKEN_ROLLUP_SQL, "op8_lm": LM_SQL}
