"""The corpus pipeline: language ID, line dedup, near-dedup, substring dedup, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenreel.llm import langid, line_templates, packing, probminhash, substring_dedup
from lumenreel.llm.common import discard, stored
from lumenreel.llm.queries import END_ID, WORD_BPE, packed_digest, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str, max_bits: float = 7.0) -> DataFrame:
    """Drops documents in no language: without a letter, or with bytes that the best language's
    model codes no shorter than noise."""
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    known = langid.predict(docs.select(*COLUMNS), model)
    return known.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("bits_per_byte") <= max_bits)).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring lines; no document goes."""
    out = line_templates.drop_recurring(docs.select(*COLUMNS)).withColumn("text", F.col("kept"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates: that with the least doc_id (null last),
    by id and text, so that different texts under one id stay; of rows that agree in both, one. All
    documents without words stay."""
    docs = docs.select(*COLUMNS)
    first = stored(probminhash.survivors(docs), "survivors")
    named = lambda c: F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit("-")).alias("_id")
    kept = docs.select("*", named("doc_id"), F.unhex(F.md5("text")).alias("_node")).join(first.select(named("rep"), F.col("node").alias("_node")), ["_id", "_node"], "left_semi")
    kept = kept if first.where("n > 1").isEmpty() else kept.dropDuplicates(["_node"])
    return kept.select(*COLUMNS).unionByName(docs.where(probminhash.wordless("text")))


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes words in repeated windows of 35 words. A text that has none is left as it is; no
    document goes."""
    out = substring_dedup.remove_repeated(docs.select(*COLUMNS))
    out = out.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 4096 tokens."""
    return packed_digest(packing.pack_texts(docs, public_tokenizers.path(WORD_BPE), END_ID))


STAGES = [
    ("language_id", identify),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_passages),
    ("packing", pack),
]

#: SQL can express neither the language models nor the signatures and the packing plan; the tests
#: hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        discard(*before)
        before = [docs]
    return docs
