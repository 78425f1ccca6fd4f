"""The corpus pipeline: quality rules, near-duplicate join, substring dedup, source mixing, packing.

Every stage reads what its predecessor wrote and returns the columns of documents, but the last, which returns
the packed pieces. All stages work on whole tables and whole texts.

Defined for every stage: an empty table gives an empty result; NULL ids, texts, languages and sources are values like
others where the stage does not say otherwise; columns beyond those of documents are ignored, whatever their names; very
long texts are worked on whole; repeated rows and ties fall as stated at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chanlake.llm import common, jaccard, mixing, packing, quality, substring
from chanlake.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame, text) -> DataFrame:
    return df.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: rejected documents go; lines above their host's limit are taken out of the others. NULL and empty
    texts have no words and go; a NULL source is a host of its own; repeated rows are judged alike, and their lines count
    once."""
    common.prepare(spark)
    judged = quality.judge(docs.select(*COLUMNS), keep=["lang"])
    return _documents(quality.kept_rows(judged), F.col("clean_text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group of linked documents the smallest id stays, once with each of its texts. Rows without an id
    link to nothing and all stay; texts too short for a shingle (NULL and empty too) link to nothing; of repeated rows of
    an id one stays."""
    common.prepare(spark)
    found = jaccard.join(docs).groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    # the texts move once, by id, at every size; repeated rows of an id then lie side by side and one of each text stays
    joined = docs.select(*COLUMNS).join(found.hint("merge"), "doc_id", "left")
    one = Window.partitionBy("doc_id", F.xxhash64("text"), F.xxhash64(F.lit(77), "text")).orderBy("doc_id")
    ranked = joined.filter(F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True))).withColumn(
        "copy", F.row_number().over(one))
    return ranked.filter((F.col("copy") == 1) | F.col("doc_id").isNull()).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: repeated passages are cut; a document that held nothing else goes. NULL and empty texts have no
    passages and stay; a text without id comes after all others; repeated rows of an id are cut alike."""
    common.prepare(spark)
    cut = substring.remove_passages(docs).filter("n_removed > 0").select(
        "doc_id", "text_key", "left_text", (F.col("n_words") == F.col("n_removed")).alias("empty")).dropDuplicates(
            ["doc_id", "text_key"])
    keyed = docs.select(*COLUMNS, F.xxhash64("text").alias("text_key"))
    joined = keyed.join(cut.hint("merge"), ["doc_id", "text_key"], "left").filter(~F.coalesce("empty", F.lit(False)))
    return _documents(joined, F.coalesce("left_text", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: every document as often as the mix takes it (at most three times). Texts without a word (NULL and
    empty too) are never taken; a NULL source is a source, last in order; repeated rows are documents of their own; ties
    go by a hash of the row."""
    common.prepare(spark)
    mixed = mixing.mix(docs, members=F.array(F.col("source")), size=F.size(common.words(F.col("text"))),
                       weight_of=lambda i, source: i % 3 + 1, max_repeats=3, keep=COLUMNS)
    return mixed.filter("repeats > 0").select(
        *COLUMNS, F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))).alias("epoch")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: pieces of full sequences. NULL and empty texts are one end token; a document taken several times
    is packed as often, with its id on every piece."""
    common.prepare(spark)
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), window=2048, end_id=1)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates),
          ("substring dedup", substring_dedup), ("mixing sources", mix_sources), ("packing", pack)]

# Banding, recompression and tokenisation are not SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written to the shared folder and read by the next."""
    common.prepare(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
