"""The corpus pipeline: clean, classify, deduplicate and pack the documents, one operator a stage.

Each stage reads all that its predecessor kept. All but the last return the columns of ``documents``, and any
further ones as they came, whatever their names. A null text is an empty one; ids may be null or repeat, and rows
are told apart by id and text; repeated rows share every decision, and the join keeps one of them. Texts may be of
any length. An empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import classifier, jaccard, packing, rules, substring
from kindred.llm.tables import FIRST, KEY, Scratch, table, text_key


def _with_key(docs: DataFrame) -> DataFrame:
    """The operators' key of each row, and the row itself in ``_row``, where its columns clash with none."""
    key = text_key(F.col("text").cast("string"))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("_id"), key.alias("_key"), F.struct("*").alias("_row"))


def _with_text(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is in ``texts`` (_id, _key, new_text), with that text and its length.

    A null new text leaves the row as it is.
    """
    joined = _with_key(docs).join(texts.dropDuplicates(KEY), KEY)
    length = F.when(F.col("new_text").isNull(), F.col("_row.n_chars")).otherwise(F.length("new_text"))
    row = F.col("_row").withField("text", F.coalesce("new_text", "_row.text")).withField("n_chars", length.cast("long"))
    return joined.select(row.alias("_row")).select("_row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without their failing lines."""
    judged = rules.apply_rules(docs)
    new = F.when(F.col("n_lost") > 0, F.col("clean_text")).alias("new_text")
    return _with_text(docs, judged.filter("kept").select(*KEY, new))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of what is left, keeps."""
    found = classifier.classify(docs, table(spark, sf_dir, "labels"))
    kept = found.filter("kept").select(*KEY).distinct()
    return _with_key(docs).join(kept, KEY, "left_semi").select("_row.*")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id, and of repeated rows one.

    A row without words is near no other, though its class has the number that a group may have too.
    """
    alone = F.when(F.col("n_shingles") == 0, F.struct(*KEY))
    found = jaccard.join(docs).groupBy("class_id", alone).agg(F.min(F.struct(*KEY)).alias("first")).select("first.*")
    return _with_key(docs).join(found, KEY, "left_semi").dropDuplicates(KEY).select("_row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated windows; documents that keep no word go."""
    cut = substring.drop_repeats(docs).filter("kept <> ''")
    return _with_text(docs, cut.select(*KEY, F.when(F.col("n_removed") > 0, F.col("kept")).alias("new_text")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences and ids."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), added=True)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", jaccard_join),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

# The classifier and the packing have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    scratch, docs = Scratch(spark), table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
