"""The inputs of the registered queries, derived from the given tables (FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators.skew import even_join, spread_rows
from kindred.session import materialize

# The last-wins order of repeated ratings, the first day of the test rows, and the
# stopwords.
ORDER = ["l_orderkey", "l_linenumber", "l_shipdate"]
SPLIT_DAY = "2001-01-01"
STOPWORDS = ["the", "and", "of", "to", "in", "that", "de", "la", "le", "et", "les", "der", "die", "und", "el", "que"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every line item is a rating of its part by the customer of its order."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    return even_join(lines, orders, "l_orderkey").select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("business_id"),
        (1 + F.col("l_quantity").cast("int") % 5).cast("double").alias("stars"),
        *ORDER,
        (F.col("o_orderdate") >= F.lit(SPLIT_DAY).cast("timestamp_ntz")).alias("is_test"),
    )


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of orders before the split day."""
    return _before(ratings(spark, sf_dir))


def train_and_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`train`, and ratings of orders from the split day on, to be predicted; joined and written once."""
    rows = materialize(ratings(spark, sf_dir))
    return _before(rows), rows.filter("is_test").select("user_id", "business_id", "stars")


def _before(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("is_test"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every document is a review."""
    return spread_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select(
        (F.col("doc_id") * 31 % 203).alias("user_id"), (F.col("doc_id") % 97).alias("business_id"), "text"
    )


def content_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """each user with another business than the reviewed one."""
    return (
        reviews(spark, sf_dir)
        .select("user_id", "business_id")
        .distinct()
        .select("user_id", ((F.col("business_id") + 5) % 97).alias("business_id"))
    )
