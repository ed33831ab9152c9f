"""Sources and sinks: JSON lines, plain text, and parquet for saved models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVIEWS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("business_id", T.StringType()),
        T.StructField("stars", T.DoubleType()),
        T.StructField("text", T.StringType()),
    ]
)
TEST_PAIRS = T.StructType(REVIEWS.fields[:2])
CONTENT_MODEL = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("biz_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("fvec", T.ArrayType(T.StringType())),
    ]
)


def _lacks(keys: Sequence[str]) -> Column:
    bad = F.lit(False)
    for k in keys:
        bad = bad | F.col(k).isNull()
    return bad


def _read(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    on_bad: str,
    fmt: str,
    counts: Observation | None = None,
) -> DataFrame:
    """``on_bad``: "drop" leaves out rows that do not parse or lack a key, "fail" raises on them.

    ``counts`` observes n_rows and n_bad while the rows are read for whatever comes first.
    """
    if on_bad not in ("drop", "fail"):
        raise ValueError(f"on_bad must be 'drop' or 'fail', not {on_bad!r}")
    reader = spark.read.schema(schema)
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST" if on_bad == "fail" else "PERMISSIVE")
    df = reader.format(fmt).load(path)
    if counts is not None:
        bad = _lacks(keys)
        df = df.observe(counts, F.count(F.lit(1)).alias("n_rows"), F.count(F.when(bad, 1)).alias("n_bad"))
    if on_bad == "drop":
        return df.dropna(subset=list(keys))
    checked = {
        k: F.when(F.col(k).isNull(), F.raise_error(F.lit(f"row without {k}"))).otherwise(F.col(k)).alias(k) for k in keys
    }
    return df.select(*[checked.get(c, F.col(c)) for c in df.columns])


def read_reviews(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = ("user_id", "business_id", "stars", "text"),
    on_bad: str = "fail",
    counts: Observation | None = None,
) -> DataFrame:
    """Reviews, one JSON object per line. Only ``columns`` are parsed, and only the two ids must be there.

    A review without stars or text stays, as not every use looks at them; ``cf_train`` refuses null stars.
    ``counts`` tells n_rows and n_bad after the first action, from the same pass.
    """
    schema = T.StructType([f for f in REVIEWS.fields if f.name in columns])
    keys = [c for c in ("user_id", "business_id") if c in columns]
    return _read(spark, path, schema, keys, on_bad, "json", counts)


def split_lines(
    spark: SparkSession, path: str, out: str, schema: T.StructType = REVIEWS, keys: Sequence[str] = ("user_id", "business_id")
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The rows of a file and the lines that are none, written to ``out`` in one pass: (rows, lines, counts).

    A line is bad that does not parse or lacks a key; ``lines`` has it as it stands, in the column ``line``.
    ``counts`` holds n_rows (of the file) and n_bad.
    """
    # the parser needs the column for broken lines in its schema, or it takes what it can of them
    parsed = F.from_json("value", T.StructType([*schema.fields, T.StructField("_broken", T.StringType())]), {"columnNameOfCorruptRecord": "_broken"})
    rows = spark.read.text(path).withColumn("_row", parsed).select("value", "_row.*")
    bad = F.coalesce(F.col("_broken").isNotNull() | _lacks(keys), F.lit(True))
    kept = [F.when(~F.col("bad"), F.col(f.name)).alias(f.name) for f in schema.fields]
    observation = Observation()
    marked = rows.withColumn("bad", bad).observe(
        observation, F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("bad"), 1)).alias("n_bad")
    )
    marked.select("bad", F.when(F.col("bad"), F.col("value")).alias("line"), *kept).write.partitionBy("bad").parquet(out)
    whole = T.StructType([T.StructField("line", T.StringType()), *schema.fields, T.StructField("bad", T.BooleanType())])
    written = spark.read.schema(whole).parquet(out)
    return written.filter("NOT bad").select(*schema.names), written.filter("bad").select("line"), observation.get


def count_bad_reviews(
    spark: SparkSession, path: str, columns: Sequence[str] = ("user_id", "business_id")
) -> DataFrame:
    """(n_rows, n_bad): how many lines lack a key or do not parse; what "drop" leaves out."""
    schema = T.StructType([f for f in REVIEWS.fields if f.name in columns])
    rows = spark.read.schema(schema).json(path)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(_lacks(columns), 1)).alias("n_bad"))


def read_test_pairs(
    spark: SparkSession, path: str, on_bad: str = "drop", counts: Observation | None = None
) -> DataFrame:
    """(user_id, business_id) rows; repeats stay. ``counts`` tells how many were read and dropped."""
    return _read(spark, path, TEST_PAIRS, ["user_id", "business_id"], on_bad, "json", counts)


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, trimmed at both ends."""
    return spark.read.text(path).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("word")).distinct()


def read_cf_model(spark: SparkSession, path: str, left: str = "b1", right: str = "b2", fmt: str = "json") -> DataFrame:
    """(left < right, sim); a pair stored the other way round is turned."""
    if fmt == "json":
        schema = f"{left} string, {right} string, sim double"
        rows = spark.read.schema(schema).json(path)
    else:
        rows = spark.read.format(fmt).load(path)
    return rows.select(
        F.least(left, right).alias(left), F.greatest(left, right).alias(right), F.col("sim").cast("double").alias("sim")
    )


def read_content_model(spark: SparkSession, path: str, fmt: str = "json") -> tuple[DataFrame, DataFrame]:
    """The business vectors (business_id, fvec) and user vectors (user_id, fvec) of a saved model."""
    reader = spark.read.schema(CONTENT_MODEL) if fmt == "json" else spark.read
    model = reader.format(fmt).load(path)
    kind = F.col("type")
    return (
        model.filter(kind == "biz").select(F.col("biz_id").alias("business_id"), "fvec"),
        model.filter(kind == "user").select("user_id", "fvec"),
    )


def _write(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    df.write.format(fmt).mode(mode).save(path)


def write_pairs(pairs: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """Similar pairs or a CF model: {b1, b2, sim} or {u1, u2, sim}, one object per line."""
    keys = [c for c in pairs.columns if c != "sim"]
    if keys not in (["b1", "b2"], ["u1", "u2"]):
        raise ValueError(f"pairs are (b1, b2, sim) or (u1, u2, sim), not {pairs.columns}")
    _write(pairs.select(*keys, "sim"), path, fmt, mode)


def write_content_model(model: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """Both kinds of profile in one output; a record has the id of its own kind only."""
    _write(model.select("type", "biz_id", "user_id", "fvec"), path, fmt, mode)


def write_predictions(rows: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """Scores {user_id, business_id, sim} or predictions {user_id, business_id, stars}."""
    value = "sim" if "sim" in rows.columns else "stars"
    _write(rows.select("user_id", "business_id", value), path, fmt, mode)
