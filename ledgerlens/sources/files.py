"""File sources and sinks: CSV/parquet scans with a clear missing-input error,
request rows, metrics JSON, and scratch locations on the shared folder."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import FORM_SCHEMA, LABEL, METRICS_SCHEMA, NUMERIC_FEATURES, REQUEST_SCHEMA, TXN_CSV_SCHEMA, TYPE


class InputNotFound(FileNotFoundError):
    """The input path does not exist (raised by the reader, works on object stores)."""


def _missing(err: AnalysisException) -> bool:
    cond = getattr(err, "getCondition", None) or getattr(err, "getErrorClass", None)
    name = cond() if cond else None
    return name == "PATH_NOT_FOUND" or "Path does not exist" in str(err)


def read_parquet_checked(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if _missing(err):
            raise InputNotFound(f"input not found: {path}") from err
        raise


def read_txn_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """CSV with a header.  Declared schema by default (no inference job);
    ``infer=True`` keeps the schema-inference behaviour.  The label is cast
    with ``try_cast`` so malformed labels become NULL instead of failing."""
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if infer else reader.schema(TXN_CSV_SCHEMA)
    try:
        df = reader.csv(path)
    except AnalysisException as err:
        if _missing(err):
            raise InputNotFound(f"input not found: {path}") from err
        raise
    return df.withColumn(LABEL, F.col(LABEL).try_cast("double"))


REQUIRED_COLUMNS = [TYPE] + NUMERIC_FEATURES + [LABEL]


COPIES_PER_CHUNK = 10_000


def with_row_key(df: DataFrame, key: str = "txn_id") -> DataFrame:
    """Add a key when the input has no id: 64 bits of the row's digest and the
    number of the copy.

    Digests are grouped first, without the rows.  A row that occurs once gets its
    key where it is, and is not shuffled.  Only repeated rows are: they are
    counted (combined in the tasks, so a row repeated very often is one row per
    task) and made again with their numbers, in chunks that are dealt out anew;
    every copy has a key, a coin and a place of its own.  Keys do not depend on
    the partitioning.  A given whole-number id is kept, and a null one
    replaced by the hash of the row."""
    from ..operators import rowsets

    names = rowsets.columns_of(df)
    if key in df.columns:
        if df.schema[key].dataType.typeName() not in ("long", "integer"):
            return df
        return df.withColumn(key, F.coalesce(F.col(key).cast("long"), F.xxhash64(*names)))
    digest, copies, chunk, deal, copy = (rowsets.free_name(df, n) for n in ("row_digest", "copies", "chunk", "deal", "copy"))
    once, more = rowsets.by_repetition(df, digest)

    def made(rows: DataFrame, number: Column) -> DataFrame:
        return rows.select(*names, F.xxhash64(f"{digest}.a", f"{digest}.b", number).alias(key))

    counted = more.groupBy(*more.columns).agg(F.count(F.lit(1)).alias(copies))
    chunks = counted.withColumn(chunk, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / COPIES_PER_CHUNK))))
    dealt = chunks.withColumn(deal, F.xxhash64(digest, chunk)).repartition(deal)
    first = F.col(chunk) * COPIES_PER_CHUNK
    last = F.least(first + COPIES_PER_CHUNK, F.col(copies)) - 1
    numbered = dealt.withColumn(copy, F.explode(F.sequence(first, last)))
    return made(once, F.lit(0).cast("long")).unionByName(made(numbered, F.col(copy)))


def read_labelled_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                      sampling_ratio: float = 1.0, require_label: bool = True) -> DataFrame:
    """Any labelled transaction CSV with a header (the reference's input).

    With a declared ``schema`` there is no inference job.  Otherwise the
    schema is inferred -- over the whole file by default (as the reference
    does), or over a ``sampling_ratio`` fraction of it, which on very large
    inputs avoids a second full pass.  The label is ``try_cast`` to double,
    required columns are checked, numeric features cast to double, a content
    key added; other columns pass through."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True).option("samplingRatio", float(sampling_ratio))
    try:
        df = reader.csv(path)
    except AnalysisException as err:
        if _missing(err):
            raise InputNotFound(f"input not found: {path}") from err
        raise
    required = REQUIRED_COLUMNS if require_label else [c for c in REQUIRED_COLUMNS if c != LABEL]
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"input lacks required columns {missing}")
    if LABEL in df.columns:
        df = df.withColumn(LABEL, F.col(LABEL).cast("string").try_cast("double"))
    for c in NUMERIC_FEATURES:
        df = df.withColumn(c, F.col(c).cast("double"))
    return with_row_key(df)


def form_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The scoring form's four fields as a typed DataFrame."""
    return spark.createDataFrame(rows, schema=FORM_SCHEMA)


def request_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Scoring requests as a typed DataFrame (the dashboard form's rows)."""
    return spark.createDataFrame(rows, schema=REQUEST_SCHEMA)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``."""
    from ..session import shared_dir

    return f"{shared_dir(spark).rstrip('/')}/ledgerlens/{purpose}-{uuid.uuid4().hex}"


def write_metrics_json(metrics_long: DataFrame, path: str) -> None:
    """(model, metric, value) lines; a missing metric is written as an
    explicit ``"value": null``, as in the published metrics file."""
    metrics_long.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(path)


NESTED_METRICS_SCHEMA = T.StructType([
    T.StructField("best_model", T.StringType(), True),
    T.StructField("all_metrics", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType())), True),
])


def results_frame(metrics_long: DataFrame, best: DataFrame) -> DataFrame:
    """One row ``{best_model, all_metrics: {model: {metric: value}}}`` built
    by aggregation (bounded by models x metrics), the published results shape."""
    per_model = metrics_long.groupBy("model").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m"))
    maps = per_model.agg(F.map_from_entries(F.collect_list(F.struct("model", "m"))).alias("all_metrics"))
    best_name = best.select("best_model").scalar()
    return maps.select(best_name.alias("best_model"), "all_metrics")


def write_results_json(metrics_long: DataFrame, best: DataFrame, path: str) -> None:
    results_frame(metrics_long, best).coalesce(1).write.mode("overwrite").json(path)


def read_results_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NESTED_METRICS_SCHEMA).option("multiLine", True).json(path)


def nested_metrics_to_long(nested: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``{best_model, all_metrics: {model: {metric: value}}}`` -> (model, metric, value)."""
    per_model = nested.select(*keep, F.inline(F.map_entries("all_metrics")))  # key, value
    return per_model.select(
        *keep, F.col("key").alias("model"), F.inline(F.map_entries("value"))
    ).select(*keep, "model", F.col("key").alias("metric"), F.col("value").alias("value"))
