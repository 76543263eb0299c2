"""Helpers shared by the operators: fixed word pattern, written tables, Arrow access."""

from __future__ import annotations

import functools
import io
import pathlib
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from ..session import shared_dir

#: The white space that separates words: space and U+0009 to U+000D.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage with a table that every executor can reach, so a lost
    executor or a second use never repeats the work above it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """The words of ``text`` as an array; empty for null and blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS_RUN))


def with_held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with column ``name``, worked out exactly once a row.

    A plain projected column may be put in place of its name wherever a later
    filter or projection uses it; inside a lambda that would repeat the work
    for every element.  A generator of one row is never merged or pushed through.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def n_words_of(text: Column) -> Column:
    """Number of words of ``text`` (null: 0)."""
    return F.size(words_of(text)).cast("long")


def utf8_values(column: pa.Array) -> list[bytes | None]:
    """The values of a string column as UTF-8 bytes."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def texts_of(column: pa.Array) -> Iterator[str]:
    """The values of a string column one at a time, null as the empty text."""
    for value in column:
        yield value.as_py() or ""


def met_once(joined: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each value of the join's ``keys``.

    A sort-merge join on the same keys leaves its rows dealt and sorted by them,
    so this streams over them without another exchange.
    """
    return joined.dropDuplicates(keys)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_value(df: DataFrame, text: str, values: Callable[[list], pa.Array], out: str, kind: DataType,
               drop_text: bool = False) -> DataFrame:
    """``df`` with ``out`` = ``values(UTF-8 texts of a batch)``, other columns passed through.

    ``out`` replaces a column of that name.  Runs batch by batch in Arrow.
    """
    keep = [f for f in df.schema.fields if f.name != out and not (drop_text and f.name == text)]
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = values(utf8_values(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), made], [*names, out])

    picked = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*names, text])])
    return picked.mapInArrow(run, StructType([*keep, StructField(out, kind)]))


def write_shared(spark: SparkSession, name: str, data: bytes) -> str:
    """Write ``data`` as file ``name`` of the shared folder; returns its URI."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = system.create(path, True)
    try:
        out.write(data)
    finally:
        out.close()
    return system.makeQualified(path).toString()


@functools.cache
def _package_zip() -> bytes:
    """The library itself as a zip file."""
    root = pathlib.Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    return packed.getvalue()


_READY: set[str] = set()
#: Rows an Arrow batch carries to Python: bounds a task's memory with long texts.
ARROW_ROWS = 500


def prepare(spark: SparkSession) -> None:
    """Bring the library to the executors and bound the Arrow batches, once a session."""
    app = spark.sparkContext.applicationId
    if app not in _READY:
        spark.sparkContext.addPyFile(write_shared(spark, f"{__package__.split('.')[0]}-{uuid.uuid4().hex}.zip", _package_zip()))
        _READY.add(app)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
