"""Repeated rows without shuffling the others.

Rows are told apart by a 128-bit digest of their values.  Only digests are
grouped (combined in the tasks first); those that occur more than once are
written as a narrow table.  All other rows stay where they are, and only rows
that are repeated move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import files
from .joins import join_small


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def columns_of(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def digest(df: DataFrame) -> Column:
    """128 bits over every column's value (nulls and their places count)."""
    nulls = F.concat_ws("", *[F.when(c.isNull(), F.lit("0")).otherwise(F.lit("1")) for c in columns_of(df)])
    return F.struct(F.xxhash64(*columns_of(df), nulls).alias("a"), F.xxhash64(F.lit("second"), nulls, *columns_of(df)).alias("b"))


def repeated(marked: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The digests in column ``name`` that occur more than once, as a written table, and their number."""
    found = marked.select(name).groupBy(name).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(name)
    path = files.scratch_dir(marked.sparkSession, "repeated-rows")
    found.write.parquet(path)
    table = marked.sparkSession.read.parquet(path)
    return table, table.count()                       # of the files' footers


def by_repetition(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with its digest as column ``name``: the rows that occur once, and the
    others.  Where few digests are repeated the table of them is broadcast (its
    size is checked), and no other row moves."""
    marked = df.withColumn(name, digest(df))
    again, n = repeated(marked, name)
    if n == 0:
        return marked, marked.limit(0)
    return (join_small(marked, again, name, "left_anti", small_rows=n).select(*marked.columns),
            join_small(marked, again, name, "left_semi", small_rows=n).select(*marked.columns))


def distinct_rows(df: DataFrame) -> DataFrame:
    """``df.distinct()`` that moves repeated rows only."""
    name = free_name(df, "row_digest")
    once, more = by_repetition(df, name)
    return once.drop(name).unionByName(more.drop(name).distinct())


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a EXCEPT DISTINCT b`` (null-safe, by position).

    Digests alone decide which rows of ``a`` have an equal row in ``b``; the rows
    that stay are made distinct by :func:`distinct_rows`.  The wide rows of ``b``
    are never moved, those of ``a`` only if the table of shared digests is too
    large for a checked broadcast."""
    name = free_name(a, "row_digest")
    b = b.toDF(*a.columns)
    marked = a.withColumn(name, digest(a))
    shared = (marked.select(name).distinct().join(b.select(digest(b).alias(name)).distinct(), name, "left_semi"))
    path = files.scratch_dir(a.sparkSession, "shared-rows")
    shared.write.parquet(path)
    table = a.sparkSession.read.parquet(path)
    left = join_small(marked, table, name, "left_anti", small_rows=table.count())
    return distinct_rows(left.select(*columns_of(a)))
