"""Table profiling: missing values, category shares, distinct values, column selection.

Each profile is one pass over the table: every column's statistic is an aggregate in the
same ``agg`` (partial aggregation per partition), then unpivoted to long form with
``stack``, so wide tables never multiply the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from liftkit.functions.clean import quoted


def profile_select(df: DataFrame, drop: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Drop the named columns, or keep only the named ones (column pruning reaches the scan)."""
    if keep is not None:
        return df.select(*keep)
    return df.drop(*(drop or []))


def _is_missing(df: DataFrame, name: str):
    c = F.col(quoted(name))
    dtype = df.schema[name].dataType.simpleString()
    if dtype in ("double", "float"):
        return (c.isNull() | F.isnan(c)).cast("long")
    return c.isNull().cast("long")


def _text(name: str) -> str:
    """A column name as an SQL string literal."""
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: position, type, missing count, non-missing count and missing share.

    One aggregate pass, then a ``stack`` to one row per column.
    """
    names = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.sum(_is_missing(df, n)).alias(f"__m{i}") for i, n in enumerate(names)]
    wide = df.agg(*aggs)
    parts = ", ".join(
        f"{i}, {_text(n)}, '{df.schema[n].dataType.simpleString()}', __m{i}" for i, n in enumerate(names)
    )
    long = wide.selectExpr("__rows", f"stack({len(names)}, {parts}) as (position, column_name, data_type, missing)")
    return long.select(
        F.col("position").cast("int").alias("position"),
        "column_name",
        "data_type",
        F.coalesce(F.col("missing"), F.lit(0)).cast("long").alias("missing"),
        (F.col("__rows") - F.coalesce(F.col("missing"), F.lit(0))).cast("long").alias("non_missing"),
        F.when(F.col("__rows") > 0, F.coalesce(F.col("missing"), F.lit(0)) / F.col("__rows")).alias("missing_share"),
    )


def total_missing(df: DataFrame) -> DataFrame:
    """Missing cells over the whole table, as one row."""
    return null_profile(df).agg(F.sum("missing").cast("long").alias("total_missing"))


def category_share(df: DataFrame, col: str) -> DataFrame:
    """Share of rows per value (missing is its own value, as in a value count over all rows)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(F.col(quoted(col))).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") / total)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def distinct_values(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct values of every text column, long form (column_name, value).

    Long form is a distributed ``distinct`` and scales with cardinality; missing values are
    listed too (as a NULL value), matching ``unique``.
    """
    cols = columns if columns is not None else string_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, value string")
    parts = ", ".join(f"{_text(c)}, cast({quoted(c)} as string)" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {parts}) as (column_name, value)").distinct()
