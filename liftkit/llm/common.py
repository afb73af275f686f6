"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftkit.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table through Spark's reader (any file system Spark knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder; every executor can read it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/liftkit-llm/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str, few_files: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage and
    survives lost executors. ``few_files`` is for tables of some bytes a row that a loop writes
    again and again: two tasks a core read all partitions, one after the other, so that a small
    table isn't strewn over as many files as there are shuffle partitions."""
    path = scratch(df.sparkSession, name)
    if few_files:
        df = df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000):
    """While a step runs, rows of whole texts go to Python at most ``rows`` at a time: a batch is
    held by the JVM and the worker at once, in each task. The session's own setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_of(column: str):
    """The text column with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shield(df: DataFrame, *named: str) -> tuple[DataFrame, dict[str, str]]:
    """Rename input columns that start with an underscore (other than ``named``), so that they
    can't clash with an operator's own; ``unshield`` undoes it. The new names are absent from the input."""
    taken = {c.lower() for c in df.columns}
    away: dict[str, str] = {}
    for c in df.columns:
        if c.startswith("_") and c not in named:
            new = f"in{c}"
            while new.lower() in taken:
                new = f"in{new}"
            taken.add(new.lower())
            away[c] = new
    return df.withColumnsRenamed(away), {v: k for k, v in away.items()}


def unshield(df: DataFrame, back: dict[str, str]) -> DataFrame:
    """Give shielded columns their names back; a column that the operator adds under such a
    name replaces the input's."""
    gone = [v for v, k in back.items() if k in df.columns]
    return df.drop(*gone).withColumnsRenamed({v: k for v, k in back.items() if v not in gone})


def sql_crc(text: str) -> str:
    """DuckDB SQL: the CRC-32 of an ASCII text, bit by bit."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)), "
            "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), "
            "lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)")
