"""File and catalog sources and sinks: listing CSV, exported CSV with a row index,
text corpora, warehouse tables, JSON summary and JDBC."""

from __future__ import annotations

import warnings
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, DoubleType

from liftkit.session import ensure_checkpoint_dir

# Listing export schema: text for every column that can be dirty, never inferred.
LISTINGS_SCHEMA = StructType(
    [
        StructField("id", LongType()),
        StructField("name", StringType()),
        StructField("host_id", LongType()),
        StructField("host_name", StringType()),
        StructField("neighbourhood_group", StringType()),
        StructField("neighbourhood", StringType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("room_type", StringType()),
        StructField("price", StringType()),
        StructField("minimum_nights", LongType()),
        StructField("number_of_reviews", LongType()),
        StructField("last_review", StringType()),
        StructField("reviews_per_month", StringType()),
        StructField("calculated_host_listings_count", LongType()),
        StructField("availability_365", StringType()),
    ]
)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header CSV with quoted fields that may hold commas, quotes and newlines."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_listings_csv(spark: SparkSession, path: str, schema: StructType = LISTINGS_SCHEMA) -> DataFrame:
    return read_csv(spark, path, schema)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header CSV, quoted the way ``read_csv`` reads it; dates as ISO text."""
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


def write_export_with_index(df: DataFrame, path: str, order_by: str, mode: str = "overwrite") -> str:
    """CSV with a leading unnamed row-index column, as a data-frame export writes it.

    The index is the 0-based position in ``order_by`` order, computed without a global
    window (``ranking.ordered_offsets``).
    """
    indexed = with_row_index(df, order_by, "_row_index")
    cols = ["_row_index"] + [c for c in df.columns]
    out = indexed.select(*cols).withColumnRenamed("_row_index", "")
    return write_csv(out, path, mode)


def with_row_index(df: DataFrame, order_by: str, name: str = "row_index") -> DataFrame:
    """0-based position by ``order_by`` (a unique key), computed without a single-task window
    (see ``ranking.ordered_offsets``)."""
    from liftkit.operators.ml import positions

    return positions(df, order_by, None, name)


def read_export(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Re-read an export whose first column is an unnamed row index, and drop that column."""
    if schema is not None:
        full = StructType([StructField("_index", LongType())] + list(schema.fields))
        return read_csv(spark, path, full).drop("_index")
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    first = df.columns[0]
    return df.drop(first) if first in ("", "_c0") else df


def existing_paths(spark: SparkSession, paths: list[str]) -> tuple[list[str], list[str]]:
    """(present, absent) among paths and globs, asked of the file system each belongs to."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    present, absent = [], []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        found = path.getFileSystem(conf).globStatus(path)
        (present if found else absent).append(p)
    return present, absent


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of a folder's children, on whatever file system it is."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    return sorted(str(s.getPath().getName()) for s in listed)


def read_corpus(spark: SparkSession, paths: list[str], whole: bool = True) -> DataFrame:
    """Text files as one document each (or, with ``whole=False``, one per line). Paths may be
    plain, URIs or globs; absent ones are named in a warning, undecodable bytes are left out. A
    whole file is one value, of 2 GB at most; Spark passes over empty files, which have no row."""
    present, absent = existing_paths(spark, paths)
    if absent:
        warnings.warn(f"not found: {', '.join(absent)}", stacklevel=2)
    if not present:
        return spark.createDataFrame([], "doc_id long, path string, text string")

    if whole:
        df = spark.read.format("binaryFile").load(present).select("path", F.col("content").alias("raw"))
    else:
        df = spark.read.text(present).select(F.input_file_name().alias("path"), F.col("value").cast("binary").alias("raw"))
    return df.select(F.monotonically_increasing_id().alias("doc_id"), "path", decoded("raw").alias("text"))


def decoded(raw: str) -> Column:
    """The text of a binary column without the bytes that are no UTF-8. Spark puts U+FFFD for
    those; where the text itself has that sign it is written otherwise meanwhile, by an escape. No
    file leaves the JVM for it."""
    bad, mark = F.lit("\ufffd"), "\x01"
    kept = F.replace(F.replace(F.col(raw).cast("string"), F.lit(mark), F.lit(mark + "\x02")), bad, F.lit(mark + "\x03"))
    text = F.replace(F.make_valid_utf8(kept), bad, F.lit(""))
    return F.replace(F.replace(text, F.lit(mark + "\x03"), bad), F.lit(mark + "\x02"), F.lit(mark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (cluster-visible)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/liftkit/{name}-{uuid.uuid4().hex[:12]}"


def save_warehouse(spark: SparkSession, tables: dict[str, DataFrame], database: str | None = None,
                   fmt: str = "parquet") -> list[str]:
    """Write every table to the catalog, replacing existing ones."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, df in tables.items():
        full = f"{database}.{name}" if database else name
        df.write.mode("overwrite").format(fmt).saveAsTable(full)
        names.append(full)
    return names


def write_json_summary(df: DataFrame, path: str) -> str:
    """One JSON object per row (a one-row summary gives one object)."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, mode: str = "errorifexists") -> None:
    """Load a table into an external database; by default fail if the table exists.

    Credentials come from the caller's configuration; nothing is hard-coded here.
    """
    df.write.mode(mode).jdbc(url, table, properties=properties)
