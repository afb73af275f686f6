"""Exact copies through an extendible-hash index on shared files.

The index key of a text is its 64-bit hash. A directory over the key's leading bits names
the bucket that holds a key; while a bucket holds more than ``capacity`` distinct keys the
directory doubles (one more leading bit) and that bucket splits. Owner tasks process whole
buckets, that is key ranges, and write them in key order as files in the shared folder.
Texts that share a key are told apart by comparing their bytes (the text itself is a
grouping key, so Spark's hash table chains and compares them) and become a chain of
entries under the key. Documents then probe the index for the row that stays.

Native: DataFrame operations only. Groups of copies are aggregated before the shuffle, so
a text that fills a third of the rows reaches its owner as one row per input partition.

Defined results: a null text counts as empty, and empty texts are copies of each other.
The row with the largest id stays; null ids lose to any id, and if all ids of a group are
null one of its rows stays with a null ``keep_id``. Rows repeated with the same id and
text count as copies: exactly one of them is ``kept``. An empty table gives an empty
result. Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, shield, text_of, unshield

KEY_BITS = 64


def directory(keys: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    """The directory of an extendible-hash index over the distinct keys in ``key``.

    Returns one row per directory slot (``slot``: the leading ``max_depth`` bits):
    ``bucket`` and ``depth`` (the bucket's local depth). A bucket of depth d covers
    2^(max_depth - d) neighbouring slots; it is the shallowest prefix of the slot that holds
    at most ``capacity`` keys. At most 2^max_depth rows, whatever the input, and the prefixes
    it is chosen from at most twice as many, which bounds their broadcast.
    """
    slots = keys.groupBy(_slot(F.col("key"), max_depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    levels = slots.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth")).withColumn(
        "prefix", F.expr(f"shiftright(slot, {max_depth} - depth)"))
    fits = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("held")).filter(
        (F.col("held") <= capacity) | (F.col("depth") == max_depth))
    chosen = levels.join(F.broadcast(fits), ["depth", "prefix"]).groupBy("slot").agg(F.min("depth").alias("depth"))
    return chosen.select("slot", "depth", F.expr(
        f"shiftleft(shiftright(slot, {max_depth} - depth), {max_depth} - depth)").alias("bucket"))


def _slot(key, depth: int):
    """The leading ``depth`` bits of a 64-bit key."""
    return F.shiftrightunsigned(key, KEY_BITS - depth).cast("long") if depth else F.lit(0).cast("long")


def build_index(docs: DataFrame, id_col: str, text_col: str, capacity: int = 50_000, max_depth: int | None = None) -> tuple[DataFrame, DataFrame, int]:
    """Write the index and return it read back, with its directory and that one's depth: ``bucket, key, chain, digest,
    keep_id, group_size``; ``chain`` numbers the different texts under one key.

    The directory has at most 2^max_depth slots, which bounds its broadcast; ``max_depth`` follows
    from the number of keys (``depth_for``, at most 20, some 24 MB) if it isn't given. Buckets that
    are still overfull at that depth stay whole and are merely larger.
    """
    text = text_of(text_col)
    entries = (
        docs.select(F.col(id_col).alias("id"), text.alias("body"), F.xxhash64(text).alias("key"))
        .groupBy("key", "body")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("key", F.sha2("body", 256).alias("digest"), "keep_id", "group_size")
    )
    entries = materialise(entries, "entries")
    if max_depth is None:
        max_depth = depth_for(entries.count(), capacity)
    slots = materialise(directory(entries.select("key").distinct(), capacity, max_depth), "directory", few_files=True)
    owned = entries.withColumn("slot", _slot(F.col("key"), max_depth)).join(F.broadcast(slots), "slot")
    chained = owned.withColumn("chain", F.row_number().over(Window.partitionBy("bucket", "key").orderBy("digest")))
    index = chained.select("bucket", "key", "chain", "digest", "keep_id", "group_size")
    index = materialise(index.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "chain"), "index")
    return index, slots, max_depth


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 50_000,
                 max_depth: int | None = None) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    index, slots, depth = build_index(docs, id_col, text_col, capacity, max_depth)
    text = text_of(text_col)
    rows = (
        docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), F.sha2(text, 256).alias("digest"))
        .groupBy("id", "key", "digest")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    # the directory names a key's bucket, and the bucket's range of the index is searched
    placed = rows.withColumn("slot", _slot(F.col("key"), depth)).join(F.broadcast(slots.select("slot", "bucket")), "slot")
    found = placed.join(index.select("bucket", "key", "digest", "keep_id", "group_size"), ["bucket", "key", "digest"])
    each = found.select("*", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("nth"))
    return each.select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    docs, back = shield(docs, id_col, text_col)
    kept = exact_copies(docs, id_col, text_col).filter("kept").select(
        F.col(id_col).alias("_keep_id"), F.col("text_sha256").alias("_keep_sha"))
    marked = docs.withColumn("_sha", F.sha2(text_of(text_col), 256))
    same = marked[id_col].eqNullSafe(kept["_keep_id"]) & (marked["_sha"] == kept["_keep_sha"])
    stay = marked.join(kept, same, "left_semi")
    first = Window.partitionBy(id_col, "_sha").orderBy(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    once = stay.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1")
    return unshield(once.select(*[F.col(f"`{c}`") for c in docs.columns]), back)


def depth_for(rows: int, capacity: int) -> int:
    """A directory depth at which ``rows`` evenly hashed keys fit, with two bits to spare."""
    return max(1, min(20, math.ceil(math.log2(max(1, rows) / capacity + 1)) + 2))


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY coalesce(text, ''))
         AND row_number() OVER (PARTITION BY coalesce(text, ''), doc_id) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
