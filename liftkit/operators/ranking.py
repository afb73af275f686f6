"""Running totals in value order, distributed.

A row's bucket is a pure function of its own order value, increasing in it, so every branch
of a plan and every recomputation of a lost task puts a row in the same bucket, whatever the
number of partitions or the adaptive settings. Totals per bucket give each bucket's offset; a
window inside the bucket does the rest.

Buckets are found by recursive refinement (``bucketed``). The first are those of
``order_bucket``. If one holds more than ``bound`` rows, borders between buckets are drawn from
values that really occur, the rows of every bucket are counted, and only those still above the
bound get further borders, until none is. The borders become constants of the plan, so how they
were drawn matters neither for the ranks nor for recomputed tasks. A border's own value is a
bucket by itself, so a value that many rows share is told from its neighbours and is cut by a
hash of the whole row. The driver holds about 4 borders for each ``bound`` rows. Only rows
equal in every column can stay together beyond the bound.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftkit.functions.clean import quoted

STEPS = 64  # buckets per doubling of a number's magnitude: each spans 1.1 % of its value
_FLOOR, _CEIL = 1075 * STEPS, 1025 * STEPS  # binary exponents of doubles, in steps


def order_bucket(df: DataFrame, col: str) -> Column:
    """An integer that never decreases as ``col`` grows (missing first, NaN last).

    Numbers, dates and timestamps use a signed logarithmic scale: at most about 270,000
    buckets exist, and values spread over a factor of two fill 64. Strings and binaries use
    their first two bytes."""
    kind, c = df.schema[col].dataType, F.col(col)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 2)), 4, "0"), 16, 10).cast("long")
        return F.coalesce(head, F.lit(-1).cast("long"))
    if isinstance(kind, T.DateType):
        c = F.datediff(c, F.lit("1970-01-01").cast("date"))
    x = c.cast("double")
    size = F.least(F.greatest(F.floor(F.log2(F.abs(x)) * STEPS), F.lit(-_FLOOR)), F.lit(_CEIL)) + F.lit(_FLOOR + 1)
    return (
        F.when(x.isNull(), F.lit(-(1 << 40)))
        .when(F.isnan(x), F.lit(1 << 40))
        .when(x == 0, F.lit(0))
        .when(x > 0, size)
        .otherwise(-size)
        .cast("long")
    )


TASK_ROWS = 1_000_000  # rows that one window task may sort
_TEXT = 256  # first bytes of a text that a border keeps; four times as many with each round


def _comparable(df: DataFrame, col: str) -> tuple[str, Column]:
    """A type that borders are kept in and the column in it; texts as hexadecimal bytes, which
    sort alike."""
    kind, c = df.schema[col].dataType, F.col(quoted(col))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return "string", F.hex(c.cast("binary"))
    if isinstance(kind, T.BooleanType):
        return "int", c.cast("int")
    return kind.simpleString(), c


def _between(kind: str, value: Column, borders: list[str]) -> Column:
    """A value's bucket among the borders, by binary search: 2p for the p-th border's own value,
    2p + 1 above it, 0 for missing values."""
    among = F.sort_array(F.split(F.lit(",".join(borders)), ",").cast(f"array<{kind}>"))
    jumps = F.array(*[F.lit(1 << i) for i in reversed(range(len(borders).bit_length()))])
    at = F.aggregate(jumps, F.lit(0), lambda p, s: F.when(F.get(among, p + s - 1) <= value, p + s).otherwise(p))
    own = F.when(F.get(among, at - 1) == value, 0).otherwise(1)
    return F.when(value.isNull(), 0).otherwise(2 * at + own).cast("long")


def bucketed(df: DataFrame, order_col: str, groups: list[str] | None = None, tie: list[str] | None = None,
             bound: int = TASK_ROWS) -> DataFrame:
    """``df`` plus ``_bucket``, which never decreases as ``order_col`` grows and holds at most
    ``bound`` rows of a group (see the module's text). The counting runs when this is called.

    With ``tie`` the rows of one value stay together, since their order is fixed, as do rows
    equal in every column. Missing values come first, as one value."""
    groups = list(groups or [])
    rows = df.withColumn("_bucket", order_bucket(df, order_col))
    full = _overfull(rows, groups, bound)
    if not full:
        return rows
    kind, value = _comparable(df, order_col)
    hashed = [F.col(quoted(f.name)) for f in df.schema if not isinstance(f.dataType, T.MapType)]
    borders, depth = set(), 0
    while True:
        # a value for about every quarter of the bound, from the overfull buckets only
        text = F.substring(value, 1, 2 * _TEXT * 4 ** depth) if kind == "string" else value.cast("string")
        inside = rows.filter(F.col("_bucket").isin(list(full)) & value.isNotNull())
        drawn = inside.filter(F.pmod(F.xxhash64(F.lit(depth), *hashed), F.lit(max(1, bound // 4))) == 0)
        borders |= {r["v"] for r in drawn.select(text.alias("v")).distinct().collect()}
        if not borders:
            borders |= {r["v"] for r in inside.select(text.alias("v")).take(1)}
        if not borders:  # only missing values are above the bound
            hot = full
            break
        rows = df.withColumn("_bucket", _between(kind, value, sorted(borders)))
        hot = _overfull(rows, groups, bound)
        full = {k: n for k, n in hot.items() if k % 2}
        depth += 1
        if not full:
            break
    parts = 1 << 16
    part = F.pmod(F.xxhash64(*hashed), F.lit(min(parts, 4 * math.ceil(max(hot.values(), default=1) / bound))))
    cut = F.when(F.col("_bucket").isin(list(hot)), part).otherwise(0) if hot and not tie else F.lit(0)
    return rows.withColumn("_bucket", (F.col("_bucket") * parts + cut).cast("long"))


def _overfull(rows: DataFrame, groups: list[str], bound: int) -> dict:
    """The buckets that hold more than ``bound`` rows (of one group), with their rows."""
    counts = rows.groupBy("_bucket", *groups).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bound)
    return {r["_bucket"]: r["n"] for r in counts.groupBy("_bucket").agg(F.max("n").alias("n")).collect()}


def bucket_offsets(rows: DataFrame, groups: list[str], weight: Column) -> DataFrame:
    """``_bucket, *groups, _off, _tot, _n``: the weight before the bucket, in it, and in all of
    its group. ``rows`` carries ``_bucket``."""
    totals = rows.groupBy("_bucket", *groups).agg(F.sum(weight).cast("long").alias("_tot"))
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return totals.withColumns({
        "_off": F.sum("_tot").over(before) - F.col("_tot"),
        "_n": F.sum("_tot").over(whole),
    })


def attach_offsets(rows: DataFrame, offsets: DataFrame, groups: list[str], how: str = "left") -> DataFrame:
    """Join rows with their bucket's offsets. Without groups there are at most 270,000
    offsets, or about 8 for each ``bound`` rows, which Spark broadcasts if they are small; with
    groups both sides are dealt by (bucket, group), which the window inside the bucket needs
    anyway. A bucket without an offset is an error."""
    names = [f"_k_{i}" for i in range(len(groups))]
    side = offsets.select(F.col("_bucket").alias("_b"), *[F.col(g).alias(n) for g, n in zip(groups, names)], "_off", "_tot", "_n")
    on = rows["_bucket"] == side["_b"]
    for g, n in zip(groups, names):
        on = on & rows[g].eqNullSafe(side[n])
    joined = rows.join(side, on, how).drop("_b", *names)
    if how == "left":
        joined = joined.withColumn("_off", F.coalesce("_off", F.raise_error("a bucket has no offset").cast("long")))
    return joined


def ordered_offsets(df: DataFrame, order_col: str, groups: list[str] | None = None, weight: Column | None = None,
                    tie: list[str] | None = None, bound: int = TASK_ROWS) -> DataFrame:
    """``df`` plus ``_before`` (weight of the rows that come earlier in ``order_col`` order
    within the group) and ``_n`` (weight of the group). Tied rows follow each other, in the
    order of ``tie`` where given; missing order values come first."""
    groups = list(groups or [])
    weight = F.lit(1) if weight is None else weight
    rows = bucketed(df, order_col, groups, tie, bound)
    found = attach_offsets(rows, bucket_offsets(rows, groups, weight), groups)
    local = Window.partitionBy("_bucket", *groups).orderBy(order_col, *(tie or [])).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return found.withColumn("_before", (F.col("_off") + F.sum(weight).over(local) - weight).cast("long")).drop("_bucket", "_off", "_tot")
