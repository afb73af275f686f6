"""Merkle manifest of a dataset by sibling-shift self-joins.

Every row is a leaf, the hash of its columns. The leaves of a source form a tree in the order
of their ids; at each level every ``arity`` neighbours are one run and their hash is a node of
the next level. A level is built by one equijoin of its nodes with themselves on computed
sibling indices (index XOR 1 for binary trees; otherwise slot offsets 1, 2, ... modulo the
run's length); the rows in slot zero then emit the parents. The roots of the sources form a
tree of the same kind, whose root names the whole dataset.

A proof is the list of a leaf's siblings on its way to the root, as (left, right) pairs. Proofs
are handed down from the roots by a join a level; folding one over a leaf gives the root again
if the row is unchanged.

Scale: texts are hashed where they are scanned and never travel. Positions come from a range
partitioning by (source, id), so a source that holds most rows is spread over tasks; every join
key holds the node's index, so no key has more than ``arity`` rows a side. Each level is written
to the shared folder; levels shrink by ``arity``.

Hash: lower-case hex SHA-256 of the inputs, one after the other; a column value enters as ``-``
if null, else as its length in UTF-8 bytes, ``:`` and the value; digests enter as hex text.

Defined results: a null source is a source of its own and the first; null ids come first, rows
with one id in the order of their leaves, so repeated rows give equal results. A source of one
row has that leaf as its root; a dataset of one source has that source's root. An empty table
gives an empty manifest. Columns not named take no part, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, sql_crc

ARITY = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NOTHING = bytearray()


def row_hash(values: list[Column]) -> Column:
    """The hash of column values, as 32 bytes."""
    shown = [v.cast("string") for v in values]
    return F.unhex(F.sha2(F.concat(*[
        F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)) for s in shown]), 256))


def _text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _joined(nodes: Column) -> Column:
    return F.aggregate(nodes, F.lit(NOTHING), lambda a, x: F.concat(a, x["hash"]))


def _run(arity: int) -> Column:
    return F.floor(F.col("idx") / arity).cast("long")


def _positions(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` written in ``order`` plus ``pos``, its dense position from 0, and ``part``. The
    offsets are one row a partition, which bounds their broadcast and their window."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = materialise(placed, name).withColumn("part", F.shiftright("at", 33))
    held = placed.groupBy("part").agg(F.count(F.lit(1)).alias("held"), F.min("at").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0))).drop("held")
    return placed.join(F.broadcast(held), "part").withColumn("pos", F.col("before") + F.col("at") - F.col("first")).drop(
        "at", "first", "before")


def number_leaves(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves (``source, id, hash, ...``) with ``tree`` (the source's number), ``idx`` and ``n``
    (the source's leaves), and the table of trees."""
    rows = _positions(leaves, ["source", "id", "hash"], "leaves")
    pieces = rows.groupBy("source", "part").agg(F.min("pos").alias("low"), F.count(F.lit(1)).alias("held"))
    pieces = materialise(pieces, "pieces", few_files=True)  # as many rows as sources and partitions
    trees = pieces.groupBy("source").agg(F.min("low").alias("start"), F.sum("held").alias("n"))
    trees = materialise(_positions(trees, ["source"], "sources").select("source", F.col("pos").alias("tree"), "start", "n"),
                        "trees", few_files=True)
    t = trees.withColumnRenamed("source", "of")
    named = pieces.join(t, pieces["source"].eqNullSafe(t["of"])).select(
        "of", F.col("part").alias("in_part"), "tree", "start", "n")
    numbered = rows.join(named, rows["source"].eqNullSafe(named["of"]) & (rows["part"] == named["in_part"])).withColumn(
        "idx", F.col("pos") - F.col("start")).drop("of", "part", "in_part", "pos", "start")
    return numbered, trees


def with_siblings(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """Nodes (``tree, idx, n, hash, ...``) with ``left`` and ``right``: their siblings' hashes."""
    run, slot = _run(arity), F.col("idx") % arity
    size = F.least(F.lit(arity), F.col("n") - run * arity)
    if arity == 2:
        wants = nodes.select("tree", "idx", F.col("idx").bitwiseXOR(F.lit(1)).alias("sibling"))
    else:
        offsets = nodes.filter(size > 1).select("tree", "idx", "n", F.explode(F.sequence(F.lit(1), (size - 1).cast("int"))).alias("k"))
        wants = offsets.select("tree", "idx", (run * arity + (slot + F.col("k")) % size).alias("sibling"))
    others = nodes.select(F.col("tree").alias("t"), F.col("idx").alias("i"), F.col("hash"))
    met = wants.join(others, (wants["tree"] == others["t"]) & (wants["sibling"] == others["i"])).select("tree", "idx", "sibling", "hash")
    found = met.groupBy(F.col("tree").alias("t"), F.col("idx").alias("i")).agg(
        F.sort_array(F.collect_list(F.struct("sibling", "hash"))).alias("siblings"))
    own = nodes.join(found, (nodes["tree"] == found["t"]) & (nodes["idx"] == found["i"]), "left").drop("t", "i")
    own = own.withColumn("siblings", F.coalesce("siblings", F.array().cast("array<struct<sibling:bigint,hash:binary>>")))
    return own.withColumns({
        "left": _joined(F.filter("siblings", lambda s: s["sibling"] < F.col("idx"))),
        "right": _joined(F.filter("siblings", lambda s: s["sibling"] > F.col("idx"))),
    }).drop("siblings")


def climb(nodes: DataFrame, arity: int = ARITY, name: str = "level") -> tuple[list[DataFrame], DataFrame]:
    """All levels of all trees (each with its siblings), and ``tree, height, hash`` of the roots."""
    levels: list[DataFrame] = []
    slim = ["tree", "idx", "n", "hash"]
    roots = nodes.filter("n = 1").select("tree", F.lit(0).alias("height"), "hash")
    live = nodes.filter("n > 1")
    while not live.isEmpty():
        level = materialise(with_siblings(live, arity), f"{name}-{len(levels)}", few_files=bool(levels))
        levels.append(level)
        whole = F.unhex(F.sha2(F.concat(_text(F.col("hash")), _text(F.col("right"))), 256))
        parents = level.filter(F.col("idx") % arity == 0).select(
            "tree", _run(arity).alias("idx"), F.ceil(F.col("n") / arity).cast("long").alias("n"), whole.alias("hash")).select(slim)
        roots = roots.unionByName(parents.filter("n = 1").select("tree", F.lit(len(levels)).alias("height"), "hash"))
        live = parents.filter("n > 1")
    return levels, materialise(roots, f"{name}-roots", few_files=True)


def _handed_down(levels: list[DataFrame], tops: DataFrame, leaves: DataFrame, arity: int, given: list[str]) -> DataFrame:
    """Leaves with ``path`` (their (left, right) pairs upwards, then the path of their tree's
    top) and the ``given`` columns of the tops. ``tops``: ``tree, height, path`` and ``given``."""
    step = F.array(F.struct("left", "right"))
    above = None
    for depth in reversed(range(len(levels))):
        ups = tops.filter(F.col("height") == depth + 1).select("tree", F.lit(0).cast("long").alias("idx"), "path", *given)
        ups = (ups if above is None else ups.unionByName(above.select("tree", "idx", "path", *given))).select(
            F.col("tree").alias("t"), F.col("idx").alias("up"), "path", *given)
        level = levels[depth].withColumn("run", _run(arity))
        above = level.join(ups, (level["tree"] == ups["t"]) & (level["run"] == ups["up"])).withColumn(
            "path", F.concat(step, "path")).drop("t", "up", "run", "left", "right")
    alone = leaves.filter("n = 1").join(tops.filter("height = 0").drop("height"), "tree")
    return alone if above is None else alone.unionByName(above)


@dataclass
class Manifest:
    """The written manifest: ``trees`` (source, tree, n, subroot), ``levels`` (a table a level:
    tree, idx, n, hash, left, right; the first with the leaves' other columns), ``root`` (one
    row: hash; none for an empty dataset) and ``proofs`` (a row a leaf: ``path``, ``subroot``,
    ``root`` and the leaves' columns)."""

    trees: DataFrame
    levels: list[DataFrame]
    root: DataFrame
    proofs: DataFrame


def build(leaves: DataFrame, arity: int = ARITY) -> Manifest:
    """The manifest of ``leaves``: ``source, id, hash`` (binary) and any further columns to carry."""
    numbered, trees = number_leaves(materialise(leaves, "hashes"))
    numbered = materialise(numbered, "numbered")
    levels, subroots = climb(numbered, arity)
    many = trees.agg(F.count(F.lit(1)))
    tops = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), many.scalar().alias("n"), "hash", "height")
    top_levels, root = climb(tops, arity, "top")
    whole = root.select("tree", "height", F.array().cast(
        "array<struct<left:binary,right:binary>>").alias("path"), F.col("hash").alias("root"))
    # ``height`` of a subroot is carried as a column of the top tree's leaves
    handed = _handed_down([lv.withColumnRenamed("height", "own") if "height" in lv.columns else lv for lv in top_levels], whole,
                          tops.withColumnRenamed("height", "own"), arity, ["root"])
    tops = handed.select(F.col("idx").alias("tree"), F.col("own").alias("height"), "path", F.col("hash").alias("subroot"), "root")
    tops = materialise(tops, "tops", few_files=True)
    proofs = _handed_down(levels, tops, numbered, arity, ["subroot", "root"])
    named = trees.join(tops.select("tree", "subroot"), "tree").select("source", "tree", "n", "subroot")
    return Manifest(named, levels, root.select("hash"), proofs)


def fold(leaf: Column, path: Column) -> Column:
    """The root (hex text) that a leaf (hex text) and its siblings lead to."""
    return F.aggregate(path, leaf, lambda a, s: F.sha2(F.concat(_text(s["left"]), a, _text(s["right"])), 256))


def verify(docs: DataFrame, arity: int = ARITY, columns: tuple[str, ...] = COLUMNS, changed: dict[str, Column] | None = None) -> DataFrame:
    """Build the manifest of ``docs`` (``columns``: the id, the source, then further ones) and
    verify each row as it reads after the ``changed`` columns are replaced."""
    values = [F.col(f"`{c}`") for c in columns]
    after = [(changed or {}).get(c, v) for c, v in zip(columns, values)]
    leaves = docs.select(values[0].alias("id"), values[1].cast("string").alias("source"), row_hash(values).alias("hash"),
                         row_hash(after).alias("found") if changed else row_hash(values).alias("found"))
    proofs = build(leaves, arity).proofs
    siblings = _text(F.aggregate("path", F.lit(NOTHING), lambda a, s: F.concat(a, s["left"], s["right"])))
    folded = proofs.select(
        F.col("id").alias(columns[0]), _text(F.col("hash")).alias("leaf"), _text(F.col("subroot")).alias("subroot"), _text(F.col("root")).alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"), fold(_text(F.col("found")), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text with A-Z lower-cased in rows whose id's CRC-32 is divisible by 5."""
    hit = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return F.when(hit, F.translate(F.col(text_col), UPPER, UPPER.lower())).otherwise(F.col(text_col))


def _sql_hash(text: str) -> str:
    cols = [f"CAST({c} AS VARCHAR)" for c in COLUMNS[:-1]] + [text]
    return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}) || ':' || {c} END" for c in cols) + ")"


ORACLE = f"""
WITH RECURSIVE
f AS (SELECT doc_id, source, {_sql_hash('text')} AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {sql_crc('CAST(doc_id AS VARCHAR)')} % 5 = 0
          THEN {_sql_hash(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} ELSE {_sql_hash('text')} END AS found
      FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
        count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM f),
up(lvl, tree, idx, n, h) AS (
  SELECT 0, tree, idx, n, leaf FROM l
  UNION ALL
  SELECT lvl + 1, tree, idx // {ARITY}, (max(n) + {ARITY - 1}) // {ARITY}, sha256(string_agg(h, '' ORDER BY idx))
  FROM up WHERE n > 1 GROUP BY lvl, tree, idx // {ARITY}),
runs AS (SELECT lvl, tree, idx // {ARITY} AS run, list(h ORDER BY idx) AS hs FROM up WHERE n > 1 GROUP BY ALL),
subs AS (SELECT tree, h, count(*) OVER () AS n FROM up WHERE n = 1),
top(lvl, idx, n, h) AS (
  SELECT 0, tree, n, h FROM subs
  UNION ALL
  SELECT lvl + 1, idx // {ARITY}, (max(n) + {ARITY - 1}) // {ARITY}, sha256(string_agg(h, '' ORDER BY idx))
  FROM top WHERE n > 1 GROUP BY lvl, idx // {ARITY}),
top_runs AS (SELECT lvl, idx // {ARITY} AS run, list(h ORDER BY idx) AS hs FROM top WHERE n > 1 GROUP BY ALL),
walk(doc_id, leaf, lvl, tree, idx, n, acc, proof) AS (
  SELECT doc_id, leaf, 0, tree, idx, n, found, '' FROM l
  UNION ALL
  SELECT doc_id, leaf, w.lvl + 1, w.tree, idx // {ARITY}, (n + {ARITY - 1}) // {ARITY},
    sha256(array_to_string(hs[1:idx % {ARITY}], '') || acc || array_to_string(hs[idx % {ARITY} + 2:], '')),
    proof || array_to_string(hs[1:idx % {ARITY}], '') || array_to_string(hs[idx % {ARITY} + 2:], '')
  FROM walk w JOIN runs r ON r.lvl = w.lvl AND r.tree = w.tree AND r.run = w.idx // {ARITY} WHERE w.n > 1),
walk2(doc_id, leaf, subroot, lvl, idx, n, acc, proof) AS (
  SELECT doc_id, leaf, h, 0, w.tree, s.n, acc, proof FROM walk w JOIN subs s ON s.tree = w.tree WHERE w.n = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, w.lvl + 1, idx // {ARITY}, (n + {ARITY - 1}) // {ARITY},
    sha256(array_to_string(hs[1:idx % {ARITY}], '') || acc || array_to_string(hs[idx % {ARITY} + 2:], '')),
    proof || array_to_string(hs[1:idx % {ARITY}], '') || array_to_string(hs[idx % {ARITY} + 2:], '')
  FROM walk2 w JOIN top_runs r ON r.lvl = w.lvl AND r.run = w.idx // {ARITY} WHERE w.n > 1)
SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = t.h AS verified
FROM walk2 w, (SELECT h FROM top WHERE n = 1) t WHERE w.n = 1
"""
