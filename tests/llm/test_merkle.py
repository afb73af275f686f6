"""The Merkle manifest against a plain recursive build."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from liftkit.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def path_up(nodes, at, arity):
    """Siblings of node ``at`` upwards as (left, right) lists, and the root."""
    path = []
    while len(nodes) > 1:
        low = at // arity * arity
        path.append((nodes[low:at], nodes[at + 1: low + arity]))
        nodes = [h(*nodes[i: i + arity]) for i in range(0, len(nodes), arity)]
        at //= arity
    return path, nodes[0]


def brute(rows, arity):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r, h(*map(field, r))))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by_source[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    subs = [path_up([x for _, x in by_source[s]], 0, arity)[1] for s in sources]
    out = []
    for k, s in enumerate(sources):
        leaves = [x for _, x in by_source[s]]
        for i, (r, leaf) in enumerate(by_source[s]):
            path, sub = path_up(leaves, i, arity)
            top, root = path_up(subs, k, arity)
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            acc = h(*map(field, (*r[:4], text)))
            for left, right in path + top:
                acc = h(*left, acc, *right)
            proof = h(*[x for left, right in path + top for x in left + right])
            out.append((r[0], leaf, sub, root, proof, acc, acc == root))
    return sorted(out, key=repr)


def run(spark, rows, arity, **more):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name, value in more.items():
        docs = docs.withColumn(name, F.lit(value))
    found = merkle.verify(docs, arity=arity, changed={"text": merkle.lowered(docs)})
    return sorted([tuple(r) for r in found.collect()], key=repr)


@pytest.mark.parametrize("arity,n", [(16, 600), (2, 40), (3, 90)])
def test_equals_a_plain_build(spark, arity, n):
    rnd = random.Random(arity)
    rows = [(i, rnd.choice(["a", "a", "a", "b", "ß", "", None]), "en", 3, f"Text {i} Ä") for i in range(n)]
    rows += [(n, "lonely", "en", 3, "X"), (n + 1, "seventeen", None, None, None)]
    rows += [(n + 2 + i, "seventeen", "de", i, "T") for i in range(16)]
    assert run(spark, rows, arity) == brute(rows, arity)


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(None, None, None, None, None), (5, "s", "en", 1, ""), (5, "s", "en", 1, ""), (5, "s", "en", 2, "Z" * 300_000),
            (None, "s", "en", 1, "Q"), (7, None, "-", 0, "-")]
    want = brute(rows, 16)
    assert run(spark, rows, 16) == want
    assert run(spark, rows, 16, tree=1, idx="x", hash="y", path=2, root=3, part=4) == want


def test_one_row_and_empty_table(spark):
    rows = [(1, "a", "en", 1, "hey")]
    got = run(spark, rows, 16)
    assert got == brute(rows, 16)
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == hashlib.sha256(b"").hexdigest()
    assert run(spark, [], 16) == []
    docs = spark.createDataFrame([], SCHEMA)
    assert merkle.build(docs.select(F.col("doc_id").alias("id"), "source", F.lit(b"").alias("hash"))).root.count() == 0


def test_a_hot_source_is_spread_and_every_change_is_found(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("hot").alias("source"), F.lit("en").alias("lang"),
                                    F.lit(1).cast("long").alias("n_chars"), F.concat(F.lit("Row "), "id").alias("text"))
    numbered, trees = merkle.number_leaves(docs.select(F.col("doc_id").alias("id"), "source", F.lit(b"x").alias("hash")))
    assert [r.n for r in trees.collect()] == [3000]
    assert sorted(r.idx for r in numbered.collect()) == list(range(3000))
    bad = merkle.verify(docs, changed={"lang": F.when(F.col("doc_id") == 1234, "de").otherwise(F.col("lang"))}).filter("NOT verified")
    assert [r.doc_id for r in bad.collect()] == [1234]
