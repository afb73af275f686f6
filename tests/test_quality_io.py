"""Rubric rounding, table gate, CSV sources and sinks, corpus reading."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F

from liftkit.operators import quality
from liftkit.sources import files


def test_rubric_half_even_and_case(spark):
    rubric = [("three of four", 10, ["alpha", "Beta", "gamma", "delta"]), ("one of four", 10, ["alpha", "x1", "x2", "x3"]),
              ("none", 10, ["zzz"])]
    docs = spark.createDataFrame([(1, "ALPHA and beta"), (2, "some Gamma here"), (3, None)], "doc_id long, text string")
    out = {r["criterion"]: r for r in quality.rubric_score(docs, rubric=rubric).collect()}
    assert out["three of four"]["score"] == 8  # 7.5 -> 8
    assert out["one of four"]["score"] == 2  # 2.5 -> 2 (half to even)
    assert out["three of four"]["found_signals"] == "alpha, Beta, gamma"
    assert out["none"]["score"] == 0 and out["none"]["found_signals"] == ""
    v = quality.rubric_verdict(quality.rubric_score(docs, rubric=rubric)).first()
    assert (v["total_score"], v["possible_score"], v["verdict"]) == (10, 30, "NEEDS WORK")


def test_table_gate(spark):
    spark.range(3).createOrReplaceTempView("gate_a")
    spark.range(0).createOrReplaceTempView("gate_b")
    out = {r["table_name"]: r for r in quality.table_gate(spark, ("gate_a", "gate_b", "gate_missing")).collect()}
    assert out["gate_a"]["ok"] == 1 and out["gate_b"]["ok"] == 1 and out["gate_b"]["nonempty"] == 0 and out["gate_missing"]["present"] == 0
    assert out["gate_a"]["tables_ok"] == 0
    ok = quality.table_gate(spark, ("gate_a",)).first()
    assert ok["tables_ok"] == 1 and ok["n_rows"] == 3


def test_listing_csv_with_embedded_comma_quote_newline(spark):
    d = tempfile.mkdtemp(prefix="liftkit-test-")
    path = os.path.join(d, "listings.csv")
    with open(path, "w") as f:
        f.write("id,name,price\n")
        f.write('1,"Cozy, bright ""loft""\nnear park","$1,200.00"\n')
        f.write("2,plain,$5\n")
    df = files.read_csv(spark, path, "id long, name string, price string")
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["name"] == 'Cozy, bright "loft"\nnear park' and rows[1]["price"] == "$1,200.00"
    out = files.scratch_path(spark, "t")
    files.write_csv(df, out)
    back = {r["id"]: r for r in files.read_csv(spark, out, "id long, name string, price string").collect()}
    assert back == rows


def test_export_with_index_reread(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id long, v string")
    path = files.scratch_path(spark, "exp")
    files.write_export_with_index(df, path, "id")
    raw = spark.read.option("header", True).csv(path)
    idx = {int(r["v"] == r["v"] and r[0]): r["v"] for r in raw.collect()}
    assert sorted(idx) == [0, 1, 2]
    back = files.read_export(spark, path)
    assert back.columns == ["id", "v"] and back.count() == 3


def test_read_corpus_skips_absent(spark):
    d = tempfile.mkdtemp(prefix="liftkit-corpus-")
    p = os.path.join(d, "a.md")
    with open(p, "wb") as f:
        f.write(b"Line one\nline \xff two\n")
    df = files.read_corpus(spark, [p, os.path.join(d, "missing.md")])
    rows = df.collect()
    assert len(rows) == 1 and "Line one\nline" in rows[0]["text"]
    for same in (f"file:{p}", os.path.join(d, "*.md")):
        assert [r["text"] for r in files.read_corpus(spark, [same]).collect()] == [rows[0]["text"]]
    with pytest.warns(UserWarning, match="missing.md"):
        files.read_corpus(spark, [os.path.join(d, "missing.md")])


def test_save_warehouse_and_counts(spark):
    from liftkit.operators import quality

    tables = {"wh_a": spark.range(4), "wh_b": spark.range(2).withColumn("x", F.lit(1.5))}
    files.save_warehouse(spark, tables, database="liftkit_test_wh")
    files.save_warehouse(spark, tables, database="liftkit_test_wh")  # replaces, does not append
    counts = {r["table_name"]: r["n_rows"] for r in quality.table_counts(spark, database="liftkit_test_wh").collect()}
    assert counts == {"wh_a": 4, "wh_b": 2}
    gate = quality.table_gate(spark, ("wh_a", "wh_b"), database="liftkit_test_wh").collect()
    assert all(r["tables_ok"] == 1 for r in gate)


def test_json_summary(spark):
    import json

    df = spark.createDataFrame([(3, ["A", "B"])], "raw_listing_rows long, boroughs array<string>")
    path = files.scratch_path(spark, "summary")
    files.write_json_summary(df, path)
    parts = [p for p in os.listdir(path) if p.endswith(".json")]
    with open(os.path.join(path, parts[0])) as f:
        obj = json.loads(f.readline())
    assert obj == {"raw_listing_rows": 3, "boroughs": ["A", "B"]}


def test_recommended_conf_keeps_cluster_settings(spark):
    from liftkit.session import apply_conf, recommended_conf

    conf = recommended_conf(100 * 1024 ** 4, 8000)
    assert conf["spark.sql.shuffle.partitions"] == "65536"
    assert recommended_conf(10 * 1024 ** 3, 8)["spark.sql.shuffle.partitions"] == "41"
    applied = apply_conf(spark, {"spark.sql.shuffle.partitions": "999"})
    assert applied == {} and spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_whole_files_are_decoded_without_python(spark):
    import random

    rng = random.Random(5)
    pieces = [b"a", b"\n", b"\x01", b"\x01\x02", b"\x01\x03", "�".encode(), "é".encode(), "漢".encode(), "😀".encode(), b"\xff",
              b"\xc3", b"\xe2\x82", b"\xed\xa0\x80", b"\xf0\x9f\x98", b"\xc0\xaf", b"\x80", b"\xf4\x90\x80\x80", b"\x00"]
    texts = [b"".join(rng.choice(pieces) for _ in range(60)) for _ in range(300)] + [bytes(rng.randrange(256) for _ in range(500))]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw binary")
    got = {r["i"]: r["text"] for r in rows.select("i", files.decoded("raw").alias("text")).collect()}
    assert got == {i: t.decode("utf-8", errors="ignore") for i, t in enumerate(texts)}
    d = tempfile.mkdtemp(prefix="liftkit-corpus-")
    with open(os.path.join(d, "a.txt"), "wb") as f:
        f.write(b"one \xff two")
    for whole in (True, False):
        df = files.read_corpus(spark, [f"{d}/*.txt"], whole)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
        assert df.first()["text"] == "one  two"
