"""The pipeline stage by stage against plain Python, and the entry module without it."""

import subprocess
import sys

from pyspark.sql import functions as F

import corpus_pipeline
from liftkit.llm.common import materialise, table

from .test_repeats_and_near_duplicates import brute_near

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    extra = spark.createDataFrame([(-1, "12 34 !!", "en", "src0", 8), (-2, None, "de", "src1", 0)], docs.schema)
    docs = materialise(docs.unionByName(extra), "documents")
    names = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard_join", "source_mixing", "packing"]
    before = {r["doc_id"]: r for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), name)
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == names
            assert all(before[r["doc_id"]] == r for r in kept[name])
    ids = {n: sorted(r["doc_id"] for r in rows) for n, rows in kept.items()}
    assert ids["language_id"] == sorted(i for i in before if i >= 0)
    best = {}
    for r in kept["language_id"]:
        best[r["text"]] = max(best.get(r["text"], -1), r["doc_id"])
    assert ids["exact_dedup"] == sorted(best.values())
    near = brute_near([(r["doc_id"], r["text"]) for r in kept["exact_dedup"]])
    assert ids["ngram_jaccard_join"] == sorted({c for _, c, _, _ in near})
    assert set(ids["source_mixing"]) == set(ids["ngram_jaccard_join"])
    assert max(ids["source_mixing"].count(i) for i in set(ids["source_mixing"])) <= 3
    pieces = docs.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert {r["doc_id"] for r in pieces} == set(ids["source_mixing"])
    assert all(r["n"] == r["t"] * ids["source_mixing"].count(r["doc_id"]) for r in pieces)


def test_run_gives_the_stages_result(spark):
    assert corpus_pipeline.run(spark, SF).columns[:2] == ["doc_id", "start"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_entry_without_the_subpackage():
    code = ("import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries();"
            "assert 'did_estimate' in q and not any(k.startswith('op') and k[2].isdigit() for k in q) and 'pipeline' not in q; e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])


def test_entry_has_all_eleven():
    code = ("import __spark_entry__ as e; q = list(e.queries());"
            "assert all(sum(k.startswith(f'op{n}_') for k in q) == 1 for n in range(1, 11)) and 'pipeline' in q; assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])


def test_packing_takes_texts_in_small_batches(spark, monkeypatch, tmp_path):
    from liftkit.llm import packing

    seen = tmp_path / "batches"
    inner = packing._tokenise

    def watched(path, length):
        def run(batches):
            def passing():
                for b in batches:
                    with open(seen, "a") as f:
                        f.write(f"{b.num_rows}\n")
                    yield b
            yield from inner(path, length)(passing())
        return run

    monkeypatch.setattr(packing, "_tokenise", watched)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(3000)], "doc_id long, text string").coalesce(1)
    assert packing.pack(docs).count() == 3000 and spark.conf.get(key) == before
    sizes = [int(n) for n in seen.read_text().split()]
    assert sum(sizes) == 3000 and max(sizes) <= 1000


def test_language_judges_each_text_once_a_pass(spark, monkeypatch):
    from liftkit.llm import language_id

    nodes = {}

    def watched(df, name, few_files=False):
        nodes[name] = df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")
        return materialise(df, name, few_files)

    monkeypatch.setattr(language_id, "materialise", watched)
    language_id.identify(table(spark, SF, "documents"), declared_col="lang", host_col="source")
    assert nodes["host_counts"] == 1
    rows = spark.createDataFrame([("a", 0), ("a", None), ("b", None), (None, 1), (None, None)], "host string, guess int")
    assert {r["host"] for r in language_id.host_priors(rows).collect()} == {"a", None}


def test_near_duplicates_take_texts_in_small_batches(spark, monkeypatch, tmp_path):
    from liftkit.llm import chosen_path

    seen = tmp_path / "batches"
    inner = chosen_path._sketch

    def watched(runs):
        def run(batches):
            def passing():
                for b in batches:
                    with open(seen, "a") as f:
                        f.write(f"{b.num_rows}\n")
                    yield b
            yield from inner(runs)(passing())
        return run

    monkeypatch.setattr(chosen_path, "_sketch", watched)
    docs = spark.createDataFrame([(i, f"text {i} of five or more words") for i in range(2500)], "doc_id long, text string").coalesce(1)
    assert chosen_path.near_duplicates(docs).count() == 2500
    sizes = [int(n) for n in seen.read_text().split()]
    assert sum(sizes) == 2500 and max(sizes) <= 1000
