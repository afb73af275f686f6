"""Command-line entry points.

``python -m liftkit.plans.cli measure --sf-dir DIR [--database DB] [--out DIR]``
    runs the measurement chain over the test tables, writes the four warehouse tables
    (replacing), CSV copies with headers and the one-object JSON run summary, and prints the
    estimate and the decision.

``python -m liftkit.plans.cli validate [--database DB | --warehouse-path DIR] [--corpus FILE ...]``
    scores the evidence rubric over the given text files (or the documents table of
    ``--sf-dir``), checks the required warehouse tables and prints PASS / NEEDS WORK.
"""

from __future__ import annotations

import argparse


from liftkit.operators import causal, quality
from liftkit.plans import measurement
from liftkit.session import ensure_checkpoint_dir, get_spark
from liftkit.sources import files
from liftkit.sources import tables as T


def measure(args) -> None:
    spark = get_spark()
    run = measurement.run_test_tables(spark, args.sf_dir, materialize="checkpoint", fit_forest=True)
    tables = run.warehouse()
    files.save_warehouse(spark, tables, database=args.database)
    out = args.out or f"{ensure_checkpoint_dir(spark).rstrip('/')}/liftkit-run"
    for name, df in tables.items():
        files.write_csv(df, f"{out}/csv/{name}")
        spark.table(f"{args.database}.{name}" if args.database else name).write.mode("overwrite").parquet(
            f"{out}/warehouse/{name}")
    summary = quality.quality_summary(run.listings, run.demand_panel, run.marketing, args.sf_dir)
    files.write_json_summary(summary, f"{out}/data_quality_summary")
    decided = causal.decision(run.metrics).first()
    for k, v in decided.asDict().items():
        print(f"{k}={v}")
    print(f"warehouse_database={args.database or spark.catalog.currentDatabase()}")
    print(f"outputs={out}")


def validate(args) -> None:
    spark = get_spark()
    if args.corpus:
        corpus = files.read_corpus(spark, args.corpus)
    else:
        corpus = T.read_table(spark, args.sf_dir, "documents")
    scores = quality.rubric_score(corpus)
    if args.warehouse_path:
        for name in files.child_names(spark, args.warehouse_path):
            spark.read.parquet(f"{args.warehouse_path.rstrip('/')}/{name}").createOrReplaceTempView(name)
    gate = quality.table_gate(spark, database=args.database)
    verdict = quality.rubric_verdict(scores, gate)
    for r in scores.orderBy("criterion_order").collect():
        print(f"{r['criterion']}: {r['score']}/{r['points']} ({r['found_signals'] or 'none'})")
    for r in gate.collect():
        print(f"table {r['table_name']}: {r['n_rows'] if r['present'] else 'absent'}")
    v = verdict.first()
    print(f"validation_score={v['total_score']}/{v['possible_score']}")
    print(f"validation_status={v['verdict']}")


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="liftkit")
    sub = p.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("measure")
    m.add_argument("--sf-dir", required=True)
    m.add_argument("--database", default=None)
    m.add_argument("--out", default=None)
    v = sub.add_parser("validate")
    v.add_argument("--sf-dir", default=None)
    v.add_argument("--database", default=None)
    v.add_argument("--corpus", nargs="*", default=None)
    v.add_argument("--warehouse-path", default=None, help="folder of parquet tables written by measure")
    args = p.parse_args(argv)
    {"measure": measure, "validate": validate}[args.cmd](args)


if __name__ == "__main__":
    main()
