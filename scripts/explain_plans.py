"""Write docs/PLANS.md: the physical plan tree and the scan details (pushed filters, read
schema) of the headline queries, as Spark plans them before execution.

Usage: python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from liftkit.plans.registry import QUERIES
    from liftkit.session import get_spark

    spark = get_spark()
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `scripts/explain_plans.py` on `{sf_dir}` (initial adaptive plans; AQE may",
           "switch join strategies and coalesce partitions at run time).", ""]
    for name in HEADLINE:
        if name not in QUERIES:
            continue
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n\n")[0]
        scans = [ln for ln in text.splitlines() if ln.startswith(("PushedFilters", "ReadSchema", "Location"))]
        n_exchange = tree.count("Exchange")
        out += [f"## {name}", "", f"Exchanges in the initial plan: {n_exchange}", "", "```", tree.strip(), "```", "",
                "Scans:", "", "```", *scans, "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main()
