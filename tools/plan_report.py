"""Execute every registered query and summarise its final (adaptive) plan:
shuffles, broadcasts, join strategies, aggregate operators and what the
scans read. Writes Markdown to stdout.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zonekit.plans import catalog  # noqa: E402
from zonekit.session import build_session  # noqa: E402

MULTI_JOB = {"zones_kpis": "whole job; each published table is its own job",
             "kpi_imputed": "the KPI table (plan as `kpi_table`) is written once to the checkpoint "
                            "folder; the returned frame reads it and fills from one scalar subquery",
             "kpi_stream": "streaming micro-batches (see tests/test_streaming.py)",
             "kpi_imputed_median": "as `kpi_imputed`",
             "lookup_files": "files written and read back; the returned frame reads the last of them",
             "model_flag_means": "model fitted, saved and loaded first; the returned frame scores the test rows",
             "predict_listings": "model fitted, saved and loaded first; the returned frame scores all listings",
             "gbt_metrics": "feature frame written once, then iterative model fit; the returned "
                            "frame is the metrics pass over the written test rows"}


def summarise(plan: str) -> dict:
    count = lambda pat: len(re.findall(pat, plan))
    scans = re.findall(r"FileScan parquet (?:\S+\.)?\S*\[([^\]]*)\][^\n]*?Location: InMemoryFileIndex\([^)]*\)\[([^\]]*)\]", plan)
    return {
        "hash shuffles": count(r"Exchange hashpartitioning"),
        "range shuffles": count(r"Exchange rangepartitioning"),
        "broadcasts": count(r"BroadcastExchange"),
        "SMJ": count(r"SortMergeJoin"),
        "BHJ": count(r"BroadcastHashJoin"),
        "aggregates": ", ".join(sorted({m for m in re.findall(r"(\w*Aggregate)\(", plan)})) or "-",
        "scans": "; ".join(sorted({f"{os.path.basename(loc.rstrip('/'))}({len(cols.split(','))} cols)"
                                   for cols, loc in scans})) or "-",
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra_conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Final plans of the registered queries ({os.path.basename(sf)}, local[8], "
          "AQE on)\n")
    print("Generated by `tools/plan_report.py`. Counts are operators in the final adaptive plan "
          "(after AQE re-planning); `scans` lists each table read and how many columns it reads.\n")
    print("| query | hash shuffles | range shuffles | broadcasts | SMJ | BHJ | aggregates | scans |")
    print("|---|---|---|---|---|---|---|---|")
    notes = []
    for name, fn in catalog.queries().items():
        df = fn(spark, sf)
        query = df._jdf.queryExecution()
        query.toRdd().count()  # executes this very frame: its adaptive plan is final afterwards
        plan = query.executedPlan().toString()
        if "AdaptiveSparkPlan" in plan and "isFinalPlan=true" not in plan:
            raise RuntimeError(f"{name}: the plan is not final")
        plan = plan.split("+- == Initial Plan ==")[0]
        s = summarise(plan)
        if name in MULTI_JOB:
            s["scans"] = "see notes"
        print(f"| `{name}` | {s['hash shuffles']} | {s['range shuffles']} | {s['broadcasts']} | {s['SMJ']} | "
              f"{s['BHJ']} | {s['aggregates']} | {s['scans']} |")
        if name in MULTI_JOB:
            notes.append(f"- `{name}`: {MULTI_JOB[name]}.")
    print("\nNotes:\n")
    print("\n".join(notes))
    print("- Alias tables are written once to the checkpoint folder and read back (`Scan ExistingRDD`), "
          "so they do not appear as file scans.")
    spark.stop()


if __name__ == "__main__":
    main()
