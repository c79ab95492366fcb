"""Command line: run the zone job from a JSON configuration.

    python -m zonekit run config.json

config.json::

    {
      "landing": {"rentals": "...", "income": "...", "density": "...",
                  "district_lookups": ["...", "...", "..."],
                  "neighborhood_lookups": ["...", "...", "..."],
                  "format": "json"},
                  (each source: a path, or {"format": ..., "path": ..., "options": {...}})
      "root": "<shared folder for the zone tables>",       (optional)
      "steps": ["formatted", "kpis", "model"],            (optional)
      "reconcile_mode": "canon", "key": "neigh_name_reconciled", "listing_key": "propertyCode",
      "municipality": null, "impute_strategy": "none", "impute_value": null,
      "train_percent": 75, "gbt": {},
      "kpi_jdbc": {"url": "...", "table": "kpis", "user": "...", "password": "..."}   (optional)
    }

Prints the written table paths as JSON.

    python -m zonekit predict --model <dir> --listings <path> --income <path>
                              --density <path> --out <path> [--key name] [--format parquet]

prices new listings (flat rows) with a saved pipeline and writes them with a
``prediction`` column.
"""

from __future__ import annotations

import argparse
import json
import sys

from zonekit.plans.zones import ZoneConfig, read_landing, run_zones
from zonekit.session import build_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="zonekit")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="run the zone job")
    run.add_argument("config")
    run.add_argument("--master", default=None)
    pr = sub.add_parser("predict", help="price new listings with a saved model")
    for a in ("--model", "--listings", "--income", "--density", "--out"):
        pr.add_argument(a, required=True)
    pr.add_argument("--key", default="neighborhood_name")
    pr.add_argument("--format", default="parquet")
    pr.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    if args.cmd == "predict":
        return _predict(args)

    with open(args.config, encoding="utf-8") as f:
        cfg = json.load(f)
    spark = build_session(args.master, app_name="zonekit-zones")
    land = dict(cfg["landing"])
    fmt = land.pop("format", "json")
    inputs = read_landing(spark, fmt=fmt, **land)
    zc = ZoneConfig(root=cfg.get("root"), reconcile_mode=cfg.get("reconcile_mode", "canon"),
                    key=cfg.get("key", "neigh_name_reconciled"), municipality=cfg.get("municipality"),
                    listing_key=cfg.get("listing_key", "propertyCode"),
                    impute_strategy=cfg.get("impute_strategy", "none"),
                    impute_value=cfg.get("impute_value"), train_percent=cfg.get("train_percent", 75),
                    gbt_overrides=cfg.get("gbt", {}),
                    steps=tuple(cfg.get("steps", ("formatted", "kpis", "model"))))
    out = run_zones(spark, inputs, zc)
    jdbc = cfg.get("kpi_jdbc")
    if jdbc and "kpis" in out:
        from zonekit.sinks.writers import write_jdbc
        write_jdbc(spark.read.parquet(out["kpis"]), jdbc["url"], jdbc.get("table", "kpis"),
                   jdbc.get("user"), jdbc.get("password"), jdbc.get("driver"))
    print(json.dumps(out))
    spark.stop()
    return 0


def _predict(args) -> int:
    from zonekit.operators.model import load_model
    from zonekit.plans.features import predict_prices

    spark = build_session(args.master, app_name="zonekit-predict")
    rd = lambda p: spark.read.format(args.format).load(p)
    out = predict_prices(load_model(args.model), rd(args.listings), rd(args.income), rd(args.density),
                         key=args.key)
    keep = [c for c in out.columns if c not in ("features",) and not c.endswith("_index")]
    out.select(*keep).write.mode("errorifexists").parquet(args.out)
    print(json.dumps({"predictions": args.out}))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
