"""Job entry point: ``python -m telemetry_lake`` or ``spark-submit`` of this module.

    python -m telemetry_lake --root /lake --stage full
    python -m telemetry_lake --root /lake --stage silver
    python -m telemetry_lake --root /lake --stats

``--root`` sets ``landing/ bronze/ silver/ gold/`` below one folder; each can
be overridden.  Prints the stage result (or the statistics) as JSON; exit
status 0 on success, 1 on failure.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from telemetry_lake.plans.jobs import LakeConfig, run_all, run_bronze, run_gold, run_silver


def _config(args: argparse.Namespace) -> LakeConfig:
    root = (args.root or "").rstrip("/")

    def pick(given: str | None, name: str) -> str:
        if given:
            return given
        if not root:
            raise SystemExit(f"--{name} or --root is required")
        return f"{root}/{name}"

    return LakeConfig(
        landing_path=pick(args.landing, "landing"),
        bronze_path=pick(args.bronze, "bronze"),
        silver_path=pick(args.silver, "silver"),
        gold_path=pick(args.gold, "gold"),
        multi_line=not args.line_per_response,
        bronze_mode=args.bronze_mode,
        report_tz=args.report_tz,
        api_url_template=args.api_url_template,
        fetch_amount=args.batch_size,
        page_size=args.page_size,
        pages_per_task=args.pages_per_task,
        top_k=args.top_k,
        silver_sort=not args.no_silver_sort,
        **({"patterns": args.pattern} if args.pattern else {}),
    )


def lake_stats(spark: SparkSession, cfg: LakeConfig) -> dict:
    """Bronze, latest-silver and gold statistics (one small row each)."""
    from telemetry_lake.operators.stats import bronze_file_stats, bronze_stats, silver_stats
    from telemetry_lake.sources.bronze_store import read_bronze
    from telemetry_lake.sources.layers import gold_stats, latest_silver_path, list_reports, read_silver

    def one(df) -> dict:
        return {k: (v.isoformat() if hasattr(v, "isoformat") else v) for k, v in df.first().asDict().items()}

    out: dict = {}
    try:
        bronze = read_bronze(spark, cfg.bronze_path)
        out["bronze"] = {**one(bronze_stats(bronze)), **one(bronze_file_stats(bronze))}
    except Exception as exc:  # noqa: BLE001 - report what exists
        out["bronze"] = {"error": str(exc)}
    latest = latest_silver_path(spark, cfg.silver_path)
    out["silver"] = ({"file_path": latest, **one(silver_stats(read_silver(spark, latest)))}
                     if latest else None)
    reports = gold_stats(list_reports(spark, cfg.gold_path)).collect()  # one row per report type
    out["gold"] = {"total_reports": sum(r.reports for r in reports),
                   "report_types": {r.report: r.reports for r in reports},
                   "latest_reports": {r.report: r.latest_file for r in reports}}
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="telemetry_lake", description=__doc__.split("\n\n")[0])
    p.add_argument("--stage", choices=["full", "bronze", "silver", "gold"], default="full")
    p.add_argument("--stats", action="store_true", help="print layer statistics instead of running")
    p.add_argument("--root", help="folder holding landing/ bronze/ silver/ gold/")
    p.add_argument("--landing")
    p.add_argument("--bronze")
    p.add_argument("--silver")
    p.add_argument("--gold")
    p.add_argument("--batch-id")
    p.add_argument("--silver-path", help="gold stage: silver run to report on (default: latest)")
    p.add_argument("--bronze-mode", choices=["replace", "overwrite", "append"], default="replace")
    p.add_argument("--report-tz", default="UTC")
    p.add_argument("--top-k", type=int, default=10, help="speeds per hour in the speed report")
    p.add_argument("--no-silver-sort", action="store_true", help="skip the global sort of silver")
    p.add_argument("--pattern", action="append", help="pattern of the text report (repeatable; default: the built-in list)")
    p.add_argument("--pages-per-task", type=int, default=0, help="API pages fetched by one task (0: automatic)")
    p.add_argument("--line-per-response", action="store_true",
                   help="landing files hold one JSON array per line")
    p.add_argument("--api-url-template",
                   help="fetch from the API instead of landing files, e.g. "
                        "'https://api.example.com/vehicle_messages?amount={amount}'")
    p.add_argument("--batch-size", type=int, default=10000, help="messages to fetch")
    p.add_argument("--page-size", type=int, default=1000, help="messages per request")
    args = p.parse_args(argv)
    cfg = _config(args)
    if spark is None:
        from telemetry_lake.session import lake_session

        spark = lake_session()
    if args.stats:
        print(json.dumps(lake_stats(spark, cfg), default=str))
        return 0
    if args.stage == "full":
        try:
            result = run_all(spark, cfg, batch_id=args.batch_id)
        except RuntimeError as exc:
            print(json.dumps({"status": "failed", "error": str(exc)}))
            return 1
    elif args.stage == "bronze":
        result = run_bronze(spark, cfg, args.batch_id)
    elif args.stage == "silver":
        result = run_silver(spark, cfg)
    else:
        result = run_gold(spark, cfg, args.silver_path)
    print(json.dumps(result, default=str))
    return 0 if result.get("status") == "success" else 1


if __name__ == "__main__":
    sys.exit(main())
