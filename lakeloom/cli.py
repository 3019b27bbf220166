"""Command line for the medallion jobs.

    python -m lakeloom.cli trade    --landing DIR --lake DIR [--full] [--run-ts 2024-03-01T06:00:00]
    python -m lakeloom.cli registry --landing DIR --lake DIR [--run-ts ...]

Runs bronze, silver and gold in order and prints each step's status table. The
session is the platform's (``getOrCreate``); only unset local settings are filled in.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from .plans import jobs
from .session import DEFAULT_CONF, ensure_checkpoint_dir


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("lakeloom").getOrCreate()
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) is None:
            try:
                spark.conf.set(k, v)
            except Exception:  # noqa: BLE001  (static settings cannot change at runtime)
                pass
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lakeloom")
    p.add_argument("domain", choices=["trade", "registry"])
    p.add_argument("--landing", required=True)
    p.add_argument("--lake", required=True)
    p.add_argument("--full", action="store_true", help="full refresh of the bronze tables instead of incremental")
    p.add_argument("--run-ts", default=None, help="ISO timestamp stamped on this run (default: now, UTC)")
    a = p.parse_args(argv)
    run_ts = (dt.datetime.fromisoformat(a.run_ts) if a.run_ts
              else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0))
    spark, lake = _session(), jobs.Lake(a.lake)
    if a.domain == "trade":
        steps = [jobs.bronze_trade(spark, a.landing, lake, run_ts, "full" if a.full else "incremental"),
                 jobs.silver_trade(spark, lake, run_ts), jobs.gold_trade(spark, lake, run_ts)]
    else:
        steps = [jobs.bronze_registry(spark, a.landing, lake, run_ts, "full" if a.full else "incremental"), jobs.silver_registry(spark, lake, run_ts),
                 jobs.gold_registry(spark, lake, run_ts)]
    failed = False
    for df in steps:
        df.show(df.count(), truncate=False)
        if "status" in df.columns:
            failed |= df.filter("status <> 'ok'").filter("mensagem <> 'no archives for this group'") \
                        .filter("mensagem <> 'no bronze table'").count() > 0
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
