"""Submit entry: ``python -m stockloom daily|job|repair|backfill SOURCE STORE ...``."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession

from stockloom.plans.jobs import JOBS, MODES, Runner
from stockloom.plans.store import Store
from stockloom.session import apply_settings


def parser() -> argparse.ArgumentParser:
    day = dt.date.fromisoformat
    out = argparse.ArgumentParser(prog="stockloom")
    out.add_argument("--on-error", choices=("fail", "quarantine"), default="fail")
    commands = out.add_subparsers(dest="command", required=True)
    for name in ("daily", "job", "repair", "backfill"):
        c = commands.add_parser(name)
        c.add_argument("source", help="folder of the source tables")
        c.add_argument("store", help="root folder of the warehouse")
        if name == "daily":
            c.add_argument("--as-of", type=day, default=dt.date.today())
        if name in ("job", "repair"):
            c.add_argument("code", choices=list(JOBS))
        if name in ("daily", "job"):
            c.add_argument("--mode", choices=MODES, default="incremental" if name == "daily" else "full")
        if name != "daily":
            c.add_argument("--from", dest="low", type=day, required=name != "job")
            c.add_argument("--to", dest="high", type=day, required=name != "job")
    return out


def main(args: Sequence[str] | None = None, spark: SparkSession | None = None) -> list[int]:
    """Run one command; returns the ids of its batches."""
    a = parser().parse_args(args)
    spark = spark or apply_settings(SparkSession.builder.appName(f"stockloom-{a.command}")).getOrCreate()
    runner = Runner(spark, a.source, Store(spark, a.store), on_error=a.on_error)
    if a.command == "daily":
        return [runner.run_daily(a.as_of, a.mode)]
    if a.command == "job":
        return [runner.run_job(a.code, a.mode, a.low, a.high)]
    if a.command == "repair":
        return [runner.repair(a.code, a.low, a.high)]
    return runner.backfill(a.low, a.high)


if __name__ == "__main__":
    main()
