"""Command line: ``python -m roadledger <command>``."""

from __future__ import annotations

import argparse
import re
import sys
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import inventory
from .operators.timespan import partition_prefix
from .plans import compaction
from .plans.refresh import RefreshConfig, refresh, retrain_only
from .plans.reports import standard_reports
from .session import build_session
from .sources import crash_reports, load_core, telemetry


def _day(text: str) -> str:
    return datetime.strptime(text, "%Y-%m-%d").strftime("%Y-%m-%d")


def _size(text: str) -> int:
    """Megabytes, with or without the unit (``256`` or ``256MB``)."""
    found = re.fullmatch(r"(\d+)\s*(?:MB?)?", text.strip(), re.IGNORECASE)
    if not found:
        raise argparse.ArgumentTypeError(f"not a size in MB: {text!r}")
    return int(found.group(1))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="roadledger", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *options: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        return sub

    for name, text in (("refresh", "recalculate driver scores"), ("train", "retrain the accident model")):
        sub = command(name, text, "telemetry", "core", "home")
        sub.add_argument("--core-format", default="parquet", choices=("parquet", "csv"))
        sub.add_argument("--as-of", default=None, help="time of the run (default: now)")
        if name == "refresh":
            sub.add_argument("--force", action="store_true", help="run without new data, and retrain")
            sub.add_argument("--delete-tiny-files", action="store_true")

    sub = command("compact", "merge small telemetry files", "base")
    sub.add_argument("--date", required=True, type=_day)
    sub.add_argument("--days-back", type=int, default=0)
    sub.add_argument("--target-size", type=_size, default=compaction.TARGET_MB)
    sub.add_argument("--dry-run", action="store_true")

    sub = command("preview", "show what compaction would do", "base")
    which = sub.add_mutually_exclusive_group(required=True)
    which.add_argument("--date", type=_day)
    which.add_argument("--all", action="store_true")

    sub = command("inventory", "count files per date", "base", "saved")
    sub.add_argument("--month", help="YYYY-MM")
    sub.add_argument("--year", help="YYYY")

    sub = command("cleanup", "delete tiny telemetry files", "base")
    sub.add_argument("--threshold", type=int, default=compaction.TINY_BYTES)
    sub.add_argument("--dry-run", action="store_true")

    sub = command("report", "run a standard report", "telemetry", "crashes", "core")
    sub.add_argument("--core-format", default="parquet", choices=("parquet", "csv"))
    sub.add_argument("--name", default="all")
    sub.add_argument("--as-of", default=None)
    return top


def show(table: DataFrame) -> None:
    """All rows, tab-separated with a header, one partition at a time on the driver."""
    print("\t".join(table.columns))
    for row in table.toLocalIterator():
        print("\t".join("NULL" if v is None else str(v) for v in row))


def run(args: argparse.Namespace, spark) -> int:
    now = datetime.now().replace(microsecond=0)
    if args.command in ("refresh", "train"):
        as_of = datetime.fromisoformat(args.as_of) if args.as_of else now
        config = RefreshConfig(args.telemetry, args.core, args.home, core_format=args.core_format,
                               delete_tiny_files=getattr(args, "delete_tiny_files", False))
        if args.command == "train":
            show(retrain_only(spark, config, max_iter=15))
            return 0
        done = refresh(spark, config, as_of, args.force)
        print(done.status)
        for table in (done.statistics, done.alert, done.distribution, done.skipped):
            if table is not None:
                show(table)
    elif args.command == "compact":
        result = compaction.compact(
            spark, args.base, compaction.dates_back(args.date, args.days_back),
            target_mb=args.target_size, dry_run=args.dry_run, delete_tiny=True)
        show(result)
        return 0 if compaction.succeeded(result) else 1
    elif args.command == "preview":
        show(compaction.preview(spark, args.base, args.date).orderBy("date"))
    elif args.command == "inventory":
        prefix = args.month or args.year
        current, previous = compaction.snapshot(spark, args.base, args.saved, prefix)
        if prefix:
            current = partition_prefix(current, prefix)
        show(inventory.running_total(current).orderBy("date"))
        if previous is not None:
            changed = inventory.inventory_diff(current, previous).where(F.col("diff") != 0)
            show(changed.orderBy("date"))
    elif args.command == "cleanup":
        files = inventory.list_files(spark, args.base, pattern=compaction.TELEMETRY_FILES)
        show(inventory.cleanup_report(files, args.threshold))
        n = compaction.remove_tiny(spark, args.base, tiny_bytes=args.threshold, dry_run=args.dry_run)
        print(f"{'would delete' if args.dry_run else 'deleted'} {n} files")
    elif args.command == "report":
        reports = standard_reports(
            telemetry(spark, args.telemetry), crash_reports(spark, args.crashes),
            load_core(spark, args.core, args.core_format), args.as_of or str(now))
        for name in list(reports) if args.name == "all" else [args.name]:
            print(name)
            show(reports[name]())
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return run(args, build_session())


if __name__ == "__main__":
    sys.exit(main())
