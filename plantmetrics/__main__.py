"""``python -m plantmetrics RAW_DIR BASE_DIR``: build all layers, print the stage report, exit 1 on failure."""

from __future__ import annotations

import argparse
import sys

from plantmetrics.plans.run import Layout, run_layers
from plantmetrics.session import build_session
from plantmetrics.sources import clear_scratch


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="plantmetrics", description=__doc__)
    parser.add_argument("raw_dir", help="folder with the four feeds")
    parser.add_argument("base_dir", help="folder that receives bronze, silver, gold and summary")
    parser.add_argument("--format", default="parquet", help="table format of the layers (default: parquet)")
    parser.add_argument("--no-csv", action="store_true", help="do not export the gold tables as CSV")
    parser.add_argument("--scada-lines", action="store_true", help="state events are JSON Lines, not an array")
    parser.add_argument("--drop-bad-rows", action="store_true", help="keep unreadable records out of bronze")
    parser.add_argument("--workers", type=int, default=4, help="tables written at the same time (default: 4)")
    parser.add_argument("--resume", action="store_true", help="keep the tables that an earlier run finished")
    options = parser.parse_args(arguments)

    spark = build_session()
    layout = Layout(
        options.raw_dir,
        options.base_dir,
        options.format,
        not options.no_csv,
        options.scada_lines,
        not options.drop_bad_rows,
    )
    report = run_layers(spark, layout, workers=options.workers, resume=options.resume).collect()
    clear_scratch(spark)
    for row in report:
        rows = "-" if row.rows is None else f"{row.rows:,}"
        bad = f"{row.bad_rows:,} bad" if row.bad_rows else ""
        print(f"{row.stage:<10} {row.table:<24} {rows:>16} {bad:>12} {row.seconds:>9.1f}s  {row.status}")
    return 0 if all(row.status in ("OK", "KEPT") for row in report) else 1


if __name__ == "__main__":
    sys.exit(main())
