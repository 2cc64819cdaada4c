"""The daily batch as a program for ``spark-submit``: all layer tables from the landing tables, then their checks.

``spark-submit tablespoon/daily_job.py --root /shared/lake --landing /shared/landing --format csv``
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from tablespoon.operators.silver import TEST_ACCOUNTS
from tablespoon.plans import Warehouse, build_all, failed_checks
from tablespoon.session import get_spark, release
from tablespoon.sources import LANDING_SCHEMAS, Layout, load_landing


def main(arguments: list[str] | None = None) -> dict[str, int]:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="folder of the bronze, silver and gold layers")
    parser.add_argument("--landing", required=True, help="folder with one folder or file per landing table")
    parser.add_argument("--format", default="csv", choices=("csv", "parquet"))
    parser.add_argument("--single-line", action="store_true", help="no field of the csv files has a newline")
    parser.add_argument("--test-accounts", default=None, help="file with one user id a line, instead of the known test accounts")
    parser.add_argument("--ingested-at", default=None, help="ISO timestamp; now, if not given")
    given = parser.parse_args(arguments)
    spark = get_spark("daily")
    stamp = given.ingested_at or dt.datetime.now(dt.UTC).isoformat()
    source = Layout(given.root, (("landing", given.landing),))

    def landing(name: str):
        return load_landing(spark, source.path("landing", name), given.format, LANDING_SCHEMAS[name], not given.single_line)

    accounts = spark.read.text(given.test_accounts).toDF("user_id") if given.test_accounts else TEST_ACCOUNTS
    warehouse = Warehouse(spark, landing, source, stamp, accounts)
    written = build_all(warehouse)
    failed = failed_checks(warehouse)
    release(spark)
    if failed:
        raise SystemExit(f"checks failed: {failed}")
    rows = {f"{layer}.{name}": n for (layer, name), n in written.items()}
    print(json.dumps(rows))
    return rows


if __name__ == "__main__":
    main()
