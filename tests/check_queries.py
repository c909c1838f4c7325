"""Command line: run registered queries against their SQL twins and print one line each.

python -m tests.check_queries [--sf DIR] [name part ...]
"""

import argparse
import sys
import time

from pyspark.sql import SparkSession

import __spark_entry__ as entry_point
from tests.oracle import compare, connect


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(args.sf), entry_point.oracle_sql(), 0
    for name, query in entry_point.queries().items():
        if args.names and not any(part in name for part in args.names):
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, query, sqls[name], args.sf)
            else:
                rows = query(spark, args.sf).count()
                problem = None if rows else "no rows"
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql" if name in sqls else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {kind} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
