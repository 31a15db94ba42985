"""Compare registered queries with their check SQL: check_queries.py [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from compare import connect, difference  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, bad = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            found = difference(df, con, checks[name]) if name in checks else f"(rows only: {df.count()})"
        except Exception as problem:  # report and go on
            found = f"{type(problem).__name__}: {str(problem)[:900]}"
        bad += bool(found) and not found.startswith("(rows")
        print(f"{name} {time.time() - start:.1f}s {found or 'OK'}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))
