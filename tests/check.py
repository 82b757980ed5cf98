"""Command line check: python tests/check.py [data dir] [name prefix ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from stockloom.catalog import QUERIES, full_sql, run  # noqa: E402
from tests.compare import connect, differences  # noqa: E402


def main(argv):
    data = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(argv[2:]) or ("",)
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad, total = connect(data), 0, 0
    for name, q in QUERIES.items():
        if not name.startswith(prefixes):
            continue
        total += 1
        start = time.time()
        try:
            if q.sql is None:
                found, note = [], f"rows-only {run(q, spark, data).count()}"
            else:
                df = run(q, spark, data)
                found, note = differences(df, con, full_sql(q.sql)), "ok"
        except Exception as e:  # report and go on with the next query
            found, note = [f"{type(e).__name__}: {str(e)[:1500]}"], ""
        took = time.time() - start
        bad += bool(found)
        if found or took > 2.5 or note != "ok":
            print(f"{'FAIL' if found else note} {name} {took:.1f}s", *found, sep="\n    " if found else " ", flush=True)
    print(f"{total - bad}/{total} equal")


main(sys.argv)
