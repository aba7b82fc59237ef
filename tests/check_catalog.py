"""Command line check: python -m tests.check_catalog FOLDER [name ...]"""

import sys
import time

from pyspark.sql import SparkSession

from tests.oracle import compare, connect
from wardmill.catalog import registry


def main(folder, names):
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, e in registry().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        t0 = time.time()
        try:
            df = e.build(spark, folder)
            problems = compare(df, con, e.sql) if e.sql else [] if df.collect() is not None else ["no rows"]
        except Exception as x:  # report and go on
            problems = [f"{type(x).__name__}: {str(x)[:900]}"]
        n = "" if e.sql else " (no sql)"
        print(f"{'FAIL' if problems else 'ok  '} {time.time() - t0:6.1f}s {name}{n}", flush=True)
        for p in problems:
            bad += 1
            print("    ", p, flush=True)
    print("problems:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
