"""Compare queries with their SQL: ``python tests/run_checks.py FOLDER [name ...]``.

Words of the form ``key=value`` are settings of the session.
"""

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__  # noqa: E402
from checks import differences, open_tables  # noqa: E402

if __name__ == "__main__":
    folder = sys.argv[1]
    names = [word for word in sys.argv[2:] if "=" not in word]
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for word in sys.argv[2:]:
        if "=" in word:
            builder = builder.config(*word.split("=", 1))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = open_tables(folder)
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in sql:
                found = differences(df, con, sql[name])
            else:
                found = "" if df.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            traceback.print_exc(limit=3)
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(found)
        print(f"{'BAD ' if found else 'ok  '} {name} {time.time() - start:.2f}s {found}", flush=True)
    print(f"{bad} bad")
    sys.exit(bool(bad))
