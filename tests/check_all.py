"""python -m tests.check_all [sf_dir] [names...]: compare every query with its SQL twin."""

from __future__ import annotations

import sys
import time

import __spark_entry__ as entry
from stopgrid.session import build_session
from tests.compare import compare, connect


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name in names:
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, entry.queries()[name], oracles[name], sf_dir)
            else:
                n = len(entry.queries()[name](spark, sf_dir).collect())
                problem = None if n else "no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
