"""Print the final physical plan of a named query after running it.

Usage: python tools/plans.py QUERY [sf_dir]
Runs the query to completion (so AQE's final plan is shown), then prints
``explain("formatted")``: scans with ReadSchema / PushedFilters, exchanges,
joins and codegen stages.
"""

from __future__ import annotations

import sys


def main(argv):
    name = argv[1]
    sf_dir = argv[2] if len(argv) > 2 else "/root/testdata/sf0.01"
    sys.path.insert(0, ".")
    from tagpulse.plans.catalog import QUERIES
    from tagpulse.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    df = QUERIES[name](spark, sf_dir)
    df.collect()
    df.explain("formatted")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
