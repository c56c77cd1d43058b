"""python tests/check_all.py [sf] [names...]: every query against its SQL, with times."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import connect, differences  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from quarrydesk.session import build_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = build_session(cores=8), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name, fn in queries.items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            if name in oracles:
                found = differences(fn(spark, sf_dir), con, oracles[name])
                verdict = "ok" if not found else "DIFF " + "; ".join(found)
            else:
                verdict = f"rows {fn(spark, sf_dir).count()}"
        except Exception as error:
            verdict = "ERROR " + str(error)[:600]
        print(f"{name:32s} {time.time() - began:6.1f}s {verdict[:1200]}", flush=True)
    missing = set(oracles) - set(queries)
    if missing:
        print("oracles without a query:", missing)


if __name__ == "__main__":
    main()
