"""Run every registered query against its oracle: ``python tests/run_oracle.py [sf_dir] [keys...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from webcorpus.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if only and k not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if k in orc:
                problems, ns, nd = compare(df, con, orc[k])
            else:
                problems, ns, nd = [], df.count(), None
        except Exception as e:  # report and go on
            problems, ns, nd = [f"{type(e).__name__}: {str(e)[:600]}"], None, None
        status = "OK  " if not problems else "FAIL"
        bad += bool(problems)
        print(f"{status} {k:22s} rows={ns} oracle={nd} {time.time() - t:5.1f}s {'; '.join(problems)}", flush=True)
    print(f"{len([k for k in qs if not only or k in only]) - bad} ok, {bad} failing")


if __name__ == "__main__":
    main()
