"""Run every registered query against its oracle: python tests/run_oracles.py [sf_dir] [names...]"""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, duck  # noqa: E402
from dockhand.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = set(sys.argv[2:])
spark = build_session(shuffle_partitions=8)
con = duck(sf)
qs, sqls = entry.queries(), entry.oracle_sql()
bad = 0
for name, fn in qs.items():
    if only and name not in only:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if name in sqls:
            ok, msg = compare(df, con, sqls[name])
        else:
            ok, msg = True, f"rows-only {df.count()}"
    except Exception as e:  # noqa: BLE001
        ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        traceback.print_exc(limit=3)
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {name:30s} {time.time() - t:6.2f}s {msg}", flush=True)
print(f"{len(qs) - bad}/{len(qs)} ok" if not only else f"{bad} bad")
