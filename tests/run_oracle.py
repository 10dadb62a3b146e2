"""Run every registered query against its DuckDB oracle (CLI twin of test_oracle)."""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_harness import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = set(sys.argv[2:])
spark = build_session("local[8]", 8)
if os.environ.get("LEDGERLENS_TZ"):
    spark.conf.set("spark.sql.session.timeZone", os.environ["LEDGERLENS_TZ"])
for item in filter(None, os.environ.get("LEDGERLENS_CONF", "").split(",")):
    k, v = item.split("=", 1)
    spark.conf.set(k, v)
con = duck(sf_dir)
qs, sqls = E.queries(), E.oracle_sql()
bad = 0
for key, fn in qs.items():
    if only and key not in only:
        continue
    t = time.time()
    try:
        df = fn(spark, sf_dir)
        if key in sqls:
            problems, n = compare(df, con, sqls[key])
        else:
            n, problems = df.count(), ["(no oracle)"]
    except Exception as exc:  # report and continue
        problems, n = [f"ERROR {type(exc).__name__}: {str(exc)[:400]}"], -1
    ok = not problems or problems == ["(no oracle)"]
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {key:28s} rows={n:<7} {time.time()-t:5.1f}s {'; '.join(problems)}", flush=True)
print("failures:", bad)
