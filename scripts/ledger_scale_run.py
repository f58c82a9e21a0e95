"""The ledger workload at N rows with per-step shuffle/spill totals from the event log.

    python scripts/ledger_scale_run.py [N] [BUCKETS]
"""
import os
import sys
import tempfile
import time
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from shuffle_report import summarize
from ledgerloom.session import build_session, scratch_path
from ledgerloom.plans import ledger_flow as lf
from ledgerloom.sources import ledger, delimited
from pyspark.sql import functions as F
log_dir = tempfile.mkdtemp(prefix="ledgerloom-eventlog-")
spark = build_session("local[8]", shuffle_partitions=32, extra_conf={
    "spark.driver.memory": "8g", "spark.eventLog.enabled": "true",
    "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false"})
sc = spark.sparkContext
N = int(sys.argv[1]) if len(sys.argv) > 1 else 20_000_000
BUCKETS = int(sys.argv[2]) if len(sys.argv) > 2 else 32
def step(name, fn):
    sc.setJobDescription(name); t = time.time(); out = fn(); print(f"{name:20s} {time.time()-t:6.2f}s", flush=True); return out
path = scratch_path(spark, "big-ledger")
step("generate", lambda: ledger.write_ledger_file(spark, N, path))
src = delimited.read_typed(spark, path, schema=ledger.ledger_schema())
tables = step("stage_load", lambda: lf.load_left_right(spark, lf.stage(src), scratch_path(spark, "big"), buckets=BUCKETS))
l, r = tables.left.scan(), tables.right.scan()
res = step("join_avg", lambda: lf.avg_account_by_dept(l, r).collect())
print(sorted((x[0], round(x[1], 6)) for x in res))
step("sql_join", lambda: lf.sql_join(spark, l, r).write.format("noop").mode("overwrite").save())
step("update", lambda: lf.update_unit(tables.right))
n = step("count_upd", lambda: tables.right.scan().where(F.col("BUSINESS_UNIT") == lf.UPDATE_TO_UNIT).count())
print("updated", n)
more = ledger.generate_ledger(spark, N + 2_000_000).where(F.col("id") > N - 1_000_000)
step("append_overlap", lambda: tables.left.append(lf.stage(more)))
print("left rows", tables.left.count())
sc.setJobDescription(None)
spark.stop()
rep = summarize(log_dir)
for k in ["generate", "stage_load", "join_avg", "sql_join", "update", "count_upd", "append_overlap"]:
    print(k, rep.get(k))
