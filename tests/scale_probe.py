"""Scale probe: the summary and the ranking on a blown-up, skewed copy of ``events``.

``events`` is replicated ``COPIES`` times with new user ids per copy, and one
actor receives a third of all fact rows. The probe runs the daily summary
(merge + running totals), the date-range invitation list and the global-sort
ranking, and reports, per heavy stage, the largest task input against the
median, read from Spark's event log (written to a fresh scratch folder).

Usage: python tests/scale_probe.py [copies] [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 50
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="cohortline-probe-")
    from pyspark.sql import functions as F

    from cohortline.operators import quota, ranking
    from cohortline.plans import invitations as inv
    from cohortline.plans.summary import daily_summary, spec_v4
    from cohortline.session import build_session, checkpoint
    from cohortline.sources import fixtures
    from cohortline.sources.catalog import SCHEMAS

    spark = build_session(shuffle_partitions=64, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch,
        "spark.eventLog.compress": "false", "spark.ui.showConsoleProgress": "false"})
    events = spark.read.schema(SCHEMAS["events"]).parquet(f"{sf_dir}/events.parquet")
    n_users = events.agg(F.max("user_id")).first()[0] + 1
    big = (events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
           .withColumn("event_id", F.col("event_id") * copies + F.col("copy"))
           .withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0))
                       .otherwise(F.col("user_id") + F.col("copy") * n_users))
           .drop("copy"))
    path = f"{scratch}/events.parquet"
    big.write.parquet(path)
    base = scratch
    # customers / orders for the blown-up user ids
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet")
    cust.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn(
        "c_custkey", F.col("c_custkey") + F.col("copy") * n_users).drop("copy").write.parquet(
        f"{base}/customer.parquet")
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.parquet(f"{base}/orders.parquet")

    src = fixtures.load_sources(spark, base)
    rows = spark.read.parquet(path).count()
    timings = {}

    t = time.time()
    summary = daily_summary(src, spec_v4("2024-01-31", 30))
    summary.write.format("noop").mode("overwrite").save()
    timings["summary"] = time.time() - t

    t = time.time()
    inv.invitation_list_range(src, "2024-01-10", "2024-01-25", 300, 30, "bo_turnover_usd", 5, 2000,
                              False, as_of="2024-01-31").write.format("noop").mode("overwrite").save()
    timings["invitation_list_range"] = time.time() - t

    t = time.time()
    active = checkpoint(summary.filter(F.col("cumulative_bo_turnover_usd") >= 100)
                        .select("actor_id", "date", F.col("cumulative_bo_turnover_usd").alias("metric_value"),
                                (F.col("actor_id") % 4 == 0).cast("string").alias("country")))
    q = quota.quota_table(active, ["country"], 5, 1000, "capped", with_rows=True)
    kept = ranking.rank_and_cut(active, q, ["country"])
    kept.write.format("noop").mode("overwrite").save()
    timings["rank_in_parts"] = time.time() - t
    spark.stop()

    stages = []
    for f in glob.glob(f"{scratch}/*/events_*") + glob.glob(f"{scratch}/local-*"):
        if not os.path.isfile(f):
            continue
        tasks = {}
        for line in open(f, errors="ignore"):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if e.get("Event") == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                sr = m.get("Shuffle Read Metrics") or {}
                read = (sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                        + (m.get("Input Metrics") or {}).get("Bytes Read", 0))
                tasks.setdefault(e["Stage ID"], []).append(read)
        for sid, reads in tasks.items():
            if len(reads) >= 8 and sum(reads) > 1 << 20:
                stages.append((sid, len(reads), sum(reads) >> 20, max(reads) >> 10,
                               int(statistics.median(reads)) >> 10))
    print(json.dumps({"copies": copies, "fact_rows": rows, "hot_actor_share": "1/3",
                      "timings_sec": {k: round(v, 2) for k, v in timings.items()}}))
    print("stage tasks total_MB max_task_KB median_task_KB")
    for s in sorted(stages):
        print(*s)


if __name__ == "__main__":
    main()
