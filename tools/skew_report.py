"""Skew check from Spark's event log: one user holds a third of ``events``.

    python tools/skew_report.py [sf_dir]

Runs forward fill over ``events`` where every third event is re-keyed to user
0, once with a plain window (partitioned by user) and once with
``chunk_by=date_trunc('hour', ts)``. The event log (written to a fresh scratch
folder) gives the shuffle records read by each task of each stage; the report
prints, per run, the largest stage's max / median records per task.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.operators import clean  # noqa: E402
from tessera.session import local_session  # noqa: E402


def task_records(log_dir: str, job_group: str) -> dict[int, list[int]]:
    """Shuffle records read per task, by stage, for the jobs of one group."""
    stages_of_group, per_stage = set(), {}
    paths = glob.glob(os.path.join(log_dir, "eventlog_v2_*", "events_*")) or \
        glob.glob(os.path.join(log_dir, "*"))
    for path in sorted(p for p in paths if os.path.isfile(p)):
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == job_group:
                        stages_of_group.update(ev.get("Stage IDs", []))
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    recs = m.get("Total Records Read", 0)
                    per_stage.setdefault(ev["Stage ID"], []).append(recs)
    return {s: v for s, v in per_stage.items() if s in stages_of_group and sum(v) > 0}


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="tessera-skew-")
    logs = os.path.join(scratch, "events")
    os.makedirs(logs)
    spark = local_session(8, shuffle_partitions=32, extra={
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
        "spark.eventLog.compress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = spark.read.parquet(f"{d}/events.parquet").select(
        "event_id", "ts",
        F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"),
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")).alias("value"))
    runs = {"plain window": None, "chunk_by hour": F.date_trunc("hour", F.col("ts"))}
    for name, chunk in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        clean.forward_fill(ev, ["value"], ["user_id"], ["ts", "event_id"], chunk_by=chunk) \
             .write.format("noop").mode("overwrite").save()

    # target encoding through the sort-merge path (map tiers forced off) with
    # one category on a third of the rows: without and with hot-key salting
    from tessera.operators.encode import Encoder
    cat = ev.select("event_id", "value", F.when(F.col("event_id") % 3 == 0, F.lit("hot"))
                    .otherwise(F.concat(F.lit("c"), (F.col("event_id") % 5000).cast("string")))
                    .alias("cat"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    for name, share in (("join, no salting", 1.0), ("join, hot key salted", 1e-3)):
        spark.sparkContext.setJobGroup("fit", "fit")
        fitted = Encoder("target", cols=["cat"], label="value", literal_limit=0,
                         broadcast_limit=0, hot_share=share).fit(cat)
        spark.sparkContext.setJobGroup(name, name)
        fitted.transform(cat).write.format("noop").mode("overwrite").save()
        runs[name] = None
    spark.stop()
    print(f"# one key holds a third of events ({os.path.basename(d)}, 32 partitions)\n")
    print("| run | stage | tasks | max records / task | median records / task | max / median |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name in runs:
        stages = task_records(logs, name)
        if not stages:
            continue
        sid, recs = max(stages.items(), key=lambda kv: sum(kv[1]))     # the data stage
        med = statistics.median(recs) or 1
        print(f"| {name} | {sid} | {len(recs)} | {max(recs)} | {int(med)} | {max(recs) / med:.1f} |")


if __name__ == "__main__":
    main()
