"""Reproduce the measurements quoted in the README.

Usage: python scripts/measure.py [events.parquet] [copies]
(default /root/testdata/sf0.1/events.parquet, 10 copies: ~1M rows)

1. Derives a larger input from ``events``: ``copies`` time-shifted copies,
   written once to a fresh scratch folder.
2. Times the main job (warm, best of 3) of the bucketed plan and of the raw
   join plan at a 2-day and a 30-day TTL, and what ``strategy="join"`` picks.
3. Skew: one user made to hold a third of all rows; compares the slowest and
   median reduce task (from Spark's event log, written to a scratch folder)
   with one bucket per TTL vs. the automatic per-key slicing.
"""

import contextlib
import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time
from datetime import timedelta

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from chronofeat import DataFrameSource, FeatureView, get_historical_features  # noqa: E402
from chronofeat.operators.asof import point_in_time_join  # noqa: E402
from chronofeat.plans.retrieval import prepare_view_source  # noqa: E402

DAY = 86_400 * 10**6


def session(event_log: str) -> SparkSession:
    s = (SparkSession.builder.master("local[8]").appName("chronofeat-measure")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "64")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    return s


def run(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def best(make, n=3) -> float:
    run(make())
    return min(run(make()) for _ in range(n))


def view(df, ttl_days):
    return FeatureView(name="a", entities=["user_id"], ttl=timedelta(days=ttl_days), schema=["f"],
                       source=DataFrameSource(df=df.where("event_type = 'view'"), timestamp_field="ts",
                                              field_mapping={"value": "f"}))


def task_spread(log_dir: str):
    """Per job group: (slowest, median) task of its heaviest reduce stage."""
    import zstandard
    files = [f for f in glob.glob(f"{log_dir}/**/*", recursive=True)
             if os.path.isfile(f) and not os.path.basename(f).startswith("appstatus")]
    path = sorted(files)[0]
    raw = open(path, "rb")
    text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8") \
        if path.endswith(".zstd") else io.TextIOWrapper(raw, encoding="utf-8")
    group, tasks = {}, {}
    for line in text:
        e = json.loads(line)
        if e.get("Event") == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                group[sid] = g
        elif e.get("Event") == "SparkListenerTaskEnd":
            ti = e["Task Info"]
            tasks.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
    out = {}
    for sid, ds in tasks.items():
        g = group.get(sid)
        if g and len(ds) >= 16 and max(ds) > out.get(g, (0, 0))[0]:
            out[g] = (max(ds), statistics.median(ds))
    return out


def main():
    src_path = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1/events.parquet"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    scratch = tempfile.mkdtemp(prefix="chronofeat-measure-")
    os.makedirs(os.path.join(scratch, "eventlog"), exist_ok=True)
    spark = session(os.path.join(scratch, "eventlog"))
    ev = spark.read.parquet(src_path)
    big = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("r")).select(
        (F.col("event_id") * copies + F.col("r")).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("r") * 37 + (F.col("event_id") % 1000) / 1000.0)).alias("ts"),
        "user_id", "event_type", "value")
    path = os.path.join(scratch, "events_big")
    big.write.parquet(path)
    big = spark.read.parquet(path)
    print(f"rows: {big.count()}  scratch: {scratch}")
    spine = big.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("event_timestamp"))

    print("| TTL | bucketed (w = TTL) | raw join plan | strategy='join' (checked) |")
    for days in (2, 30):
        v = view(big, days)
        src, _ = prepare_view_source(spark, v, ["f"], ["f"])
        gk = ["user_id", "event_timestamp"]
        b = best(lambda: point_in_time_join(spine, "event_timestamp", gk, src, ["user_id"], ["f"], days * DAY,
                                            bucket_width_us=days * DAY))
        j = best(lambda: point_in_time_join(spine, "event_timestamp", gk, src, ["user_id"], ["f"], days * DAY,
                                            strategy="join"))
        checked = get_historical_features(spine, [v], ["a:f"], strategy="join")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            checked.explain(mode="formatted")
        picked = "falls back to bucketed" if "Window" in buf.getvalue() else "join"
        print(f"| {days} days | {b:.2f} s | {j:.2f} s | {picked} |")

    # skew part: no partition coalescing, so each reduce task is visible
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    hot = big.withColumn("user_id", F.when(F.col("value") < 20, F.lit(0).cast("long")).otherwise(F.col("user_id")))
    hspine = hot.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("event_timestamp"))
    configs = [("one bucket per TTL", dict(bucket_width=None)),
               ("auto slicing, budget 20k rows", dict(max_bucket_rows=20_000)),
               ("auto, default budget", dict())]
    for label, kw in configs:                       # warm-up
        run(get_historical_features(hspine, [view(hot, 30)], ["a:f"], **kw))
    for label, kw in configs:
        times = []
        for i in range(3):
            spark.sparkContext.setJobGroup(label if i == 2 else "warm", label)
            t0 = time.perf_counter()
            run(get_historical_features(hspine, [view(hot, 30)], ["a:f"], **kw))   # incl. planning jobs
            times.append(time.perf_counter() - t0)
        print(f"{label}: {min(times):.2f} s (planning jobs included, best of 3)")
    spark.stop()
    for g, (mx, med) in task_spread(os.path.join(scratch, "eventlog")).items():
        if g != "warm":
            print(f"{g}: slowest reduce task {mx} ms, median {med:.0f} ms")


if __name__ == "__main__":
    main()
