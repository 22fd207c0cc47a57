"""The query catalog: one Spark query per operator, with its SQL oracle.

Every query reads the driver tables (``events``, ``orders``, ``customer``,
``lineitem``) in full.  ``events`` is the time-series table: purchases form
the spine (entity rows), other event types are feature sources.  ``orders``
is the snapshot source.  Each callable takes ``(spark, sf_dir)`` and returns
a lazy DataFrame, except that queries which write tables (snapshots, CSV,
persisted results) run those writes into fresh folders under
``spark.checkpoint.dir`` and return the table read back.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import Callable, Dict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.timecols import to_instant
from .model import (
    BucketedTableSource,
    CsvSource,
    DataFrameSource,
    FeatureView,
    OnDemandFeatureView,
    ParquetSource,
)
from .operators import frame as ops
from .plans import snapshot as mat
from .plans.bucket_snapshot import materialize_buckets
from .plans.retrieval import feature_projection, get_historical_features, prepare_entity_df
from .session import scratch_path
from .sources.readers import append_partitioned_by_day, read_csv_with_rejects, write_bucketed, write_table

# ---------------------------------------------------------------------------
# shared inputs


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def purchases(spark: SparkSession, d: str, ts_name: str = "event_timestamp") -> DataFrame:
    """Spine: one row per purchase, (user_id, event time)."""
    ev = table(spark, d, "events")
    return ev.where(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias(ts_name))


def events_of(spark: SparkSession, d: str, event_type: str) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.where(F.col("event_type") == event_type)


def with_created(df: DataFrame) -> DataFrame:
    """A write time for every row: the event time plus 0..6 days (by id)."""
    return df.withColumn("created", F.col("ts") + F.make_dt_interval(
        days=(F.col("event_id") % 7).cast("int")))


def activity_view(spark: SparkSession, d: str, event_type: str = "view", name: str = "act",
                  ttl=timedelta(days=2), feature: str = "f", created: bool = False) -> FeatureView:
    """Feature view over one event type; its ``value`` is exposed as
    ``feature`` through the source's field mapping."""
    src_df = events_of(spark, d, event_type)
    if created:
        src_df = with_created(src_df)
    return FeatureView(
        name=name, entities=["user_id"], ttl=ttl, schema=[feature],
        source=DataFrameSource(df=src_df, timestamp_field="ts",
                               created_timestamp_column="created" if created else None,
                               field_mapping={"value": feature}))


def orders_source(d: str) -> ParquetSource:
    return ParquetSource(path=f"{d}/orders.parquet", timestamp_field="o_orderdate")


def orders_view(d: str) -> FeatureView:
    return FeatureView(name="cust_orders", entities=["o_custkey"], ttl=None,
                       schema=["o_totalprice"], source=orders_source(d))


# ---------------------------------------------------------------------------
# point-in-time joins


def q_pit_ttl(spark, d, **kw):
    return get_historical_features(purchases(spark, d), [activity_view(spark, d)], ["act:f"], **kw)


def q_pit_join_strategy(spark, d):
    return q_pit_ttl(spark, d, strategy="join")


def q_pit_bucketed_subwidth(spark, d):
    return q_pit_ttl(spark, d, bucket_width=timedelta(hours=5))


def q_pit_keep_unmatched(spark, d):
    return q_pit_ttl(spark, d, keep_unmatched=True)


def q_pit_created(spark, d, **kw):
    v = activity_view(spark, d, ttl=timedelta(days=5), created=True)
    return get_historical_features(purchases(spark, d), [v], ["act:f"], **kw)


def q_pit_created_join_strategy(spark, d):
    return q_pit_created(spark, d, strategy="join")


def q_pit_created_subwidth(spark, d):
    return q_pit_created(spark, d, bucket_width=timedelta(hours=11))


def q_pit_union_strategy(spark, d):
    """The union-based plan in its plainest form: one (keys, bucket) shuffle
    with buckets as wide as the TTL, ranking by created then ts."""
    return q_pit_created(spark, d, strategy="bucketed", bucket_width=timedelta(days=5))


def q_pit_no_ttl(spark, d):
    v = activity_view(spark, d, ttl=None)
    return get_historical_features(purchases(spark, d), [v], ["act:f"])


def q_pit_no_ttl_null_ts(spark, d):
    """Signups with a value under 40 have no event time: without TTL they
    still count and rank lowest."""
    src = events_of(spark, d, "signup").withColumn("ts", F.when(F.col("value") >= 40, F.col("ts")))
    v = FeatureView(name="signups", entities=["user_id"], ttl=None, schema=["g"],
                    source=DataFrameSource(df=src, timestamp_field="ts", field_mapping={"value": "g"}))
    return get_historical_features(purchases(spark, d), [v], ["signups:g"])


def views_by_month(spark: SparkSession, d: str) -> ParquetSource:
    """The view events written partitioned by month (``'2024-01'``), read
    with that grain declared."""
    out = scratch_path(spark, "views-by-month")
    write_table(events_of(spark, d, "view").withColumn("month", F.date_format("ts", "yyyy-MM")), out,
                partition_by=["month"])
    return ParquetSource(path=out, timestamp_field="ts", field_mapping={"value": "f"},
                         date_partition_column="month", date_partition_grain="month")


def q_pit_month_partition(spark, d):
    v = FeatureView(name="act", entities=["user_id"], ttl=timedelta(days=2), schema=["f"],
                    source=views_by_month(spark, d))
    return get_historical_features(purchases(spark, d), [v], ["act:f"])


def q_pull_latest_month_partition(spark, d):
    return mat.pull_latest_from_table_or_query(
        views_by_month(spark, d), ["user_id"], ["value"], "ts", None,
        datetime(2024, 1, 15), datetime(2024, 1, 31), spark=spark)


def q_pit_multi_view(spark, d):
    v1 = activity_view(spark, d, "view", "act", feature="f")
    v2 = activity_view(spark, d, "click", "clk", feature="g")
    return get_historical_features(purchases(spark, d), [v1, v2], ["act:f", "clk:g"])


def q_pit_entityless(spark, d):
    src = events_of(spark, d, "signup")
    v = FeatureView(name="signups", entities=[], ttl=timedelta(days=2), schema=["g"],
                    source=DataFrameSource(df=src, timestamp_field="ts", field_mapping={"value": "g"}))
    return get_historical_features(purchases(spark, d), [v], ["signups:g"])


def q_pit_fused_views(spark, d):
    """Two views on the same key and TTL, one ranked by a created column:
    they share one as-of pass."""
    v1 = activity_view(spark, d, "view", "act", ttl=timedelta(days=2), feature="f")
    v2 = activity_view(spark, d, "click", "clk", ttl=timedelta(days=2), feature="g", created=True)
    return get_historical_features(purchases(spark, d), [v1, v2], ["act:f", "clk:g"])


def q_pit_entityless_no_ttl(spark, d):
    src = events_of(spark, d, "signup")
    v = FeatureView(name="signups", entities=[], ttl=None, schema=["g"],
                    source=DataFrameSource(df=src, timestamp_field="ts", field_mapping={"value": "g"}))
    return get_historical_features(purchases(spark, d), [v], ["signups:g"])


def hot_events(spark: SparkSession, d: str) -> DataFrame:
    """``events`` with one hot key: every event with value < 20 (a third of
    them) is attributed to user 0."""
    ev = table(spark, d, "events")
    return ev.withColumn("user_id", F.when(F.col("value") < 20, F.lit(0).cast("long"))
                         .otherwise(F.col("user_id")))


def q_pit_hot_key(spark, d):
    """User 0 holds a third of the spine and of the source; a small row
    budget per window partition makes the plan cut it into time slices."""
    ev = hot_events(spark, d)
    spine = ev.where(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias("event_timestamp"))
    v = FeatureView(name="act", entities=["user_id"], ttl=timedelta(days=2), schema=["f"],
                    source=DataFrameSource(df=ev.where(F.col("event_type") == "view"), timestamp_field="ts",
                                           field_mapping={"value": "f"}))
    return get_historical_features(spine, [v], ["act:f"], max_bucket_rows=50)


def q_pit_hot_key_int_source(spark, d):
    """The hot key again, with text keys in the source and long ones in the spine."""
    ev = hot_events(spark, d)
    spine = ev.where(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias("event_timestamp"))
    src = ev.where(F.col("event_type") == "view").withColumn("user_id", F.col("user_id").cast("string"))
    v = FeatureView(name="act", entities=["user_id"], ttl=timedelta(days=2), schema=["f"],
                    source=DataFrameSource(df=src, timestamp_field="ts", field_mapping={"value": "f"}))
    return get_historical_features(spine, [v], ["act:f"], max_bucket_rows=50)


def burst_events(spark: SparkSession, d: str) -> DataFrame:
    """:func:`hot_events` with user 0's events of a day inside its first
    millisecond, where halving time would leave them together."""
    start = F.date_trunc("day", "ts").cast("timestamp_ntz")
    burst = start + F.make_dt_interval(secs=F.col("event_id") % 1000 / F.lit(1_000_000).cast("decimal(18,6)"))
    return hot_events(spark, d).withColumn("ts", F.when(F.col("user_id") == 0, burst).otherwise(F.col("ts")))


def q_pit_burst_key(spark, d):
    ev = burst_events(spark, d)
    spine = ev.where(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias("event_timestamp"))
    v = FeatureView(name="act", entities=["user_id"], ttl=timedelta(days=2), schema=["f"],
                    source=DataFrameSource(df=ev.where(F.col("event_type") == "view"), timestamp_field="ts",
                                           field_mapping={"value": "f"}))
    return get_historical_features(spine, [v], ["act:f"], max_bucket_rows=50)


def few_customers(spark: SparkSession, d: str) -> DataFrame:
    """A spine of about one customer in a hundred: one segment of one nation."""
    nation = table(spark, d, "nation").where(F.col("n_name") == "NATION_19")
    return table(spark, d, "customer").where(F.col("c_mktsegment") == "FURNITURE") \
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .select(F.col("c_custkey").alias("o_custkey"), F.expr("timestamp_ntz'2000-01-01'").alias("event_timestamp"))


def q_pit_key_pruned(spark, d):
    """The orders of all other customers go in the scan's stage, by a Bloom filter of the spine's keys."""
    v = FeatureView(name="o", entities=["o_custkey"], ttl=timedelta(days=365), schema=["o_totalprice"],
                    source=orders_source(d))
    return get_historical_features(few_customers(spark, d), [v], ["o:o_totalprice"])


def bucketed_view(spark: SparkSession, d: str, name: str, event_type: str, feature: str) -> FeatureView:
    """A view over events of one type in a table bucketed by user and sorted by time."""
    path = scratch_path(spark, f"bucketed-{event_type}")
    source_table = f"chronofeat_{event_type}_{path[-12:]}"
    write_bucketed(events_of(spark, d, event_type), source_table, ["user_id"], "ts", 8, path)
    return FeatureView(name=name, entities=["user_id"], ttl=timedelta(days=2), schema=[feature],
                       source=BucketedTableSource(table=source_table, timestamp_field="ts", field_mapping={"value": feature}))


def q_pit_bucketed_source(spark, d):
    """Two bucketed sources in one pass: only spine rows are shuffled."""
    views = [bucketed_view(spark, d, "act", "view", "f"), bucketed_view(spark, d, "clk", "click", "g")]
    return get_historical_features(purchases(spark, d), views, ["act:f", "clk:g"])


def q_pull_latest_date_col(spark, d):
    """Orders with a date and with a text time column: bounds in the column's own type reach the scan."""
    out = None
    for kind, iso in (("date", None), ("string", "iso")):
        path = scratch_path(spark, f"orders-{kind}")
        table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date").cast(kind)) \
            .repartitionByRange(4, "o_orderdate").sortWithinPartitions("o_orderdate").write.parquet(path)
        src = ParquetSource(path=path, timestamp_field="o_orderdate", timestamp_text=iso)
        one = mat.pull_latest_from_table_or_query(src, ["o_custkey"], ["o_totalprice"], "o_orderdate", None,
                                                  datetime(1996, 1, 1), datetime(1997, 6, 1), spark=spark)
        one = one.select("o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice",
                         F.lit(kind).alias("kind"))
        out = one if out is None else out.unionByName(one)
    return out


def q_scan_csv_rejects(spark, d):
    """Events as CSV in which errors have a value that is no number and
    signups one field too many: good rows by type, rejected ones by reason."""
    path = scratch_path(spark, "events-damaged")
    ev = table(spark, d, "events")
    value = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    line = F.concat_ws(";", "event_id", "event_type", value, F.when(F.col("event_type") == "signup", "more"))
    ev.select(line).write.text(path)
    src = CsvSource(path=path, timestamp_field="", delimiter=";", header=False,
                    schema="event_id long, event_type string, value double")
    good, rejected = read_csv_with_rejects(spark, src)
    return good.groupBy(F.col("event_type").alias("what")).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")) \
        .unionByName(rejected.groupBy(F.col("reason").alias("what")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.split("row", ";")[0].cast("long")).alias("ids")))


def copies_spine(spark: SparkSession, d: str) -> DataFrame:
    """Purchases at the start of their day; users with a purchase under 20
    count as user 0 of the coarser role, so its points are copied."""
    return hot_events(spark, d).where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase"), F.col("user_id").alias("member"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("event_timestamp"))


def q_pit_hot_copies_second_view(spark, d):
    """The first view's keys are unique, the second's are copied many times."""
    own = events_of(spark, d, "purchase").select(F.col("event_id").alias("purchase"), "ts", F.col("value").alias("p"))
    v1 = FeatureView(name="own", entities=["purchase"], ttl=None, schema=["p"],
                     source=DataFrameSource(df=own, timestamp_field="ts"))
    ev = hot_events(spark, d).where(F.col("event_type") == "view")
    v2 = FeatureView(name="act", entities=["member"], ttl=timedelta(days=2), schema=["f"],
                     source=DataFrameSource(df=ev, timestamp_field="ts", field_mapping={"value": "f", "user_id": "member"}))
    return get_historical_features(copies_spine(spark, d), [v1, v2], ["own:p", "act:f"], max_bucket_rows=5)


def role_spine(spark: SparkSession, d: str) -> DataFrame:
    """Purchases with two roles: the buyer, and a referrer: the user id named
    in the event's properties."""
    ev = events_of(spark, d, "purchase")
    return ev.select(F.col("user_id").alias("buyer"),
                     F.get_json_object("props", "$.k").cast("long").alias("referrer"),
                     F.col("ts").alias("event_timestamp"))


def q_pit_three_entities_subwidth(spark, d):
    """Buyer, referrer and hour of the day as entities, in buckets narrower
    than the TTL: three passes that meet in one final aggregate."""
    spine = role_spine(spark, d).withColumn("hour", F.hour("event_timestamp").cast("long"))
    clicks = events_of(spark, d, "click").withColumn("hour", F.hour("ts").cast("long"))
    views = [activity_view(spark, d, name="b", ttl=timedelta(days=5), feature="f").with_join_key_map({"user_id": "buyer"}),
             activity_view(spark, d, name="r", event_type="signup", ttl=timedelta(days=5), feature="g")
             .with_join_key_map({"user_id": "referrer"}),
             FeatureView(name="h", entities=["hour"], ttl=timedelta(days=1), schema=["k"],
                         source=DataFrameSource(df=clicks, timestamp_field="ts", field_mapping={"value": "k"}))]
    return get_historical_features(spine, views, ["b:f", "r:g", "h:k"], bucket_width=timedelta(hours=7))


def q_pit_role_twice(spark, d):
    v = activity_view(spark, d, ttl=timedelta(days=5), feature="value")
    buyer = v.with_name("b").with_join_key_map({"user_id": "buyer"})
    referrer = v.with_name("r").with_join_key_map({"user_id": "referrer"})
    return get_historical_features(role_spine(spark, d), [buyer, referrer],
                                   ["b:value", "r:value"], full_feature_names=True)


def q_ts_name_collision(spark, d):
    # spine time column and source time column are both called ``ts``
    return get_historical_features(purchases(spark, d, ts_name="ts"), [activity_view(spark, d)],
                                   ["act:f"])


def q_detect_ts_col(spark, d):
    ev = events_of(spark, d, "purchase")
    spine = ev.select("event_id", "user_id", F.col("ts").alias("purchase_time"))
    return get_historical_features(spine, [activity_view(spark, d)], ["act:f"])


def q_pit_mixed_sources(spark, d):
    """View 1 from CSV files, view 2 from Parquet files."""
    csv_dir = scratch_path(spark, "views-csv")
    write_table(events_of(spark, d, "view").select("event_id", "ts", "user_id", "value"),
                csv_dir, fmt="csv", mode="errorifexists", sep=";", header="true")
    pq_dir = scratch_path(spark, "clicks-parquet")
    write_table(events_of(spark, d, "click").select("user_id", "ts", "value"), pq_dir,
                mode="errorifexists")
    v1 = FeatureView(name="act", entities=["user_id"], ttl=timedelta(days=2), schema=["f"],
                     source=CsvSource(path=csv_dir, timestamp_field="ts", delimiter=";", header=True,
                                      schema="event_id long, ts timestamp_ntz, user_id long, value double",
                                      field_mapping={"value": "f"}))
    v2 = FeatureView(name="clk", entities=["user_id"], ttl=timedelta(days=2), schema=["g"],
                     source=ParquetSource(path=pq_dir, timestamp_field="ts", field_mapping={"value": "g"}))
    return get_historical_features(purchases(spark, d), [v1, v2], ["act:f", "clk:g"])


def q_on_demand(spark, d):
    od = OnDemandFeatureView(name="derived", transform=lambda df: df.withColumn("f2", F.col("f") * 2))
    return get_historical_features(purchases(spark, d), [activity_view(spark, d)],
                                   ["act:f", "derived:f2"], on_demand_feature_views=[od])


def q_on_demand_inputs(spark, d):
    """Only the derived feature is asked for; its input comes with it."""
    od = OnDemandFeatureView(name="derived", features=("act:f",),
                             transform=lambda df: df.withColumn("f2", F.col("f") * 2))
    return get_historical_features(purchases(spark, d), [activity_view(spark, d)], ["derived:f2"],
                                   on_demand_feature_views=[od])


def q_on_demand_pandas(spark, d):
    # a local function is pickled by value: Python workers need no import of
    # this package to run it
    def double_f(pdf):
        return pdf.assign(f2=pdf["f"] * 2)

    od = OnDemandFeatureView(name="derived", transform=double_f, pandas=True,
                             output_schema="f2 double")
    return get_historical_features(purchases(spark, d), [activity_view(spark, d)],
                                   ["act:f", "derived:f2"], on_demand_feature_views=[od])


def q_persist_roundtrip(spark, d):
    return mat.persist(q_pit_ttl(spark, d))


# ---------------------------------------------------------------------------
# extraction and materialization


def q_pull_latest(spark, d):
    return mat.pull_latest_from_table_or_query(
        orders_source(d), ["o_custkey"], ["o_totalprice"], "o_orderdate", None,
        datetime(1996, 1, 1), datetime(1999, 1, 1), spark=spark)


def q_pull_latest_created(spark, d):
    src = DataFrameSource(df=with_created(table(spark, d, "events")), timestamp_field="ts",
                          created_timestamp_column="created")
    return mat.pull_latest_from_table_or_query(
        src, ["user_id"], ["value"], "ts", "created",
        datetime(2024, 1, 5), datetime(2024, 1, 20), spark=spark)


def q_pull_latest_entityless(spark, d):
    src = DataFrameSource(df=events_of(spark, d, "signup"), timestamp_field="ts")
    return mat.pull_latest_from_table_or_query(
        src, [], ["value"], "ts", None, datetime(2024, 1, 5), datetime(2024, 1, 20), spark=spark)


def q_pull_all(spark, d):
    return mat.pull_all_from_table_or_query(
        orders_source(d), ["o_custkey"], ["o_totalprice"], "o_orderdate",
        datetime(1996, 1, 1), datetime(1999, 1, 1), spark=spark)


def q_materialize_merge(spark, d):
    v = orders_view(d)
    first = mat.materialize(v, datetime(1995, 1, 1), datetime(1997, 1, 1), spark=spark)
    second = mat.materialize(v, datetime(1997, 1, 1), datetime(2000, 1, 1), previous=first, spark=spark)
    return spark.read.parquet(second).select("o_custkey", "o_orderdate", "o_totalprice")


def orders_by_buckets(spark: SparkSession, d: str, num_buckets: int):
    """The orders view in a bucketed snapshot: everything before 1999 first, later orders merged in by year."""
    v = FeatureView(name="cust_orders", entities=["o_custkey"], ttl=None, schema=["o_totalprice"], source=orders_source(d))
    root = scratch_path(spark, "orders-buckets")
    for lo, hi in ((1990, 1999), (1999, 2000), (2000, 2010)):
        snapshot = materialize_buckets(v, datetime(lo, 1, 1), datetime(hi, 1, 1), root, num_buckets, spark=spark)
    return snapshot


def q_materialize_bucket_merge(spark, d):
    return orders_by_buckets(spark, d, 16).read().select("o_custkey", "o_orderdate", "o_totalprice")


def q_snapshot_lookup_few(spark, d):
    """Few keys: only the files of their buckets are opened."""
    keys = few_customers(spark, d).select("o_custkey")
    return orders_by_buckets(spark, d, 64).lookup(keys, ["o_orderdate", "o_totalprice"])


def q_snapshot_lookup(spark, d):
    v = orders_view(d)
    snap = spark.read.parquet(mat.materialize(v, datetime(1900, 1, 1), datetime(1996, 1, 1), spark=spark))
    keys = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    out = mat.get_online_features(snap, keys, ["o_custkey"], ["o_totalprice"])
    return out.select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")


def q_stream_materialize(spark, d):
    from .streaming.incremental import incremental_materialize, read_snapshot
    landing = scratch_path(spark, "orders-landing")
    orders = table(spark, d, "orders")
    # two landings: the stream picks both up as micro-batches
    cut = F.col("o_orderdate") < F.expr("TIMESTAMP_NTZ'1998-01-01 00:00:00'")
    write_table(orders.where(cut), landing, mode="append")
    write_table(orders.where(~cut | F.col("o_orderdate").isNull()), landing, mode="append")
    v = FeatureView(name="cust_orders", entities=["o_custkey"], ttl=None, schema=["o_totalprice"],
                    source=ParquetSource(path=landing, timestamp_field="o_orderdate"))
    snap = scratch_path(spark, "orders-stream-snapshot")
    q = incremental_materialize(spark, v, snap)
    q.awaitTermination()
    return read_snapshot(spark, v, snap).select("o_custkey", "o_orderdate", "o_totalprice")


# ---------------------------------------------------------------------------
# frame operators


def q_latest_per_key(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice")
    return ops.drop_df_duplicates(li, ["l_orderkey"], "l_shipdate")


def q_dedup_keep_last(spark, d):
    ev = table(spark, d, "events").select("user_id", "event_type", "event_id")
    return ops.drop_duplicates_keep_last(ev, ["user_id", "event_type"], ["event_id"])


def q_filter_ttl(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = li.join(o, "l_orderkey")          # foreign-key join: one order per line
    return ops.filter_ttl(j, "l_shipdate", "o_orderdate", timedelta(days=60)) \
        .select("l_orderkey", "l_linenumber")


def q_filter_range(spark, d):
    ev = table(spark, d, "events").select("event_id", "ts")
    return ops.filter_time_range(ev, "ts", datetime(2024, 1, 5), datetime(2024, 1, 20))


def q_join_left(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return ops.join_left(c, o, ["c_custkey"])


def q_join_left_salted(spark, d):
    """Same join with right-side keys over 8 orders salted."""
    c = table(spark, d, "customer").select("c_custkey")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return ops.join_left(c, o, ["c_custkey"], max_rows_per_key=8)


def q_event_time_range(spark, d):
    return ops.event_timestamp_range(table(spark, d, "events"), "ts")


def q_sort_rank(spark, d):
    ev = table(spark, d, "events").select("event_id", "value")
    order = ops.sort_columns(["value", "event_id"], [True, True], na_position="first")
    # na_position applies to every column; event_id has no NULLs
    return ops.with_sort_position(ev, order, "pos").select("event_id", "pos")


def q_sort_rank_payload(spark, d):
    ev = table(spark, d, "events").select("event_id", "value", "event_type", "props")
    return ops.sort_positions(ev, ["value", "event_id"], na_position="first")


def q_rename_cols(spark, d):
    ev = table(spark, d, "events").select("user_id", "event_id", "value")
    return ops.rename_columns(ev, {"user_id": "event_id", "event_id": "user_id"})


def q_feature_projection(spark, d):
    src = DataFrameSource(df=table(spark, d, "events"), timestamp_field="ts")
    v = FeatureView(name="act", entities=["user_id"], ttl=timedelta(days=1),
                    schema=["value", "event_type"], source=src)
    return feature_projection(v, ["value", "event_type"], full_feature_names=True, spark=spark)


def q_select_cols(spark, d):
    return ops.select_columns(table(spark, d, "events"), ["event_id", "user_id", "value"])


def q_drop_cols(spark, d):
    return ops.drop_columns(table(spark, d, "events"), ["props", "event_type"])


def q_add_static(spark, d):
    ev = table(spark, d, "events").select("event_id")
    return ops.add_static_column(ev, "tag", "x")


def q_prepare_entity(spark, d):
    spine = prepare_entity_df(purchases(spark, d))
    ts = ops.detect_event_timestamp_column(spine)
    return spine.select("user_id", ts)


def q_normalize_ts(spark, d):
    ev = table(spark, d, "events")
    inst = to_instant("ts", ev.schema["ts"].dataType)
    return ev.select("event_id", F.unix_micros(inst).alias("ts_us"))


def q_scan_parquet(spark, d):
    from .sources.readers import read_source
    return read_source(spark, ParquetSource(path=f"{d}/events.parquet", timestamp_field="ts"))


def q_scan_csv(spark, d):
    from .sources.readers import read_source
    out = scratch_path(spark, "events-csv")
    cols = ["event_id", "ts", "user_id", "event_type", "value"]
    write_table(table(spark, d, "events").select(*cols), out, fmt="csv", mode="errorifexists",
                sep=";", header="false")
    src = CsvSource(path=out, timestamp_field="ts", delimiter=";", header=False,
                    schema="event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    return read_source(spark, src)


def q_scan_csv_strings(spark, d):
    """No schema: text columns, only the event time is parsed; ``props``
    needs quoting."""
    from .sources.readers import read_source
    out = scratch_path(spark, "events-csv-text")
    write_table(table(spark, d, "events"), out, fmt="csv", mode="errorifexists", header="true", escape='"')
    raw = read_source(spark, CsvSource(path=out, timestamp_field="ts", escape='"'))
    return raw.select(F.col("event_id").cast("long").alias("event_id"), "ts",
                      F.col("user_id").cast("long").alias("user_id"), "event_type",
                      F.col("value").cast("double").alias("value"), "props")


def q_append_partitioned(spark, d):
    out = scratch_path(spark, "events-by-day")
    ev = table(spark, d, "events").select("event_id", "ts", "user_id", "value")
    cut = F.col("ts") < F.expr("TIMESTAMP_NTZ'2024-01-15 00:00:00'")
    append_partitioned_by_day(ev.where(cut), out, "ts")
    append_partitioned_by_day(ev.where(~cut | F.col("ts").isNull()), out, "ts")
    return spark.read.parquet(out)


# ---------------------------------------------------------------------------

QUERIES: Dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pit_ttl": q_pit_ttl,
    "pit_join_strategy": q_pit_join_strategy,
    "pit_bucketed_subwidth": q_pit_bucketed_subwidth,
    "pit_keep_unmatched": q_pit_keep_unmatched,
    "pit_created": q_pit_created,
    "pit_created_join_strategy": q_pit_created_join_strategy,
    "pit_created_subwidth": q_pit_created_subwidth,
    "pit_union_strategy": q_pit_union_strategy,
    "pit_no_ttl": q_pit_no_ttl,
    "pit_no_ttl_null_ts": q_pit_no_ttl_null_ts,
    "pit_month_partition": q_pit_month_partition,
    "pit_multi_view": q_pit_multi_view,
    "pit_entityless": q_pit_entityless,
    "pit_entityless_no_ttl": q_pit_entityless_no_ttl,
    "pit_fused_views": q_pit_fused_views,
    "pit_hot_key": q_pit_hot_key,
    "pit_burst_key": q_pit_burst_key,
    "pit_three_entities_subwidth": q_pit_three_entities_subwidth,
    "pit_key_pruned": q_pit_key_pruned,
    "pit_bucketed_source": q_pit_bucketed_source,
    "pull_latest_date_col": q_pull_latest_date_col,
    "scan_csv_rejects": q_scan_csv_rejects,
    "pit_hot_key_int_source": q_pit_hot_key_int_source,
    "pit_hot_copies_second_view": q_pit_hot_copies_second_view,
    "pit_role_twice": q_pit_role_twice,
    "pit_mixed_sources": q_pit_mixed_sources,
    "ts_name_collision": q_ts_name_collision,
    "detect_ts_col": q_detect_ts_col,
    "on_demand": q_on_demand,
    "on_demand_inputs": q_on_demand_inputs,
    "on_demand_pandas": q_on_demand_pandas,
    "persist_roundtrip": q_persist_roundtrip,
    "pull_latest": q_pull_latest,
    "pull_latest_created": q_pull_latest_created,
    "pull_latest_month_partition": q_pull_latest_month_partition,
    "pull_latest_entityless": q_pull_latest_entityless,
    "pull_all": q_pull_all,
    "materialize_merge": q_materialize_merge,
    "snapshot_lookup": q_snapshot_lookup,
    "materialize_bucket_merge": q_materialize_bucket_merge,
    "snapshot_lookup_few": q_snapshot_lookup_few,
    "stream_materialize": q_stream_materialize,
    "latest_per_key": q_latest_per_key,
    "dedup_keep_last": q_dedup_keep_last,
    "filter_ttl": q_filter_ttl,
    "filter_range": q_filter_range,
    "join_left": q_join_left,
    "join_left_salted": q_join_left_salted,
    "event_time_range": q_event_time_range,
    "sort_rank": q_sort_rank,
    "sort_rank_payload": q_sort_rank_payload,
    "rename_cols": q_rename_cols,
    "feature_projection": q_feature_projection,
    "select_cols": q_select_cols,
    "drop_cols": q_drop_cols,
    "add_static": q_add_static,
    "prepare_entity": q_prepare_entity,
    "normalize_ts": q_normalize_ts,
    "scan_parquet": q_scan_parquet,
    "scan_csv": q_scan_csv,
    "scan_csv_strings": q_scan_csv_strings,
    "append_partitioned": q_append_partitioned,
}


# ---------------------------------------------------------------------------
# DuckDB oracles (same column names as the Spark queries)

_PIT_TTL = (
    "select user_id, event_timestamp, f from (select e.user_id, e.ts event_timestamp, v.value f, "
    "row_number() over (partition by e.user_id, e.ts order by v.ts desc nulls last, v.value desc nulls last) rn "
    "from events e join events v on e.user_id = v.user_id and v.event_type = 'view' and v.ts <= e.ts "
    "and v.ts >= e.ts - interval 2 day where e.event_type = 'purchase') where rn = 1")

_PIT_CREATED = (
    "select user_id, event_timestamp, f from (select e.user_id, e.ts event_timestamp, v.value f, "
    "row_number() over (partition by e.user_id, e.ts order by v.ts + to_days(cast(v.event_id % 7 as int)) "
    "desc nulls last, v.ts desc nulls last, v.value desc nulls last) rn from events e join events v "
    "on e.user_id = v.user_id and v.event_type = 'view' and v.ts <= e.ts and v.ts >= e.ts - interval 5 day "
    "where e.event_type = 'purchase') where rn = 1")

_PIT_MULTI = (
    "with a as (" + _PIT_TTL + ") select user_id, event_timestamp, f, g from (select a.*, v.value g, "
    "row_number() over (partition by a.user_id, a.event_timestamp order by v.ts desc, v.value desc) rn "
    "from a join events v on a.user_id = v.user_id and v.event_type = 'click' and v.ts <= event_timestamp "
    "and v.ts >= event_timestamp - interval 2 day) where rn = 1")

_LATEST_ORDERS = (
    "select o_custkey, o_orderdate, o_totalprice from (select *, row_number() over (partition by o_custkey "
    "order by o_orderdate desc nulls last, o_totalprice desc nulls last) rn from orders where {cond}) where rn = 1")

ORACLES: Dict[str, str] = {
    "pit_ttl": _PIT_TTL,
    "pit_join_strategy": _PIT_TTL,
    "pit_bucketed_subwidth": _PIT_TTL,
    "pit_keep_unmatched": (
        "select user_id, event_timestamp, f from (select e.user_id, e.ts event_timestamp, v.value f, "
        "row_number() over (partition by e.user_id, e.ts order by v.ts desc nulls last, v.value desc nulls last) rn "
        "from events e left join events v on e.user_id = v.user_id and v.event_type = 'view' and v.ts <= e.ts "
        "and v.ts >= e.ts - interval 2 day where e.event_type = 'purchase') where rn = 1"),
    "pit_created": _PIT_CREATED,
    "pit_created_join_strategy": _PIT_CREATED,
    "pit_created_subwidth": _PIT_CREATED,
    "pit_union_strategy": _PIT_CREATED,
    "pit_no_ttl": (
        "select user_id, event_timestamp, f from (select e.user_id, e.ts event_timestamp, v.value f, "
        "row_number() over (partition by e.user_id, e.ts order by v.ts desc nulls last, v.value desc nulls last) rn "
        "from events e left join events v on e.user_id = v.user_id and v.event_type = 'view' "
        "where e.event_type = 'purchase') where rn = 1"),
    "pit_multi_view": _PIT_MULTI,
    "pit_entityless": (
        "with e as (select user_id, ts event_timestamp from events where event_type = 'purchase') "
        "select user_id, event_timestamp, g from (select e.*, v.value g, row_number() over (partition by "
        "e.user_id, e.event_timestamp order by v.ts desc, v.value desc) rn from e join events v on "
        "v.event_type = 'signup' and v.ts <= event_timestamp and v.ts >= event_timestamp - interval 2 day) "
        "where rn = 1"),
    "pit_entityless_no_ttl": (
        "select e.user_id, e.ts as event_timestamp, l.g from events e cross join (select value as g "
        "from events where event_type = 'signup' order by ts desc nulls last, value desc nulls last limit 1) l "
        "where e.event_type = 'purchase'"),
    "pit_fused_views": (
        "with a as (" + _PIT_TTL + ") select user_id, event_timestamp, f, g from (select a.*, v.value g, "
        "row_number() over (partition by a.user_id, a.event_timestamp order by "
        "v.ts + to_days(cast(v.event_id % 7 as int)) desc, v.ts desc, v.value desc) rn "
        "from a join events v on a.user_id = v.user_id and v.event_type = 'click' and v.ts <= event_timestamp "
        "and v.ts >= event_timestamp - interval 2 day) where rn = 1"),
    "pit_hot_key": (
        "with ev as (select event_id, ts, case when value < 20 then 0 else user_id end as user_id, "
        "event_type, value from events) "
        "select user_id, event_timestamp, f from (select e.user_id, e.ts event_timestamp, v.value f, "
        "row_number() over (partition by e.user_id, e.ts order by v.ts desc, v.value desc) rn "
        "from ev e join ev v on e.user_id = v.user_id and v.event_type = 'view' and v.ts <= e.ts "
        "and v.ts >= e.ts - interval 2 day where e.event_type = 'purchase') where rn = 1"),
    "pit_three_entities_subwidth": (
        "with sp as (select distinct user_id as buyer, cast(json_extract_string(props, '$.k') as bigint) as referrer, "
        "ts as event_timestamp, cast(extract(hour from ts) as bigint) as hour from events where event_type = 'purchase'), "
        "b as (select sp.*, v.value f, row_number() over (partition by buyer, referrer, hour, event_timestamp "
        "order by v.ts desc, v.value desc) rn from sp join events v on v.user_id = buyer and v.event_type = 'view' "
        "and v.ts <= event_timestamp and v.ts >= event_timestamp - interval 5 day), "
        "r as (select b.* exclude (rn), v.value g, row_number() over (partition by buyer, referrer, hour, event_timestamp "
        "order by v.ts desc, v.value desc) rn from b join events v on v.user_id = referrer and v.event_type = 'signup' "
        "and v.ts <= event_timestamp and v.ts >= event_timestamp - interval 5 day where b.rn = 1), "
        "h as (select r.* exclude (rn), v.value k, row_number() over (partition by buyer, referrer, hour, event_timestamp "
        "order by v.ts desc, v.value desc) rn from r join events v on extract(hour from v.ts) = r.hour and v.event_type = 'click' "
        "and v.ts <= event_timestamp and v.ts >= event_timestamp - interval 1 day where r.rn = 1) "
        "select buyer, referrer, event_timestamp, hour, f, g, k from h where rn = 1"),
    "pit_burst_key": (
        "with ev as (select event_id, case when value < 20 or user_id = 0 then date_trunc('day', ts) + "
        "to_microseconds(event_id % 1000) else ts end as ts, "
        "case when value < 20 then 0 else user_id end as user_id, event_type, value from events) "
        "select user_id, event_timestamp, f from (select e.user_id, e.ts event_timestamp, v.value f, "
        "row_number() over (partition by e.user_id, e.ts order by v.ts desc, v.value desc) rn "
        "from ev e join ev v on e.user_id = v.user_id and v.event_type = 'view' and v.ts <= e.ts "
        "and v.ts >= e.ts - interval 2 day where e.event_type = 'purchase') where rn = 1"),
    "pit_bucketed_source": _PIT_MULTI,
    "pull_latest_date_col": (
        "select o_custkey, o_orderdate, o_totalprice, kind from (select o_custkey, cast(o_orderdate as date) o_orderdate, "
        "o_totalprice, row_number() over (partition by o_custkey order by cast(o_orderdate as date) desc, o_totalprice desc) rn "
        "from orders where o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1997-06-01') "
        "cross join (values ('date'), ('string')) k(kind) where rn = 1"),
    "scan_csv_rejects": (
        "select case event_type when 'error' then 'value is no double' when 'signup' then 'too many fields' "
        "else event_type end as what, count(*) as n, cast(sum(event_id) as bigint) as ids from events group by 1"),
    "pit_key_pruned": (
        "select o_custkey, event_timestamp, o_totalprice from (select o_custkey, timestamp '2000-01-01' event_timestamp, "
        "o_totalprice, row_number() over (partition by o_custkey order by o_orderdate desc, o_totalprice desc) rn "
        "from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey "
        "where c_mktsegment = 'FURNITURE' and n_name = 'NATION_19' and o_orderdate <= timestamp '2000-01-01' "
        "and o_orderdate >= timestamp '2000-01-01' - interval 365 day) where rn = 1"),
    "pit_hot_copies_second_view": (
        "with ev as (select event_id, ts, case when value < 20 then 0 else user_id end as member, "
        "event_type, value from events), "
        "sp as (select event_id purchase, member, date_trunc('day', ts) event_timestamp, value p from ev "
        "where event_type = 'purchase') "
        "select purchase, member, event_timestamp, p, f from (select sp.*, v.value f, row_number() over "
        "(partition by purchase order by v.ts desc, v.value desc) rn from sp join ev v on sp.member = v.member "
        "and v.event_type = 'view' and v.ts <= sp.event_timestamp and v.ts >= sp.event_timestamp - interval 2 day) "
        "where rn = 1"),
    "pit_no_ttl_null_ts": (
        "select p.user_id, p.event_timestamp, s.g from (select distinct user_id, ts event_timestamp from events "
        "where event_type = 'purchase') p left join (select user_id, value g from (select user_id, value, "
        "row_number() over (partition by user_id order by case when value >= 40 then ts end desc nulls last, "
        "value desc nulls last) rn from events where event_type = 'signup') where rn = 1) s "
        "on p.user_id = s.user_id"),
    "pit_month_partition": _PIT_TTL,
    "pull_latest_month_partition": (
        "select user_id, ts, value from (select user_id, ts, value, row_number() over (partition by user_id "
        "order by ts desc, value desc nulls last) rn from events where event_type = 'view' and "
        "ts >= timestamp '2024-01-15' and ts < timestamp '2024-01-31') where rn = 1"),
    "on_demand_inputs": "select user_id, event_timestamp, f, f * 2 as f2 from (" + _PIT_TTL + ")",
    "sort_rank_payload": (
        "select event_id, value, event_type, props, row_number() over (order by value asc nulls first, "
        "event_id asc) pos from events"),
    "scan_csv_strings": "select event_id, ts, user_id, event_type, value, props from events",
    "pit_role_twice": (
        "with e as (select user_id buyer, cast(json_extract_string(props, '$.k') as bigint) referrer, "
        "ts event_timestamp from events where event_type = 'purchase'), "
        "b as (select buyer, referrer, event_timestamp, b__value from (select e.*, v.value b__value, "
        "row_number() over (partition by buyer, referrer, event_timestamp order by v.ts desc, v.value desc) rn "
        "from e join events v on v.user_id = buyer and v.event_type = 'view' and v.ts <= event_timestamp "
        "and v.ts >= event_timestamp - interval 5 day) where rn = 1) "
        "select buyer, referrer, event_timestamp, b__value, r__value from (select b.*, v.value r__value, "
        "row_number() over (partition by buyer, referrer, event_timestamp order by v.ts desc, v.value desc) rn "
        "from b join events v on v.user_id = referrer and v.event_type = 'view' and v.ts <= event_timestamp "
        "and v.ts >= event_timestamp - interval 5 day) where rn = 1"),
    "pit_mixed_sources": _PIT_MULTI,
    "ts_name_collision": "select user_id, event_timestamp as ts, f from (" + _PIT_TTL + ")",
    "detect_ts_col": (
        "select event_id, user_id, purchase_time, f from (select e.event_id, e.user_id, e.ts purchase_time, "
        "v.value f, row_number() over (partition by e.user_id, e.ts order by v.ts desc, v.value desc) rn "
        "from events e join events v on e.user_id = v.user_id and v.event_type = 'view' and v.ts <= e.ts "
        "and v.ts >= e.ts - interval 2 day where e.event_type = 'purchase') where rn = 1"),
    "on_demand": "select user_id, event_timestamp, f, f * 2 as f2 from (" + _PIT_TTL + ")",
    "on_demand_pandas": "select user_id, event_timestamp, f, f * 2 as f2 from (" + _PIT_TTL + ")",
    "persist_roundtrip": _PIT_TTL,
    "pull_latest": _LATEST_ORDERS.format(
        cond="o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1999-01-01'"),
    "pull_latest_created": (
        "select user_id, ts, created, value from (select user_id, ts, ts + to_days(cast(event_id % 7 as int)) "
        "created, value, row_number() over (partition by user_id order by ts + to_days(cast(event_id % 7 as int)) "
        "desc, ts desc, value desc) rn from events where ts >= timestamp '2024-01-05' and ts < "
        "timestamp '2024-01-20') where rn = 1"),
    "pull_latest_entityless": (
        "select '' as \"__dummy_id\", ts, value from events where event_type = 'signup' "
        "and ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20'"),
    "pull_all": (
        "select o_custkey, o_orderdate, o_totalprice from (select *, row_number() over (partition by o_custkey, "
        "o_orderdate order by o_totalprice desc nulls last) rn from orders where o_orderdate >= "
        "timestamp '1996-01-01' and o_orderdate < timestamp '1999-01-01') where rn = 1"),
    "materialize_merge": _LATEST_ORDERS.format(
        cond="o_orderdate >= timestamp '1995-01-01' and o_orderdate < timestamp '2000-01-01'"),
    "materialize_bucket_merge": _LATEST_ORDERS.format(cond="o_orderdate < timestamp '2010-01-01'"),
    "snapshot_lookup_few": (
        "select c_custkey as o_custkey, o_orderdate, o_totalprice from customer join nation on c_nationkey = n_nationkey "
        "left join (" + _LATEST_ORDERS.format(cond="o_orderdate < timestamp '2010-01-01'") + ") on o_custkey = c_custkey "
        "where c_mktsegment = 'FURNITURE' and n_name = 'NATION_19'"),
    "snapshot_lookup": (
        "select c.c_custkey, o.o_totalprice from customer c left join (" + _LATEST_ORDERS.format(
            cond="o_orderdate >= timestamp '1900-01-01' and o_orderdate < timestamp '1996-01-01'")
        + ") o on c.c_custkey = o.o_custkey"),
    "stream_materialize": _LATEST_ORDERS.format(cond="true"),
    "latest_per_key": (
        "select l_orderkey, l_shipdate, l_extendedprice from (select *, row_number() over (partition by "
        "l_orderkey order by l_shipdate desc nulls last, l_extendedprice desc nulls last) rn from lineitem) "
        "where rn = 1"),
    "dedup_keep_last": (
        "select user_id, event_type, event_id from (select *, row_number() over (partition by user_id, "
        "event_type order by event_id desc) rn from events) where rn = 1"),
    "filter_ttl": (
        "select l.l_orderkey, l.l_linenumber from lineitem l join orders o on l.l_orderkey = o.o_orderkey "
        "where o.o_orderdate <= l.l_shipdate and o.o_orderdate >= l.l_shipdate - interval 60 day"),
    "filter_range": (
        "select event_id, ts from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20'"),
    "join_left": "select c.c_custkey, o.o_orderkey from customer c left join orders o on c.c_custkey = o.o_custkey",
    "join_left_salted": (
        "select c.c_custkey, o.o_orderkey from customer c left join orders o on c.c_custkey = o.o_custkey"),
    "event_time_range": "select min(ts) min_ts, max(ts) max_ts from events",
    "sort_rank": (
        "select event_id, row_number() over (order by value asc nulls first, event_id asc) pos from events"),
    "rename_cols": "select user_id as event_id, event_id as user_id, value from events",
    "feature_projection": "select user_id, ts, value as act__value, event_type as act__event_type from events",
    "select_cols": "select event_id, user_id, value from events",
    "drop_cols": "select event_id, ts, user_id, value from events",
    "add_static": "select event_id, 'x' as tag from events",
    "prepare_entity": "select user_id, ts as event_timestamp from events where event_type = 'purchase'",
    "normalize_ts": "select event_id, epoch_us(ts) as ts_us from events",
    "scan_parquet": "select * from events",
    "scan_csv": "select event_id, ts, user_id, event_type, value from events",
    "append_partitioned": "select event_id, ts, user_id, value, cast(ts as date) as day from events",
}

ORACLES["pit_hot_key_int_source"] = ORACLES["pit_hot_key"]
