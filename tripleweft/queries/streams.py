"""Queries that run a stream over a table's files to its end and read the result."""

import time

from pyspark.sql import functions as F

from tripleweft.mapping import TriplesMap, ref, template
from tripleweft.queries.common import COLS, DECIMAL, EX, Registry, iri, link, money, money_sql, rule, table, triples_sql
from tripleweft.queries.rules import _BAD_EVENT_SQL, _NATION_RULES_SQL, nation_rules
from tripleweft.scratch import new_path
from tripleweft.sources.streams import file_stream, with_file_attributes
from tripleweft.streaming.bins import stream_bins
from tripleweft.streaming.jobs import (
    RefreshedRules,
    stream_failure_split,
    stream_map,
    stream_mapping_refresh,
    stream_merge,
    stream_metrics,
)
from tripleweft.operators.rules import record_maps
from tripleweft.vocab import TRIPLE_COLUMNS

registry = Registry()

#: Rows of a file of a delivery, at least, where there are several.
FILE_ROWS = 500_000


def table_stream(spark, sf_dir, name):
    schema = table(spark, sf_dir, name).schema
    return file_stream(spark, sf_dir, schema, name_glob=f"{name}.parquet")


def event_map():
    return TriplesMap(
        "events",
        EX + "event/{event_id}",
        objects=(
            (EX + "user", template(EX + "user/{user_id}")),
            (EX + "type", ref("event_type")),
            (EX + "value", ref(money("value"), datatype=DECIMAL)),
        ),
        unique_subject=True,
    )


def events_sql(where="TRUE", extra=""):
    return triples_sql(
        "events",
        iri("event", "event_id"),
        [
            link(EX + "user", iri("user", "user_id")),
            rule(EX + "type", "event_type"),
            rule(EX + "value", money_sql("value"), datatype=DECIMAL),
        ],
        where,
        extra,
    )


@registry.add("stream_map", f"SELECT {COLS} FROM ({events_sql()})")
def stream_map_query(spark, sf_dir):
    out = new_path(spark, "stream-map")
    stream_map(table_stream(spark, sf_dir, "events"), event_map(), out, new_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out).select(*TRIPLE_COLUMNS)


@registry.add(
    "stream_merge",
    """
    SELECT kind, id, (row_number() OVER (ORDER BY kind, id) - 1) // 3 AS bin_id
    FROM (SELECT 'order' AS kind, o_orderkey AS id FROM orders UNION ALL SELECT 'event', event_id FROM events)
    """,
)
def stream_merge_query(spark, sf_dir):
    """Two streams merged into bins of three."""
    orders = table_stream(spark, sf_dir, "orders").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"))
    events = table_stream(spark, sf_dir, "events").select(F.lit("event").alias("kind"), F.col("event_id").alias("id"))
    out = new_path(spark, "stream-merge")
    stream_merge([orders, events], ["kind", "id"], out, new_path(spark, "checkpoint"), every=None).awaitTermination()
    return spark.read.parquet(out).select("kind", "id", "bin_id")


def events_by_time(spark, sf_dir, parts):
    """Events in `parts` ranges of time, one after the other."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    cuts = events.agg(F.percentile_approx(at, [k / parts for k in range(1, parts)])).first()[0] or []
    bounds = [None, *cuts, None]
    for low, high in zip(bounds, bounds[1:], strict=False):
        after = F.lit(True) if low is None else at >= low
        yield events.where(after & (F.lit(True) if high is None else at < high))


@registry.add(
    "stream_bins",
    """
    WITH RECURSIVE r AS (
      SELECT user_id, event_id, epoch_ms(ts) AS ms, row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts), event_id) AS rn FROM events),
    limits AS (SELECT max(epoch_ms(ts)) - 3600000 AS until, 12 * 3600000 AS age FROM events),
    b AS (
      SELECT user_id, event_id, ms, rn, 0 AS bin_id, ms AS start, 1 AS k FROM r WHERE rn = 1
      UNION ALL
      SELECT r.user_id, r.event_id, r.ms, r.rn,
             CASE WHEN b.k = 3 OR r.ms >= b.start + age THEN b.bin_id + 1 ELSE b.bin_id END,
             CASE WHEN b.k = 3 OR r.ms >= b.start + age THEN r.ms ELSE b.start END,
             CASE WHEN b.k = 3 OR r.ms >= b.start + age THEN 1 ELSE b.k + 1 END
      FROM b JOIN r ON r.user_id = b.user_id AND r.rn = b.rn + 1, limits),
    bins AS (SELECT user_id, bin_id, count(*) AS n, max(ms) AS last, min(start) AS start FROM b GROUP BY user_id, bin_id)
    SELECT b.user_id, b.event_id, CAST(b.bin_id AS BIGINT) AS bin_id, CASE WHEN n = 3 AND last < until THEN 'number' ELSE 'age' END AS closed_by
    FROM b JOIN bins USING (user_id, bin_id), limits WHERE (n = 3 AND last < until) OR bins.start + age <= until
    """,
)
def stream_bins_query(spark, sf_dir):
    """Bins of three events of a user, or of twelve hours, over six deliveries with a restart after the third."""
    given, out, checkpoint = new_path(spark, "bins-in"), new_path(spark, "bins"), new_path(spark, "checkpoint")
    parts = list(events_by_time(spark, sf_dir, 6))
    # As many files in every delivery, none of them empty, so that a batch takes one delivery.
    files = max(1, min(part.count() for part in parts) // FILE_ROWS)
    for k, part in enumerate(parts):
        part.repartition(files).write.mode("append").parquet(given)
        if k in (2, 5):
            arriving = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", files).parquet(given)
            stream_bins(arriving, "user_id", "ts", ["event_id"], out, checkpoint, 3, "12 hours", "1 hour").awaitTermination()
    return spark.read.parquet(out).select("user_id", "event_id", "bin_id", "closed_by")


@registry.add("stream_mapping_refresh", _NATION_RULES_SQL)
def stream_mapping_refresh_query(spark, sf_dir):
    """Rules are read again for each batch (TTL 0)."""
    customer = table_stream(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("string").alias("tenant"),
        F.lit("customer").alias("source"),
        "c_custkey",
        "c_name",
        F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
    )
    records = record_maps(customer, ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"], ["tenant", "source"])
    rules = RefreshedRules(lambda: nation_rules(spark, sf_dir), 0, time.monotonic)
    out = new_path(spark, "stream-refresh")
    stream_mapping_refresh(records, rules, out, new_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out).select(*TRIPLE_COLUMNS)


def run_failure_split(spark, sf_dir):
    events = table_stream(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    bad = (F.col("event_type") == "error") & (F.col("value") < 1)
    message = F.concat(F.lit("value "), F.col("value").cast("decimal(18,2)").cast("string"))
    good, failed = new_path(spark, "stream-good"), new_path(spark, "stream-failed")
    stream_failure_split(
        events, "user_id", bad, F.lit("BadValue"), message, event_map(), good, failed, new_path(spark, "checkpoint")
    ).awaitTermination()
    return good, failed


_GOOD = f"user_id NOT IN (SELECT user_id FROM events WHERE {_BAD_EVENT_SQL})"


@registry.add("stream_failure_split", f"SELECT user_id, {COLS} FROM ({events_sql(_GOOD, 'user_id, ')})")
def stream_failure_split_query(spark, sf_dir):
    good, _ = run_failure_split(spark, sf_dir)
    return spark.read.parquet(good).select("user_id", *TRIPLE_COLUMNS)


@registry.add(
    "stream_failures",
    f"SELECT user_id, 'BadValue' AS error_type, count(*) AS bad_records FROM events WHERE {_BAD_EVENT_SQL} GROUP BY user_id",
)
def stream_failures(spark, sf_dir):
    _, failed = run_failure_split(spark, sf_dir)
    return spark.read.parquet(failed).select("user_id", "error_type", "bad_records")


@registry.add(
    "stream_metrics",
    f"SELECT 'events.parquet' AS file_name, count(*) AS triples, count(*) AS batch_triples FROM ({events_sql()})",
)
def stream_metrics_query(spark, sf_dir):
    events = with_file_attributes(table_stream(spark, sf_dir, "events"))
    out, metrics = new_path(spark, "stream-triples"), new_path(spark, "stream-metrics")
    stream_metrics(events, event_map(), out, metrics, new_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(metrics).select("file_name", "triples", "batch_triples")
