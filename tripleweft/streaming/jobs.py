"""Streaming mapping jobs: triples, failures, metrics and mapping refresh.

Every job takes a streaming DataFrame of records and returns a started query.
Nothing here keeps state between batches but the checkpoint, so a lost
executor or a restarted job repeats at most one batch, and sinks that write in
`foreachBatch` name their folder by batch, which makes a repeat overwrite
itself.
"""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tripleweft.operators.aggregates import triples_per_input
from tripleweft.operators.routing import failure_routing
from tripleweft.operators.rules import apply_compiled, compile_rules
from tripleweft.plans.compile import triples_of
from tripleweft.plans.rowindex import global_row_index
from tripleweft.scratch import BatchScratch, drop_path, untracked


def _trigger(writer, every=None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def stream_map(records, maps, path, checkpoint, every=None, keep=()):
    """Append the triples of arriving records to a parquet folder; no shuffle."""
    triples = triples_of(records, maps, keep=keep)
    writer = triples.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def _per_batch(records, handle, checkpoint, every, scratch=None):
    """Start a query that hands each batch on; intermediate tables of a batch go when the next one begins."""
    scratch = scratch or BatchScratch()

    def run(batch, batch_id):
        scratch.begin(batch.sparkSession, batch_id)
        try:
            handle(batch, batch_id)
        finally:
            scratch.end()

    writer = records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def _batch_path(path, batch_id):
    return f"{path}/batch_id={batch_id}"


def stream_merge(streams, order, path, checkpoint, size=3, every="10 seconds"):
    """Merge streams; each batch, which closes by age, is cut into bins of `size` rows."""
    merged = streams[0]
    for other in streams[1:]:
        merged = merged.unionByName(other)

    def handle(batch, batch_id):
        indexed = global_row_index(batch, order)
        bins = indexed.withColumn("bin_id", F.floor(F.col("row_index") / F.lit(size)).cast("bigint"))
        bins.drop("row_index").write.mode("overwrite").parquet(_batch_path(path, batch_id))

    return _per_batch(merged, handle, checkpoint, every)


class RefreshedRules:
    """Compiled rules, read again once they are older than the TTL (0: always)."""

    def __init__(self, read, ttl_seconds, clock):
        self._read, self._ttl, self._clock = read, ttl_seconds, clock
        self._rules, self._at = None, None
        self._made, self._stale = [], []

    def get(self):
        now = self._clock()
        if self._rules is None or now - self._at >= self._ttl:
            with untracked() as made:
                rules = compile_rules(self._read())
            for path in self._stale:
                drop_path(rules.sparkSession, path)
            # The batch before may still be repeated with the rules it had.
            self._stale, self._made = self._made, made
            self._rules, self._at = rules, now
        return self._rules


def stream_mapping_refresh(records, rules, path, checkpoint, every=None):
    """Map record maps (tenant, source, record) by rules that may change between batches."""

    def handle(batch, batch_id):
        triples = apply_compiled(batch, rules.get())
        triples.write.mode("overwrite").parquet(_batch_path(path, batch_id))

    return _per_batch(records, handle, checkpoint, every)


def stream_failure_split(
    records, file, is_bad, error_type, error_message, maps, good_path, failed_path, checkpoint, per_record=False, every=None
):
    """Triples of good inputs to one folder, failed inputs to another."""

    def handle(batch, batch_id):
        good, failures = failure_routing(batch, file, is_bad, error_type, error_message, per_record)
        failures.write.mode("overwrite").parquet(_batch_path(failed_path, batch_id))
        triples_of(good, maps, keep=(file,)).write.mode("overwrite").parquet(_batch_path(good_path, batch_id))

    return _per_batch(records, handle, checkpoint, every)


def stream_metrics(records, maps, path, metrics_path, checkpoint, file="file_name", size="file_size", every=None):
    """Write triples, and per batch and input file the size and triple count.

    The batch total is observed while the triples are written, so it costs no
    further pass; the per-file rows are counted over the records, so that a file
    without triples has one too.
    """

    def handle(batch, batch_id):
        seen = Observation(f"triples-{batch_id}")
        triples = triples_of(batch, maps, keep=(file, size)).observe(seen, F.count(F.lit(1)).alias("triples"))
        triples.write.mode("overwrite").parquet(_batch_path(path, batch_id))
        per_file = triples_per_input(batch, maps, file, size)
        per_file = per_file.withColumn("batch_triples", F.lit(seen.get["triples"]).cast("bigint"))
        per_file.write.mode("overwrite").parquet(_batch_path(metrics_path, batch_id))

    return _per_batch(records, handle, checkpoint, every)
