"""Streams end with the same rows as the batch jobs."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tripleweft import TriplesMap, ref, triples_of
from tripleweft.operators.rules import record_maps
from tripleweft.operators.setops import graph_diff
from tripleweft.scratch import base_dir
from tripleweft.sources.streams import file_stream, with_file_attributes
from tripleweft.streaming.bins import closed_bins, stream_bins
from tripleweft.streaming.jobs import (
    RefreshedRules,
    stream_failure_split,
    stream_map,
    stream_mapping_refresh,
    stream_merge,
    stream_metrics,
)
from tripleweft.vocab import TRIPLE_COLUMNS
from test_rules import RULES, rule

EX = "http://example.org/"
SCHEMA = "id string, name string, v int"
TM = TriplesMap("t", EX + "{id}", (EX + "C",), (("p:name", ref("name")),))


@pytest.fixture
def files(put, tmp_path):
    put("in/a.csv", "1,x,1\n2,,2\n")
    put("in/b.csv", "3,z,-1\n4,w,5\n")
    put("in/c.txt", "not for us\n")
    return str(tmp_path / "in")


def source(spark, path, **options):
    return file_stream(spark, path, SCHEMA, fmt="csv", name_glob="*.csv", max_files=1, **options)


def test_stream_map_and_restart(spark, files, tmp_path, put):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    stream_map(source(spark, files), TM, out, checkpoint).awaitTermination()
    batch = triples_of(spark.read.schema(SCHEMA).csv(files + "/*.csv"), TM)
    assert graph_diff(batch, spark.read.parquet(out), bag=True).isEmpty()
    put("in/d.csv", "5,q,1\n")
    stream_map(source(spark, files), TM, out, checkpoint).awaitTermination()
    again = triples_of(spark.read.schema(SCHEMA).csv(files + "/*.csv"), TM)
    assert again.count() == 9
    assert graph_diff(again, spark.read.parquet(out), bag=True).isEmpty()


def test_stream_merge_bins(spark, files, tmp_path):
    out = str(tmp_path / "out")
    stream = source(spark, files).select("id")
    stream_merge([stream, stream.select(F.concat(F.lit("n"), "id").alias("id"))], ["id"], out, str(tmp_path / "cp"), every=None).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 8
    assert got.groupBy("batch_id", "bin_id").count().filter("count > 3").isEmpty()


def test_rules_refresh_between_batches(spark, files, tmp_path):
    reads = []

    def read():
        reads.append(1)
        return spark.createDataFrame([rule("t", f"p:v{len(reads)}", "reference", "name")], RULES)

    records = record_maps(
        source(spark, files).withColumns({"tenant": F.lit("t"), "source": F.lit("in")}), ["id", "name"], ["tenant", "source"]
    )
    out = str(tmp_path / "out")
    ticks = iter(range(100))
    rules = RefreshedRules(read, 0, lambda: next(ticks))
    stream_mapping_refresh(records, rules, out, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(out)
    assert {r.p for r in got.select("p").distinct().collect()} == {"p:v1", "p:v2"}
    cached = RefreshedRules(read, 10, lambda: 5)
    before = len(reads)
    cached.get(), cached.get()
    assert len(reads) == before + 1


def test_failure_split(spark, files, tmp_path):
    records = with_file_attributes(source(spark, files))
    good, failed = str(tmp_path / "good"), str(tmp_path / "failed")
    stream_failure_split(
        records, "file_name", F.col("v") < 0, F.lit("Negative"), F.col("v").cast("string"), TM, good, failed, str(tmp_path / "cp")
    ).awaitTermination()
    assert rows(spark.read.parquet(failed).select("file_name", "error_message")) == [("b.csv", "-1")]
    want = triples_of(spark.read.schema(SCHEMA).csv(files + "/a.csv"), TM)
    assert graph_diff(want, spark.read.parquet(good).select(*TRIPLE_COLUMNS), bag=True).isEmpty()


def test_metrics(spark, files, tmp_path):
    records = with_file_attributes(source(spark, files))
    metrics = str(tmp_path / "metrics")
    stream_metrics(records, TM, str(tmp_path / "out"), metrics, str(tmp_path / "cp")).awaitTermination()
    got = rows(spark.read.parquet(metrics).select("file_name", "input_bytes", "triples", "batch_triples"))
    assert got == [("a.csv", 11, 3, 3), ("b.csv", 13, 4, 4)]


def test_consumed_files_are_archived(spark, files, tmp_path):
    stream = source(spark, files, done="archive", archive=str(tmp_path / "archive"))
    stream_map(stream, TM, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7


def test_batches_leave_no_folders(spark, tmp_path):
    """After five batches only the folders of the last one are left."""
    base = Path(base_dir(spark).removeprefix("file:"))
    before = set(base.iterdir())
    schema = "tenant string, source string, record map<string,string>"
    source = tmp_path / "in"
    for i in range(5):
        spark.createDataFrame([("t", "s", {"id": str(i)})], schema).coalesce(1).write.mode("append").parquet(str(source))
    rules = spark.createDataFrame(
        [("t", "m", "s", "CSV", None, "s:{id}", ["c:C"], None, None, None, None, None)],
        "tenant string, triples_map string, source string, formulation string, iterator string, subject_template string, "
        "classes array<string>, predicate string, obj_kind string, obj_value string, datatype string, lang string",
    )
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    refreshed = RefreshedRules(lambda: rules, 0, time.monotonic)
    stream_mapping_refresh(stream, refreshed, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    assert len(set(base.iterdir()) - before) <= 3


def test_bins_close_by_number_or_age():
    assert list(closed_bins([0, 1, 2, 3, 20, 21, 40], 3, 10, 41)) == [(0, 3, "number"), (3, 4, "age"), (4, 6, "age")]
    assert list(closed_bins([0, 1, 2], 3, 10, 2)) == []  # a further row of time 2 may come
    assert list(closed_bins([5, 5, 5, 5], 3, 10, 6)) == [(0, 3, "number")]
    assert list(closed_bins([], 3, 10, 100)) == []


@pytest.mark.parametrize("cuts", [(), (3, 4, 9, 10, 11), (1, 2, 5, 7, 8, 12)])
def test_bins_do_not_depend_on_batches(spark, tmp_path, cuts):
    """The same bins however rows are cut into batches, with a restart between any two, late rows left out."""
    times = [(1, 0), (2, 1), (1, 4), (1, 5), (2, 30), (1, 31), (None, 32), (1, 33), (1, 34), (1, 35), (2, 36), (2, 90), (1, 95)]
    data = [(k, n, f"2024-01-01 00:0{s // 60}:{s % 60:02d}") for n, (k, s) in enumerate(times)]
    given, out, checkpoint = [str(tmp_path / x) for x in ("in", "out", "checkpoint")]
    for a, b in zip((0, *cuts), (*cuts, len(data)), strict=True):
        df = spark.createDataFrame(data[a:b], "k int, n int, t string").withColumn("t", F.col("t").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(given)
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(given)
        stream_bins(stream, "k", "t", ["n"], out, checkpoint, 3, "20 seconds", "5 seconds").awaitTermination()
    got = {(r.k, r.n): (r.bin_id, r.closed_by) for r in spark.read.parquet(out).collect()}
    assert got == {
        (1, 0): (0, "number"), (1, 2): (0, "number"), (1, 3): (0, "number"), (1, 5): (1, "number"), (1, 7): (1, "number"), (1, 8): (1, "number"),
        (1, 9): (2, "age"), (2, 1): (0, "age"), (2, 4): (1, "age"), (2, 10): (1, "age"), (None, 6): (0, "age"),
    }


def test_keys_of_a_bucket_share_their_state(spark, tmp_path):
    """Fifty keys in two buckets, with a restart: the bins of each are those of its rows alone."""
    data = [(n % 50 if n % 50 else None, n, 1_700_000_000 + n * 7) for n in range(600)]
    given, out, checkpoint = [str(tmp_path / x) for x in ("in", "out", "checkpoint")]
    for part in (data[:250], data[250:]):
        df = spark.createDataFrame(part, "k int, n int, t long").withColumn("t", F.col("t").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(given)
        stream = spark.readStream.schema(df.schema).parquet(given)
        stream_bins(stream, "k", "t", ["n"], out, checkpoint, 3, "800 seconds", "5 seconds", buckets=2).awaitTermination()
    until, want = data[-1][2] - 5, []
    for key in [None, *range(1, 50)]:
        own = [(n, t) for k, n, t in data if k == key]
        for b, (first, end, reason) in enumerate(closed_bins([t for _, t in own], 3, 800, until)):
            want += [(key, n, b, reason) for n, _ in own[first:end]]
    assert rows(spark.read.parquet(out).select("k", "n", "bin_id", "closed_by")) == sorted(want, key=repr)


def test_state_is_read_and_written_once_for_many_keys():
    from pyspark.sql import Row

    from tripleweft.streaming.bins import _Bins

    class State:
        calls, value = 0, None

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls, self.value = self.calls + 1, value

    class Handle:
        def __init__(self):
            self.state, self.timers = State(), []

        def getValueState(self, *_):
            return self.state

        def registerTimer(self, at):
            self.timers.append(at)

        def getCurrentWatermarkInMs(self):
            return 1000

    handle, bins = Handle(), _Bins("k", ["n"], 3, 500, ["k", "n", "_ms"], ["n"])
    bins.init(handle)
    shape = Row("n", "k", "_ms")
    new = [shape(n, n % 100 / 10 if n % 100 else float("nan"), 400 + n) for n in range(700)]
    closed = [tuple(r) for r in bins.handleInputRows((1,), iter(new), handle)]
    assert handle.state.calls == 2 and len(handle.timers) == 1
    assert len(closed) == 600 and {r[2:] for r in closed} == {(0, "number"), (1, "number")}
    assert list(bins.handleExpiredTimer((1,), handle, None)) == [] and handle.state.calls == 2
