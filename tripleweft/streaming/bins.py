"""Bins that close by number or by age, over micro-batches: keyed state with timers."""

import itertools
import operator
import pickle
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tripleweft.streaming.jobs import _trigger

# The setting that names a state store, and the one that has timers.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Buckets of keys that have their state together. A stream keeps the number that its checkpoint began with.
BUCKETS = 4096


def closed_bins(times, size, age, until):
    """Bins of rows in order of time: (first, end, reason) of each that is closed, `until` a time that all rows before have come.

    A bin has up to `size` rows that come less than `age` after its first. It closes by number once its last row lies
    before `until`, or by age.
    """
    first = 0
    while first < len(times):
        end = first + 1
        while end < len(times) and end - first < size and times[end] < times[first] + age:
            end += 1
        if end - first == size and times[end - 1] < until:
            yield first, end, "number"
        elif times[first] + age <= until:
            yield first, end, "age"
        else:
            return
        first = end


def _name(key):
    """A key by which a dictionary tells keys apart as a grouping does."""
    if isinstance(key, (list, tuple)):
        return tuple(_name(k) for k in key)
    if isinstance(key, bytearray):
        return bytes(key)
    return key if key == key else "NaN"  # of a column of numbers, which holds no text


class _Bins(StatefulProcessor):
    """Rows of a bucket of keys wait in order of time until their bin is closed.

    Every call of the state is an exchange with the JVM, and every row in it is converted there. So the state of a bucket is
    one value: (rows that wait, (key, number of bins) of each key), pickled.
    """

    def __init__(self, key, order, size, age_ms, names, columns):
        self.key, self.order, self.size, self.age = key, order, size, age_ms
        self.names, self.columns = names, columns
        self.turned = {}

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState("bins", "held binary")

    def _turn(self, bucket, new, timers):
        """Close what can be closed, keep the rest, and set a timer for the first of its bins to close."""
        until = timers.getCurrentWatermarkInMs()
        if not new and self.turned.get(bucket) == until:
            return  # a timer of a bucket that had rows in this batch
        self.turned[bucket] = until
        names = self.names
        own, stamp = names.index(self.key), names.index("_ms")
        place = [stamp, *[names.index(c) for c in self.order]]
        made = Row(self.key, *self.columns, "bin_id", "closed_by")
        shown = [names.index(c) for c in self.columns]
        held = self.state.get()
        waiting, numbered = pickle.loads(held[0]) if held is not None else ((), ())
        rows, numbers = {}, {_name(k): (k, n) for k, n in numbered}
        for r in itertools.chain(waiting, new):
            rows.setdefault(_name(r[own]), []).append(r)
        kept, at, closed = [], None, False
        for name, some in rows.items():
            some.sort(key=lambda r: [(r[i] is not None, r[i]) for i in place])
            key = some[0][own]
            number, done = numbers[name][1] if name in numbers else 0, 0
            for first, end, reason in closed_bins([r[stamp] for r in some], self.size, self.age, until):
                for r in some[first:end]:
                    yield made(key, *[r[i] for i in shown], number, reason)
                number, done = number + 1, end
            if done:
                numbers[name], closed = (key, number), True
            if done < len(some):
                next_at = some[done][stamp] + self.age
                if len(some) - done >= self.size:
                    next_at = min(next_at, some[done + self.size - 1][stamp] + 1)
                at = next_at if at is None else min(at, next_at)
                kept += some[done:]
        if new or closed:
            self.state.update((pickle.dumps((kept, list(numbers.values()))),))
        if kept:
            self.handle.registerTimer(at)

    def handleInputRows(self, key, rows, timerValues):
        first = next(rows, None)
        if first is not None:
            pick = operator.itemgetter(*[first.__fields__.index(c) for c in self.names])
            yield from self._turn(key[0], [pick(r) for r in itertools.chain([first], rows)], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._turn(key[0], [], timerValues)

    def close(self):
        pass


@contextmanager
def _state_store(spark):
    """A query takes the settings that it starts under."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def bins_of(records, key, time, order, size, age, delay, buckets=BUCKETS):
    """Streaming rows with `bin_id` and `closed_by`, once their bin is closed.

    Rows of one `key` go in order of `time` (then `order`) into bins of `size`; a bin also closes `age` after its first
    row. Bins do not end with a micro-batch: rows wait in state until the watermark, `delay` behind the latest time, has
    passed them, so bins do not depend on how rows were cut into batches. Rows that come later than the delay are left
    out, as are rows without time; null is a key like others. A key's bins are one sequence, so a task keeps up with one
    key at a time: give a hot key several by a further digit, e.g. of a hash of the row. Keys have their state by `buckets`
    of their hash: a batch reads and writes that of the buckets it has rows for, with the bin numbers of all their keys.
    """
    columns = [c for c in records.columns if c != key]
    stamped = records.where(F.col(time).isNotNull()).withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", delay)
    stamped = stamped.withColumn("_ms", F.unix_millis("_at")).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    names = stamped.drop("_at", "_bucket").columns
    output = records.select(key, *columns).schema.add("bin_id", "long").add("closed_by", "string")
    age_ms = int(pd.Timedelta(age).total_seconds() * 1000)
    processor = _Bins(key, list(order), size, age_ms, names, columns)
    return stamped.groupBy("_bucket").transformWithState(processor, output, "append", "eventTime")


def stream_bins(records, key, time, order, path, checkpoint, size=3, age="10 seconds", delay="10 seconds", every=None, buckets=BUCKETS):
    """Write the rows of closed bins (see `bins_of`) to a parquet folder; a restart goes on from the checkpoint."""
    rows = bins_of(records, key, time, order, size, age, delay, buckets)
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    with _state_store(records.sparkSession):
        return _trigger(writer, every).start()
