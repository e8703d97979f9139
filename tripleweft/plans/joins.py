"""Joins that stay safe when a side grows or one key is hot."""

import math

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleweft.scratch import write_and_read

# Bounds under which a side may be copied to every executor.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Rows of a key that one task takes before the key is split; and hot keys that may be found at most, which bounds their
# broadcast: no more keys than this can each have the same share of all rows.
HOT_ROWS = 1_000_000
HOT_KEYS = 100_000


def dealt_join(left, right, on, how="inner", rows=None):
    """Equi-join that copies neither side to the driver, whatever Spark takes their sizes for.

    Spark sizes a table by its compressed files, an exploded one by its rows before, and an array by one entry, so that a
    table of half a gigabyte may seem small enough to broadcast. For sides that grow with the data. `rows` is a counted
    bound of narrow rows on either side; up to `BROADCAST_ROWS` Spark may choose.
    """
    return left.join(right if rows is not None and rows <= BROADCAST_ROWS else right.hint("merge"), on, how)


def fits(df, max_rows=BROADCAST_ROWS, max_bytes=BROADCAST_BYTES):
    """Measure whether `df` is small enough to broadcast: one count, partial in every task.

    It computes `df` once; write a costly side first (`checked_join` does with `write_right`).
    """
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return row.n <= max_rows and (row.b or 0) <= max_bytes


def row_spread(df, parts):
    """A number below `parts` for each row, to spread rows that share a key.

    It comes from the row's content and the number of its partition. Exact
    copies of a row are spread as well, since they lie in many partitions, and
    a task that runs again gives its rows the same numbers.
    """
    cols = []
    for f in df.schema:
        if isinstance(f.dataType, T.MapType):
            cols.append(F.map_entries(f.name))
        elif not isinstance(f.dataType, T.VariantType):
            cols.append(F.col(f"`{f.name}`"))
    return F.pmod(F.xxhash64(*cols, F.spark_partition_id()), F.lit(parts)).cast("int")


def hot_keys(df, keys, hot_rows=HOT_ROWS):
    """Keys with more rows than a task takes, and the number of salts for each: rows over rows per task.

    The count is pre-aggregated before its shuffle. A task takes `hot_rows`, or the 100,000th part of all rows if that is
    more, so there can be no more than 100,000 such keys whatever the data: the table is small enough to broadcast, and
    no key is left out.
    """
    seen = Observation()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).observe(seen, F.sum("_n").alias("rows"))
    counts = write_and_read(counts.where(F.col("_n") > hot_rows), "hot-keys")
    per_task = max(hot_rows, math.ceil((seen.get["rows"] or 0) / HOT_KEYS))
    return counts.where(F.col("_n") > per_task).select(*keys, F.ceil(F.col("_n") / per_task).cast("int").alias("_salts"))


def salted_join(left, right, keys, how="inner", hot_rows=HOT_ROWS, counts_from=None, hot=None):
    """Equi-join in which `left` may have hot keys.

    Hot keys are counted first; without any, this is a plain join. Else rows of a hot key get one of that key's salts on
    the left, and the right rows of the key are copied once per salt. All other keys join as usual. `counts_from` names
    a cheaper DataFrame in which the same keys are hot; `hot` is the result of `hot_keys`, for chains of joins on one key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    keys = list(keys)
    hot = hot_keys(left if counts_from is None else counts_from, keys, hot_rows) if hot is None else hot
    if hot.isEmpty():
        return left.join(right, keys, how)
    hot = F.broadcast(hot)
    # Null keys match nothing, so they may be spread too.
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    spread = F.when(no_key, F.col("_spread") % 1024).otherwise(F.coalesce(F.pmod("_spread", "_salts"), F.lit(0)))
    l = left.withColumn("_spread", row_spread(left, 1 << 30)).join(hot, keys, "left")
    l = l.withColumn("_salt", spread.cast("int")).drop("_salts", "_spread")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    r = right.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return l.join(r, [*keys, "_salt"], how).drop("_salt")


def checked_join(left, right, keys, how="inner", max_rows=BROADCAST_ROWS, max_bytes=BROADCAST_BYTES, write_right=False):
    """Broadcast `right` if it measures small, else join with salted hot keys.

    `write_right` writes a costly right side to the shared folder first, so
    that measuring and joining do not both compute it.
    """
    if write_right:
        right = write_and_read(right, "join-side")
    if fits(right, max_rows, max_bytes):
        return left.join(F.broadcast(right), list(keys), how)
    return salted_join(left, right, keys, how)
