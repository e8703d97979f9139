"""As-of join: each record with the last version of its key that was in force at its time."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tripleweft.plans.joins import row_spread
from tripleweft.scratch import write_and_read

# Bits that monotonically_increasing_id gives to the row within its partition.
_ROW_BITS = 33


def as_of_join(records, versions, key, time, since, columns, partitions=None):
    """`records` with `columns` of the last row of `versions` with an equal `key` and `since` not after `time`.

    Records before the first version of their key get nulls, as do those without key or time; of versions of one key and
    time the greatest by `columns` counts. Both sides are range-sorted together by key and time, and a version is carried
    along within a range, so the records and versions of one key may be any number: a hot key is as many ranges as it has
    rows for. What is in force where a range starts comes from a table with one row for each range.
    """
    carried = F.struct(*[F.col(c) for c in columns])
    names = records.columns
    left = records.select(F.col(key).alias("_key"), F.col(time).alias("_time"), F.lit(1).alias("_side"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    right = versions.where(F.col(key).isNotNull() & F.col(since).isNotNull())
    right = right.select(F.col(key).alias("_key"), F.col(since).alias("_time"), F.lit(0).alias("_side"), carried.alias("_version"))
    both = left.withColumn("_version", F.lit(None).cast(right.schema["_version"].dataType)).unionByName(right.withColumn("_row", F.lit(None).cast(left.schema["_row"].dataType)))
    # Rows of one key and time are parted too, so that no range grows with them; versions stay in the order of their columns.
    tied = both.withColumn("_tie", F.when(F.col("_side") == 1, row_spread(both, 1 << 30)))
    order = ["_key", "_time", "_side", "_version", "_tie"]
    ranged = tied.repartitionByRange(*([partitions] if partitions else []), *order).sortWithinPartitions(*order).drop("_tie")
    ranged = write_and_read(ranged.withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", _ROW_BITS)), "as-of")
    edges = ranged.groupBy("_part").agg(
        F.min_by("_key", "_id").alias("first_key"),
        F.max_by("_key", "_id").alias("last_key"),
        F.max_by(F.struct("_key", "_version"), F.when(F.col("_version").isNotNull(), F.col("_id"))).alias("latest"),
    )
    # The version in force at the end of a range, if it is one of the key that the range ends with.
    own = F.when(F.col("latest._key") == F.col("last_key"), F.col("latest._version"))
    whole = Window.partitionBy("last_key").orderBy("_part")
    edges = edges.withColumn("at_end", F.last(own, ignorenulls=True).over(whole))
    before = Window.orderBy("_part")
    carry = edges.select("_part", "first_key", F.lag("last_key").over(before).alias("key_before"), F.lag("at_end").over(before).alias("version_before"))
    carry = carry.where("first_key = key_before").select("_part", F.col("first_key").alias("_from_key"), F.col("version_before").alias("_from"))
    within = Window.partitionBy("_part", "_key").orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = ranged.withColumn("_last", F.last("_version", ignorenulls=True).over(within)).where("_side = 1")
    known = known.join(F.broadcast(carry), "_part", "left")
    inherited = F.when(F.col("_key") == F.col("_from_key"), F.col("_from"))
    found = F.when(F.col("_time").isNotNull(), F.coalesce("_last", inherited))
    return known.select("_row.*", found.alias("_found")).select(*[F.col(f"`{c}`") for c in names], *[F.col(f"_found.{c}").alias(c) for c in columns])
