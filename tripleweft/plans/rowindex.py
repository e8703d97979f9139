"""A global row number without putting all rows in one task."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tripleweft.plans.joins import row_spread
from tripleweft.scratch import write_and_read

# Bits that monotonically_increasing_id gives to the row within its partition.
_ROW_BITS = 33


def global_row_index(df, order, name="row_index", partitions=None):
    """Add the 0-based position of each row in the given total order.

    Rows are range-partitioned and sorted, numbered within their partition,
    and written once to the shared folder, since range bounds are sampled and
    must not be drawn twice. Rows that are equal in the order are parted by
    content and origin, so that no range grows with them. The offset of a
    partition is the sum of the sizes before it: a table with one row per
    partition, small by construction.
    """
    parts = [partitions] if partitions else []
    tied = df.withColumn("_tie", row_spread(df, 1 << 30))
    ordered = tied.repartitionByRange(*parts, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    marked = write_and_read(ordered.withColumn("_id", F.monotonically_increasing_id()), "row-index")
    part = F.shiftright("_id", _ROW_BITS)
    row = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = marked.groupBy(part.alias("_part")).agg((F.max(row) + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    out = marked.withColumn("_part", part).withColumn("_row", row)
    return (
        out.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .drop("_id", "_part", "_row", "_offset")
    )
