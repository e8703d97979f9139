"""First events, merge bins and ordered reports."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tripleweft.plans.rowindex import global_row_index


def first_event_since(events, name, ts, order, since, has, columns, slack_seconds=2):
    """First event per name at or after `since` less the slack, if it carries `has`.

    The earliest is found by a partial aggregate, so no task sorts a hot name.
    """
    start = since - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(slack_seconds))
    kept = events.filter((F.col(ts) >= start) & has)
    first = F.min(F.struct(F.col(ts), *[F.col(c) for c in order], *[F.col(c) for c in columns]))
    return kept.groupBy(name).agg(first.alias("_f")).select(name, f"_f.{ts}", *[f"_f.{c}" for c in [*order, *columns]])


def first_of_candidates(events, name, ts, order, since, has, columns, candidates=50, slack_seconds=2):
    """As `first_event_since`, but only the first `candidates` events of a name are looked at.

    A name whose first event that carries `has` comes later has no match. Every task keeps that many rows of a name before
    anything is shuffled, so a hot name is a bounded number of rows per task.
    """
    start = since - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(slack_seconds))
    first = Window.partitionBy(name).orderBy(ts, *order)
    looked_at = events.filter(F.col(ts) >= start).withColumn("_place", F.row_number().over(first)).filter(F.col("_place") <= candidates)
    wanted = F.min_by(F.struct(ts, *order, *columns), F.when(has, F.col("_place")))
    return looked_at.groupBy(name).agg(wanted.alias("_f")).where("_f IS NOT NULL").select(name, "_f.*")


def merge_bins(df, order, size=3):
    """Add `bin_id`: consecutive rows of a total order in bins of `size`."""
    indexed = global_row_index(df, order)
    return indexed.withColumn("bin_id", F.floor(F.col("row_index") / F.lit(size)).cast("bigint")).drop("row_index")


def ordered_report(df, column, categories):
    """Add the category's `position` in a fixed order and sort by it; others go last."""
    place = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col(column))
    position = F.coalesce(F.nullif(place, F.lit(0).cast("bigint")), F.lit(len(categories) + 1).cast("bigint"))
    return df.withColumn("position", position).orderBy("position", column)
