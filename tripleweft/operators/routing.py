"""Routing of inputs by attribute, size, name and validity."""

from pyspark.sql import functions as F

from tripleweft.plans.joins import checked_join
from tripleweft.scratch import write_and_read

# Default size threshold (50 MiB) and reason codes.
SIZE_THRESHOLD = 50 * 1024 * 1024
STRICT = "STRICT"
BELOW = "AUTO_BELOW_THRESHOLD"
ABOVE = "AUTO_ABOVE_THRESHOLD"
FALLBACK = "AUTO_FALLBACK"


def route_by_attribute(df, column, routes, unmatched="unmatched"):
    """Add `route`: the output name whose value the column equals."""
    route = F.lit(unmatched)
    for name, value in reversed(routes.items()):
        route = F.when(F.col(column) == value, F.lit(name)).otherwise(route)
    return df.withColumn("route", route)


def routed(df, routes, unmatched="unmatched"):
    """The outputs of `route_by_attribute` as separate DataFrames."""
    return {name: df.filter(F.col("route") == name).drop("route") for name in [*routes, unmatched]}


def size_class_route(df, size, threshold=SIZE_THRESHOLD, mode="AUTO", large_path=True):
    """Add `route` (`small` or `large`) and the `reason` for it.

    The threshold itself counts as small. Without a path for large inputs they
    fall back to the small one; another mode than AUTO names the route itself.
    """
    if mode != "AUTO":
        return df.withColumns({"route": F.lit(mode.lower()), "reason": F.lit(STRICT)})
    small = F.col(size) <= F.lit(threshold)
    beyond = (F.lit("large"), F.lit(ABOVE)) if large_path else (F.lit("small"), F.lit(FALLBACK))
    return df.withColumns(
        {
            "route": F.when(small, F.lit("small")).otherwise(beyond[0]),
            "reason": F.when(small, F.lit(BELOW)).otherwise(beyond[1]),
        }
    )


def file_filter(df, column, pattern):
    """Rows whose file name matches a pattern as a whole."""
    return df.filter(F.col(column).rlike(f"^(?:{pattern})$"))


def failed_inputs(records, file, is_bad, error_type, error_message):
    """One row per input with a bad record: what went wrong first, and how often."""
    bad = F.when(is_bad, F.struct(error_type.alias("error_type"), error_message.alias("error_message")))
    per_file = records.groupBy(file).agg(F.min(bad).alias("_e"), F.count(bad).alias("bad_records"))
    return per_file.filter(F.col("_e").isNotNull()).select(
        file, "_e.error_type", "_e.error_message", "bad_records"
    )


def failure_routing(records, file, is_bad, error_type, error_message, per_record=False):
    """Split into (good records, failed inputs).

    By default one bad record rejects its whole input; `per_record` keeps the
    good records of such an input. The failed inputs are written to the shared
    folder, so that the records are not searched for them twice.
    """
    failures = write_and_read(failed_inputs(records, file, is_bad, error_type, error_message), "failed-inputs")
    if per_record:
        return records.filter(~F.coalesce(is_bad, F.lit(False))), failures
    return checked_join(records, failures.select(file), [file], "left_anti"), failures
