"""Counts over triples and records, and grouped means."""

from pyspark.sql import functions as F

from tripleweft.functions.names import mime_type
from tripleweft.plans.compile import with_triple_count
from tripleweft.plans.meeting import distinct_rows
from tripleweft.vocab import TRIPLE_COLUMNS


def triple_count(triples):
    """Number of triples, repeats counted."""
    return triples.agg(F.count(F.lit(1)).alias("triples"))


def distinct_triple_count(triples):
    """Number of different triples.

    A null datatype or language is a value like any other.
    """
    return distinct_rows(triples.select(*TRIPLE_COLUMNS)).agg(F.count(F.lit(1)).alias("triples"))


def record_count(records, maps):
    """Records that each triples map over one scan takes in."""
    counts = [
        (F.count(F.lit(1)) if tm.where is None else F.count_if(tm.where)).alias(f"_n{i}")
        for i, tm in enumerate(maps)
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(tm.source).alias("source"), F.lit(tm.label).alias("triples_map"), F.col(f"_n{i}").alias("records")
            )
            for i, tm in enumerate(maps)
        ]
    )
    return records.agg(*counts).select(F.inline(rows))


def triples_per_input(records, maps, file="file_name", size="file_size", attrs=None):
    """Size and number of triples of every input, also of those that yield none; triples are counted, not built."""
    counted = with_triple_count(records, maps, keep=(file, size), attrs=attrs)
    return counted.groupBy(F.col(file).alias(file)).agg(F.max(size).alias("input_bytes"), F.sum("triples").alias("triples"))


def run_metrics(records, maps, file="file_name", size="file_size", output_format="NTRIPLES", engine="spark", reason="STRICT"):
    """One row per input: what was run, how much came in, how much came out."""
    name = F.lit(output_format)
    per_input = triples_per_input(records, maps, file, size)
    return per_input.select(
        F.col(file).alias("file_name"),
        F.lit(engine).alias("engine"),
        F.lit(reason).alias("reason"),
        "input_bytes",
        name.alias("output_format"),
        "triples",
        mime_type(name).alias("mime_type"),
    )


def mean_by(df, value, *keys, name="mean_value"):
    """Mean of a column per group."""
    return df.groupBy(*keys).agg(F.avg(value).alias(name), F.count(F.lit(1)).alias("runs"))


def throughput(df, amount, millis, *keys):
    """Mean amount per second per group, over runs that produced something."""
    rate = F.col(amount) / (F.col(millis) / F.lit(1000.0))
    return df.filter(F.col(amount) > 0).groupBy(*keys).agg(F.avg(rate).alias("per_second"))


def pivot_ratio(df, key, column, values, measure):
    """Means of two categories side by side, and their ratio (first by second).

    The values are given, so both means come from one grouped pass.
    """
    first, second = [F.avg(F.when(F.col(column) == v, F.col(measure))) for v in values]
    wide = df.groupBy(key).agg(first.alias("first_mean"), second.alias("second_mean"))
    return wide.withColumn("ratio", F.try_divide("first_mean", "second_mean"))


def duplicate_ids(df, *ids):
    """Ids that occur more than once."""
    return df.groupBy(*ids).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)
