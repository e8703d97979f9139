"""Mixing sources to target weights by entropy balancing.

Every document gets a rate: how often the mix takes it. Among all rates that give each source its target of words, the
ones nearest to 1 in relative entropy are `exp(lambda * size)`, capped, with one multiplier per source. The multipliers
solve a convex dual by Newton steps; each step is one aggregation over counts by (source, size), which are exact and far
fewer than documents. Rates are then rounded into whole copies.
"""

import math

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleweft.llm.common import word_count
from tripleweft.plans.joins import dealt_join, fits
from tripleweft.plans.rowindex import global_row_index
from tripleweft.scratch import Steps, write_and_read

TOLERANCE = 1e-7
MAX_STEPS = 200
#: Documents that one task rounds together.
BUCKET_ROWS = 4096


def _same(a, b):
    return F.col(a).eqNullSafe(F.col(b))


def source_targets(sources, total, weights, cap):
    """Targets (source, source_size, target) from cyclic weights.

    `sources` has (source, source_size). Sources in ascending code point order, null last, weigh `weights`, repeating,
    and share `total`; a target stops at `cap` times its source's size and the excess is shared anew by weight among the
    others, until none is above. If all stop, less than `total` is given out. No sources: no rows.
    """
    ordered = global_row_index(sources, [F.col("source").isNull(), F.col("source")], "_place")
    table = F.array(*[F.lit(float(w)) for w in weights])
    ordered = ordered.withColumn("weight", F.element_at(table, (F.col("_place") % len(weights) + 1).cast("int")))
    level, limit = 0.0, F.col("source_size") * float(cap)
    while True:  # at most one round per source, in practice two or three: only ever more sources stop
        stopped = F.col("weight") * F.lit(level) > limit
        row = ordered.agg(
            F.sum(F.when(stopped, limit).otherwise(0.0)).alias("given"), F.sum(F.when(stopped, 0.0).otherwise(F.col("weight"))).alias("weight")
        ).first()
        left = total - (row["given"] or 0.0)
        new = left / row["weight"] if row["weight"] else math.inf
        if new == level or math.isinf(new):
            level = new
            break
        level = new
    raw = F.lit(level) * F.col("weight") if not math.isinf(level) else limit
    out = ordered.select("source", "source_size", F.least(raw, limit).cast("double").alias("target"))
    return write_and_read(out, "mix-targets")


def _solve(histogram, targets, cap):
    """Multipliers (source, source_size, target, mean, lam) by safeguarded Newton steps.

    `lam` multiplies the size in units of the source's mean size. A target at the cap is met by the cap itself and one
    of 0 by rate 0; both are marked by an infinite multiplier.
    """
    shape = histogram.where("size > 0").groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"), F.min("size").alias("least"))
    shape = shape.withColumnRenamed("source", "_source")
    start = targets.join(shape, _same("source", "_source"), "left").drop("_source")
    full, none = F.col("target") >= F.col("source_size") * cap * (1 - 1e-12), F.col("target") <= 0
    inf = F.lit(math.inf)
    state = start.select(
        "source",
        "source_size",
        "target",
        "mean",
        F.when(full, inf).when(none, -inf).otherwise(0.0).alias("lam"),
        F.lit(None).cast("double").alias("low"),
        # Here every document of the source is at the cap.
        (F.lit(math.log(cap)) * F.col("mean") / F.col("least")).alias("high"),
        (full | none | F.col("mean").isNull()).alias("done"),
    )
    steps = Steps("mix-state")
    state = steps.write(state)
    for step in range(MAX_STEPS + 1):
        if state.where(~F.col("done")).isEmpty():
            break
        if step == MAX_STEPS:
            raise ValueError(f"a source misses its target after {MAX_STEPS} steps")
        x = F.col("size") / F.col("mean")
        rate = F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * x, F.lit(700.0))))
        words = F.col("n") * F.col("size")
        now = state.where(~F.col("done")).select(F.col("source").alias("_source"), "mean", "lam")
        sums = (
            histogram.join(now, _same("source", "_source"))
            .groupBy("source")
            .agg(F.sum(words * rate).alias("value"), F.sum(F.when(rate < cap, words * x * rate).otherwise(0.0)).alias("slope"))
            .withColumnRenamed("source", "_source")
        )
        gap = F.col("value") - F.col("target")
        low, high = F.when(gap < 0, F.col("lam")).otherwise(F.col("low")), F.when(gap > 0, F.least("high", "lam")).otherwise(F.col("high"))
        newton = F.col("lam") - gap / F.col("slope")
        inside = (newton > F.coalesce(F.col("low2"), F.lit(-math.inf))) & (newton < F.col("high2")) & (F.col("slope") > 0)
        middle = F.when(F.col("low2").isNull(), F.col("high2") - 2 * F.greatest(F.abs("high2"), F.lit(1.0))).otherwise((F.col("low2") + F.col("high2")) / 2)
        good = F.abs(gap) <= TOLERANCE * F.col("target")
        joined = state.join(sums, _same("source", "_source"), "left").withColumn("low2", low).withColumn("high2", high)
        stay = F.col("done") | good
        state = joined.select(
            "source",
            "source_size",
            "target",
            "mean",
            F.when(stay, F.col("lam")).when(inside, newton).otherwise(middle).alias("lam"),
            F.when(stay, F.col("low")).otherwise(F.col("low2")).alias("low"),
            F.when(stay, F.col("high")).otherwise(F.col("high2")).alias("high"),
            stay.alias("done"),
        )
        state = steps.write(state)
    return state


def _whole(key, pdf, cap):
    """Copies of all rows of the units of one bucket: largest first, each takes up what rounding has left over so far."""
    pdf = pdf.sort_values(["words", "doc_id", "size"], ascending=[False, True, True], kind="stable", na_position="last")
    sizes, rows, rate, carried = pdf["size"].tolist(), pdf["n"].tolist(), pdf["rate"].tolist(), 0.0
    copies = []
    for w, n, r in zip(sizes, rows, rate, strict=True):
        want = r * n * w + carried
        c = min(math.floor(cap) * n, max(0, math.floor(want / w + 0.5))) if w else n * math.floor(r + 0.5)
        carried = want - c * w
        copies.append(c)
    return pdf.assign(copies=np.array(copies, np.int64))[["doc_id", "source", "size", "n", "copies"]]


def copies(sized, targets, cap=2):
    """Copies by kind of row: (doc_id, source, size, n, copies) from `sized` (doc_id, source, size) and its targets.

    Rows that agree in all three count as one unit of `n` rows, whatever else they hold; `copies` is what they get
    together, 0 to `cap` each. A source's words times copies end within half a small document per bucket of its target. The bucket of
    a unit follows from its id, so reruns agree and a hot source spreads over as many tasks as it has rows for.
    A document without words changes nothing: it is taken once (never, if its source's target is 0).
    """
    units = write_and_read(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), "mix-units")
    histogram = write_and_read(units.groupBy("source", "size").agg(F.sum("n").alias("n")), "mix-sizes")
    solved = _solve(histogram, targets, cap)
    counts = histogram.groupBy("source").agg(F.sum("n").alias("rows"))
    per_source = solved.join(counts.withColumnRenamed("source", "_s"), _same("source", "_s")).select(
        F.col("source").alias("_source"), "mean", "lam", F.ceil(F.col("rows") / BUCKET_ROWS).alias("buckets")
    )
    lam, x = F.col("lam"), F.col("size") / F.col("mean")
    tilted = F.least(F.lit(float(cap)), F.exp(F.least(lam * x, F.lit(700.0))))
    rate = F.when(lam == math.inf, float(cap)).when(lam == -math.inf, 0.0).when(F.col("size") == 0, 1.0).otherwise(tilted)
    # Every unit has its source there; of a left join only the sources may be broadcast.
    rated = units.join(per_source, _same("source", "_source"), "left").select(
        "doc_id",
        "source",
        "size",
        "n",
        (F.col("n") * F.col("size")).alias("words"),
        rate.alias("rate"),
        F.expr("pmod(xxhash64(doc_id, size), buckets)").alias("bucket"),
    )
    schema = sized.select("doc_id", "source", "size").schema.add("n", "long").add("copies", "long")
    return rated.groupBy("source", "bucket").applyInPandas(lambda key, pdf: _whole(key, pdf, cap), schema)


def _sized(docs):
    return docs.select("doc_id", "source", word_count("text").alias("size"))


def plan_mix(docs, weights=(5, 2, 1), share=1.5, cap=2):
    """Per document what the mix takes: doc_id, size, source_size, target, taken, copies; one row for each of `docs`.

    `docs` needs doc_id, text and source; further columns are ignored. Sizes are words, 0 for a null or empty text. A
    null source is a source of its own, the last. Rows that repeat may differ by one copy, so that they too meet the
    target. An empty table gives no rows.
    """
    sized = write_and_read(_sized(docs), "mix-sized")
    targets, units = _plan(sized, weights, share, cap)
    named = targets.withColumnRenamed("source", "_source")
    more = F.col("copies") % F.col("n")
    copies = F.floor(F.col("copies") / F.col("n")) + (F.col("_row") <= more).cast("long")
    return (
        units.join(named, _same("source", "_source"))
        .withColumn("_row", F.explode(F.expr("sequence(1L, n)")))
        .withColumn("copies", copies)
        .select("doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
    )


def _plan(sized, weights, share, cap):
    """Targets by source, and the copies of each kind of row."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = write_and_read(totals, "mix-totals")
    whole = totals.agg(F.sum("source_size")).first()[0] or 0
    targets = source_targets(totals, whole * share, weights, cap)
    return targets, copies(sized, targets, cap)


def mix(docs, weights=(5, 2, 1), share=1.5, cap=2):
    """The mix itself: the rows of `docs` with all their columns, each as often as it is taken (see `plan_mix`).

    Where rows that agree in doc_id, source and size cannot all get the same, those that come first by a hash of their
    columns get one copy more; such rows are numbered by range, so that very many of them are no task of their own.
    """
    columns = docs.columns
    sized = docs.withColumn("_mix_size", word_count("text"))
    _, units = _plan(write_and_read(_sized(docs), "mix-sized"), weights, share, cap)
    units = units.select(
        F.col("doc_id").alias("_mix_id"),
        F.col("source").alias("_mix_source"),
        F.col("size").alias("_mix_words"),
        F.floor(F.col("copies") / F.col("n")).alias("_mix_copies"),
        (F.col("copies") % F.col("n")).alias("_mix_more"),
    )
    units = write_and_read(units.where("_mix_copies + _mix_more > 0"), "mix-units")
    on = _same("doc_id", "_mix_id") & _same("source", "_mix_source") & (F.col("_mix_size") == F.col("_mix_words"))
    even = dealt_join(sized, units.where("_mix_more = 0"), on).select(*_quoted(columns), "_mix_copies")
    uneven = units.where("_mix_more > 0")
    taken = even
    if not uneven.isEmpty():
        unit = ["_mix_id", "_mix_source", "_mix_words"]
        some = sized.join(F.broadcast(uneven), on) if fits(uneven) else dealt_join(sized, uneven, on)
        rest = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))])
        some = global_row_index(some, [*map(F.col, unit), rest], "_mix_place")
        first = some.groupBy(*unit).agg(F.min("_mix_place").alias("_mix_first"))
        first = first.select(*[F.col(c).alias(c + "_") for c in unit], "_mix_first")
        some = some.join(first, _same(unit[0], unit[0] + "_") & _same(unit[1], unit[1] + "_") & _same(unit[2], unit[2] + "_"))
        extra = (F.col("_mix_place") - F.col("_mix_first") < F.col("_mix_more")).cast("long")
        taken = even.unionByName(some.select(*_quoted(columns), (F.col("_mix_copies") + extra).alias("_mix_copies")))
    return taken.where("_mix_copies > 0").withColumn("_mix_row", F.explode(F.expr("sequence(1L, _mix_copies)"))).select(*_quoted(columns))


def _quoted(columns):
    return [F.col(f"`{c}`") for c in columns]
