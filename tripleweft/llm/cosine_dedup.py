"""Near-duplicate vectors by cosine: tiles in the order of the first principal component, few dimensions first."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tripleweft.llm.common import Groups, mixed
from tripleweft.llm.vectors import matrix, one_width, unit, usable
from tripleweft.plans.components import components
from tripleweft.plans.once import evaluate_once
from tripleweft.scratch import write_and_read

#: Distinct vectors of a block; two blocks are in a task's memory at once.
BLOCK_ROWS = 8192
#: Ranges of the first component at most, which bounds what the driver holds; rows beyond go to further parts of a range.
MOST_CUTS = 100_000
#: Rows that the rotation is fitted on; it changes the work, never the result.
SAMPLE_ROWS = 20_000
#: Dimensions after which pairs are given up, as shares of all.
STAGES = (0.25, 0.5, 1.0)
_STRIP, _SLACK = 512, 1e-9


def _rotation(vectors, n, width):
    """Principal axes of a bounded sample of the rows, as columns, largest variance first."""
    step = max(1, math.ceil(n / SAMPLE_ROWS))
    sample = vectors.where(F.pmod(F.xxhash64("embedding"), F.lit(step)) == 0).limit(2 * SAMPLE_ROWS).select("embedding").collect()
    if len(sample) < 2:
        return np.eye(width)
    x = unit(matrix([r[0] for r in sample]))
    return np.ascontiguousarray(np.linalg.eigh(np.cov(x.T))[1][:, ::-1]) if width > 1 else np.eye(1)


def _linked(a, b, threshold, triangle):
    """Pairs (i, j) of unit rows, in the rotated order of dimensions, whose cosine may reach the threshold.

    Products are summed over leading dimensions; what the others can add is at most the product of the suffix norms.
    """
    width = a.shape[1]
    cuts = sorted({max(1, round(s * width)) for s in STAGES} | {width})
    first = cuts[0]
    left_a, left_b = np.sqrt(np.maximum(0, 1 - (a[:, :first] ** 2).sum(1))), np.sqrt(np.maximum(0, 1 - (b[:, :first] ** 2).sum(1)))
    for start in range(0, len(a), _STRIP):
        rows = slice(start, min(start + _STRIP, len(a)))
        low = start if triangle else 0
        part = a[rows, :first] @ b[low:, :first].T
        i, j = np.nonzero(part + left_a[rows, None] * left_b[None, low:] >= threshold - _SLACK)
        value = part[i, j]
        i, j = i + start, j + low
        if triangle:
            keep = i < j
            i, j, value = i[keep], j[keep], value[keep]
        done = first
        for cut in cuts[1:]:
            value = value + _products(a, b, i, j, done, cut)
            done = cut
            rest_a, rest_b = np.sqrt(np.maximum(0, (a[:, cut:] ** 2).sum(1))), np.sqrt(np.maximum(0, (b[:, cut:] ** 2).sum(1)))
            keep = value + rest_a[i] * rest_b[j] >= threshold - _SLACK
            i, j, value = i[keep], j[keep], value[keep]
        yield i, j


def _products(a, b, i, j, start, end):
    """Partial products of pairs of rows, in pieces of bounded size."""
    out = np.empty(len(i))
    for k in range(0, len(i), 65_536):
        out[k : k + 65_536] = np.einsum("ij,ij->i", a[i[k : k + 65_536], start:end], b[j[k : k + 65_536], start:end])
    return out


def _cell(key, pdf, rotation, threshold):
    """Links within one pair of blocks: per vector the copies it is linked to, and the smallest of its set here."""
    first, second = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
    same = key[0] == key[1]  # an empty second block has no pairs
    second = first if same else second
    x = matrix(first["embedding"]) if len(first) else np.zeros((0, len(rotation)))
    y = x if same else matrix(second["embedding"])
    if not len(x) or not len(y):
        return pd.DataFrame({"rep": [], "links": [], "root": []}, dtype="int64")
    ux, uy = unit(x), unit(y)
    ids = np.concatenate([first["rep"].to_numpy(), second["rep"].to_numpy()[: 0 if same else None]])
    weight = np.concatenate([first["n"].to_numpy(), second["n"].to_numpy()[: 0 if same else None]])
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    shift = 0 if same else len(x)
    links, sets = np.zeros(len(ids), np.int64), Groups(len(ids))
    for i, j in _linked(ux @ rotation, uy @ rotation, threshold, same):
        exact = _products(ux, uy, i, j, 0, ux.shape[1]) >= threshold
        i, j = i[exact], j[exact] + shift
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        known = -1
        for p, q in zip(place[i].tolist(), place[j].tolist(), strict=True):
            # Most links of a dense group join what is joined already; a look at the parents tells.
            if sets.up[p] != sets.up[q] or sets.up[p] == known:
                sets.join(p, q)
    touched = np.flatnonzero(links)
    roots = np.array([ids[order[sets.find(p)]] for p in place[touched].tolist()], np.int64)
    return pd.DataFrame({"rep": ids[touched], "links": links[touched], "root": roots})


class _Blocks:
    """Ranges of `lead`, cut into parts where they hold more rows than a block, and the parts near to each.

    Everything here is linear in the number of blocks: five numbers for each `BLOCK_ROWS` distinct vectors.
    """

    def __init__(self, cuts, reach):
        self.cuts = np.unique(np.array(cuts, np.float64))
        bounds = np.concatenate([[-1.0], self.cuts, [1.0]])
        # Ranges that are near enough to one another follow one another.
        self.low = np.searchsorted(bounds[1:], bounds[:-1] - reach, "left")
        self.high = np.searchsorted(bounds[:-1], bounds[1:] + reach, "right") - 1
        self.parts = self.first = None

    def range_of(self, lead):
        return np.searchsorted(self.cuts, lead, "right")

    def cut(self, sizes):
        """Cut ranges by their numbers of rows; rows of one value of `lead` may be more than a block."""
        counts = np.array([sizes.get(k, 0) for k in range(len(self.cuts) + 1)], np.int64)
        self.parts = np.maximum(1, -(-counts // BLOCK_ROWS))
        self.first = np.concatenate([[0], np.cumsum(self.parts)])

    def place(self, lead, ids):
        """The part of each row, and the first and last of the parts that it is compared with."""
        k = self.range_of(lead)
        part = self.first[k] + mixed(ids.astype(np.uint64)).astype(np.int64) % self.parts[k]
        return part, self.first[self.low[k]], self.first[self.high[k] + 1] - 1


def _directions(rows):
    """(vec_id, direction): each vector over its largest component, in double precision; null if it takes no part."""
    fine = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    biggest = F.when(fine, F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double")))))
    sized = evaluate_once(rows, biggest.alias("_big"), keep=("vec_id", "embedding"))
    return sized.select("vec_id", F.when(F.col("_big").isNotNull(), F.transform("embedding", lambda x: x.cast("double") / F.col("_big"))).alias("direction"))


def link_vectors(vectors, threshold=0.95):
    """Per row of `vectors` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Two vectors are linked if their cosine, in double precision, is at least the threshold; every pair is compared or
    ruled out by a bound, so no link is missing. `n_links` counts the other vectors linked directly, `component_id` is
    the smallest vec_id reachable, `kept` whether it is its own. Vectors that are null, empty or zero, or hold null or
    non-finite components, link with nothing, and so do rows without vec_id (component null, kept). Rows that repeat
    both columns are one vector and give equal rows. Rows that share a vec_id and not the direction are vectors of their
    own, each with its links. Usable vectors of different widths raise an error. Further columns are ignored. No rows, no
    rows.

    Vectors of one direction are grouped first and compared once. Blocks of the distinct ones are ranges of the first
    principal component; each pair of blocks whose ranges are near enough is a task, and a range with more rows than a
    block, which may share one value, is several blocks. Tasks give counts and one edge per vector, no pairs, so a dense
    group costs no more rows than a sparse one.
    """
    rows = vectors.select("vec_id", "embedding")
    directed = _directions(rows)
    classes = directed.where("direction IS NOT NULL").groupBy("direction").agg(F.min("vec_id").alias("least"), F.count_distinct("vec_id").alias("n"))
    # The number is part of what is written, so it stays what it is.
    classes = write_and_read(classes.withColumn("rep", F.monotonically_increasing_id()), "cosine-classes")
    n = classes.count()
    if not n:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    rotation = _rotation(classes.withColumnRenamed("direction", "embedding"), n, one_width(classes.withColumnRenamed("direction", "embedding")))
    axis = rotation[:, 0]

    @F.pandas_udf("double")
    def lead(directions: pd.Series) -> pd.Series:
        return pd.Series(unit(matrix(directions)) @ axis)

    placed = write_and_read(classes.withColumn("lead", lead("direction")), "cosine-placed")
    wanted = min(math.ceil(n / BLOCK_ROWS), MOST_CUTS)
    cuts = placed.agg(F.percentile_approx("lead", [k / wanted for k in range(1, wanted)], 10_000)).first()[0] if wanted > 1 else []
    blocks = _Blocks(cuts, math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6)

    @F.pandas_udf("int")
    def range_of(leads: pd.Series) -> pd.Series:
        return pd.Series(blocks.range_of(leads.to_numpy()), dtype="int32")

    blocks.cut({r["k"]: r["count"] for r in placed.select(range_of("lead").alias("k")).groupBy("k").count().collect()})
    shared = placed.sparkSession.sparkContext.broadcast(blocks)

    @F.pandas_udf("block int, low int, high int")
    def place(leads: pd.Series, ids: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(("block", "low", "high"), shared.value.place(leads.to_numpy(), ids.to_numpy()), strict=True)))

    sides = placed.select("rep", "n", F.col("direction").alias("embedding"), place("lead", "rep").alias("at"))
    sides = sides.select("rep", "n", "embedding", "at.block", F.explode(F.sequence("at.low", "at.high")).alias("other"))
    sides = sides.select(F.least("block", "other").alias("row"), F.greatest("block", "other").alias("col"), (F.col("block") > F.col("other")).cast("int").alias("side"), "rep", "n", "embedding")
    cells = sides.groupBy("row", "col").applyInPandas(lambda key, pdf: _cell(key, pdf, rotation, threshold), "rep long, links long, root long")
    cells = write_and_read(cells, "cosine-cells")
    counts = cells.groupBy("rep").agg(F.sum("links").alias("links"))
    labels = components(cells.select(F.col("rep").alias("a"), F.col("root").alias("b")).distinct()).withColumnRenamed("node", "rep")
    named = classes.select("rep", "least").join(labels, "rep").groupBy("component").agg(F.min("least").alias("_least"))
    found = classes.join(counts, "rep", "left").join(labels, "rep", "left").join(named, "component", "left")
    found = found.select(
        F.col("direction").alias("_direction"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("_links"),
        F.coalesce("_least", "least").alias("_component"),
    )
    usual = directed.join(found, F.col("direction") == F.col("_direction"), "left")
    component = F.coalesce("_component", "vec_id")
    return usual.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
