"""Approximate nearest neighbours by p-stable hashing with several probes per table."""

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tripleweft.llm.vectors import matrix, one_width, usable
from tripleweft.scratch import write_and_read

#: Rows of a block, whose tables one task holds.
BLOCK_ROWS = 16_384
#: Rows that the width of the buckets is fitted on.
SAMPLE_ROWS = 2_000


class Hashing:
    """`tables` hash tables of `depth` projections each, and the probes of a query in the order of their promise."""

    def __init__(self, width, scale, tables, depth, probes, seed=17):
        rng = np.random.default_rng(seed)
        self.tables, self.depth, self.probes, self.scale = tables, depth, probes, scale
        self.axes = rng.standard_normal((width, tables * depth))
        self.shift = rng.uniform(0, scale, tables * depth)
        self.odd = rng.integers(0, 2**62, (tables, depth), dtype=np.int64) * 2 + 1
        self.sets = self._likely_sets(2 * probes)

    def _likely_sets(self, most):
        """Sets of perturbations, as places in the order of distance, by the score they have on average.

        The j-th nearest of 2 * depth borders has an expected squared distance, which depends on the depth alone; sets
        grow from the smallest by moving their last place on or by adding the next. A set with both borders of one
        projection (places j and 2 * depth - 1 - j) is no bucket.
        """
        m = self.depth
        j = np.arange(1, m + 1)
        low = j * (j + 1) / (4 * (m + 1) * (m + 2))
        k = np.arange(m + 1, 2 * m + 1)
        high = 1 - (2 * m + 1 - k) / (m + 1) + (2 * m + 1 - k) * (2 * m + 2 - k) / (4 * (m + 1) * (m + 2))
        score = np.concatenate([low, high])
        out, heap = [()], [(score[0], (0,))]
        while heap and len(out) < most:
            value, places = heapq.heappop(heap)
            if all(2 * m - 1 - p not in places for p in places):
                out.append(places)
            last = places[-1]
            if last + 1 < 2 * m:
                heapq.heappush(heap, (value - score[last] + score[last + 1], (*places[:-1], last + 1)))
                heapq.heappush(heap, (value + score[last + 1], (*places, last + 1)))
        return out

    def _cells(self, x):
        at = (x @ self.axes + self.shift) / self.scale
        cell = np.floor(at)
        return cell.astype(np.int64).reshape(len(x), self.tables, self.depth), (at - cell).reshape(len(x), self.tables, self.depth)

    def keys(self, x):
        """Bucket of every row in every table."""
        return (self._cells(x)[0] * self.odd).sum(2)

    def probe_keys(self, x):
        """Tables and buckets to visit for every row, most likely first: home buckets, then perturbed ones."""
        cell, inside = self._cells(x)
        home = (cell * self.odd).sum(2)
        cost = np.concatenate([inside**2, (1 - inside) ** 2], axis=2)
        step = np.concatenate([-self.odd, self.odd], axis=1)
        order = np.argsort(cost, axis=2, kind="stable")
        ranked = np.take_along_axis(cost, order, 2)
        moves = np.take_along_axis(np.broadcast_to(step, cost.shape), order, 2)
        keys = np.stack([home + (moves[:, :, list(s)].sum(2) if s else 0) for s in self.sets], axis=2)
        scores = np.stack([ranked[:, :, list(s)].sum(2) if s else np.zeros(home.shape) for s in self.sets], axis=2)
        flat = np.argsort(scores.reshape(len(x), -1), axis=1, kind="stable")[:, : self.probes * self.tables]
        return flat // len(self.sets), np.take_along_axis(keys.reshape(len(x), -1), flat, 1)


def _power(biggest):
    """A power of two to scale by where squares would overflow, which changes no digit; else 1."""
    return 2.0 ** math.floor(math.log2(biggest)) if biggest > 1e140 else 1.0


class Block:
    """Hash tables over the vectors of one block, and exact distances to the candidates of a query."""

    def __init__(self, ids, x, hashing):
        self.ids, self.x, self.hashing = ids, x, hashing
        self.biggest = float(np.abs(x).max(initial=0.0))
        keys = hashing.keys(x)
        self.order = [np.argsort(keys[:, t], kind="stable") for t in range(hashing.tables)]
        self.sorted = [keys[o, t] for t, o in enumerate(self.order)]

    def candidates(self, tables, keys):
        """Rows in the visited buckets, each once."""
        seen = np.zeros(len(self.ids), bool)
        for t in range(self.hashing.tables):
            mine = keys[tables == t]
            low, high = np.searchsorted(self.sorted[t], mine, "left"), np.searchsorted(self.sorted[t], mine, "right")
            for a, b in zip(low[high > low].tolist(), high[high > low].tolist(), strict=True):
                seen[self.order[t][a:b]] = True
        return np.flatnonzero(seen)

    def nearest(self, query, tables, keys, k, own):
        """The k nearest candidates other than `own`; where buckets hold too few, all rows of the block are candidates."""
        rows = self.candidates(tables, keys)
        rows = rows[self.ids[rows] != own]
        if len(rows) < k:
            rows = np.flatnonzero(self.ids != own)
        scale = _power(max(self.biggest, float(np.abs(query).max(initial=0.0))))
        gap = self.x[rows] - query if scale == 1 else self.x[rows] / scale - query / scale
        distance = np.sqrt(np.einsum("ij,ij->i", gap, gap)) * scale
        best = np.lexsort((self.ids[rows], distance))[:k]
        return self.ids[rows][best], distance[best]


def _search(batches, hashing, k):
    """One block after the other: its rows come first, then the queries, which stream by."""
    block, ids, xs, built = None, [], [], None
    for pdf in batches:
        for key, part in pdf.groupby("block", sort=False):
            if key != block:
                block, ids, xs, built = key, [], [], None
            rows, queries = part[part["query"] == 0], part[part["query"] == 1]
            if len(rows):
                ids.append(rows["vec_id"].to_numpy(np.int64))
                xs.append(matrix(rows["embedding"]))
            if not len(queries) or not ids:
                continue
            if built is None:
                built = Block(np.concatenate(ids), np.concatenate(xs), hashing)
            q = matrix(queries["embedding"])
            out = []
            for start in range(0, len(q), 64):
                tables, keys = hashing.probe_keys(q[start : start + 64])
                for i, own in enumerate(queries["vec_id"].to_numpy(np.int64)[start : start + 64].tolist()):
                    found, distance = built.nearest(q[start + i], tables[i], keys[i], k, own)
                    out.append(pd.DataFrame({"query_id": own, "vec_id": found, "score": distance}))
            yield pd.concat(out, ignore_index=True)


def _width_of_buckets(vectors, n, share):
    """A bucket width from a bounded sample: `share` times the typical length of a vector's projection."""
    step = max(1, math.ceil(n / SAMPLE_ROWS))
    sample = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(step)) == 0).limit(2 * SAMPLE_ROWS).select("embedding").collect()
    x = matrix([r[0] for r in sample]) if sample else np.ones((1, 1))
    return share * float(np.sqrt(((x - x.mean(0)) ** 2).sum(1).mean())) or 1.0


def nearest(vectors, queries, k=10, tables=24, depth=8, probes=120, share=1.5):
    """The `k` nearest rows of `vectors` that are found for each row of `queries`, by Euclidean distance.

    Both have vec_id and embedding. Returns query_id, rank (from 1), vec_id and score, the distance in double precision;
    ties go to the smaller vec_id, a query's own vec_id is no candidate. Vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do rows without vec_id; rows that repeat a vec_id count once (the one with
    the smallest vector). Usable vectors of different widths raise an error. Fewer than `k` candidates: all of them.

    Rows are dealt by a hash of vec_id over blocks of `BLOCK_ROWS`. A task holds one block's tables; the queries stream
    past it in batches, so neither side has to fit into memory, and it gives back `k` rows per query, never candidates.
    """
    good = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    one = lambda df: df.where(good).select("vec_id", "embedding").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    rows = write_and_read(one(vectors), "ann-rows")
    asked = one(queries)
    n = rows.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return rows.sparkSession.createDataFrame([], schema)
    hashing = Hashing(one_width(rows), _width_of_buckets(rows, n, share), tables, depth, probes)
    blocks = math.ceil(n / BLOCK_ROWS)
    block = F.expr(f"pmod(xxhash64(vec_id), {blocks})")
    sides = rows.select(block.alias("block"), F.lit(0).alias("query"), "vec_id", "embedding").unionByName(
        asked.select(F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"), F.lit(1).alias("query"), "vec_id", "embedding")
    )
    dealt = sides.repartition(blocks, "block").sortWithinPartitions("block", "query")
    found = dealt.mapInPandas(lambda b: _search(b, hashing, k), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("place", "b")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score")
    )
