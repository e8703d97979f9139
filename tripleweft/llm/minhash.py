"""Near-duplicate documents: an inverted join of MinHash signatures by coordinate and value, confirmed on full sets.

Documents with equal shingle sets form a class; only classes are joined. Two sets with a Jaccard similarity of 0.75 agree
in 36 of 48 coordinates on average and in fewer than 24 about once in 10,000 times, so pairs that agree in 24 or more are
candidates. Such a pair shares at least one of the 25 rarest values of either, so those alone are posted. Within a list
agreements are counted for all pairs at once, and pairs that an earlier list has are skipped. Lists give one edge per
class, not pairs; the connected candidates are then compared by exact intersections of their sets.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripleweft.llm.common import Groups, WordHashes, gram_hashes, split_words, whole_groups
from tripleweft.plans.components import components
from tripleweft.plans.joins import dealt_join
from tripleweft.scratch import write_and_read

WORDS, COORDINATES, AGREE = 5, 48, 24
#: Entries of a list, and shingles of a candidate group, that one task holds as a block.
LIST_BLOCK, SET_BLOCK = 2048, 2_000_000
#: Rows up to which lists are compared many at once.
SMALL = 24

_ODD = np.random.default_rng(5).integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(data, hashes):
    """Distinct 64-bit shingles of UTF-8 bytes, sorted: runs of five words, or the whole of fewer, A-Z lower-cased."""
    words = split_words(data.lower()) if data else []  # bytes.lower() changes A-Z only
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(gram_hashes(hashes.of(words), min(WORDS, len(words))))


def signature(shingles):
    """Minimum of the shingles under each of the permutations, 32 bits each."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):
        low = np.minimum(low, (shingles[start : start + 2048, None] * _ODD).min(0))
    return (low >> np.uint64(32)).astype(np.uint32)


def _digest(shingles):
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _signed(batches):
    hashes = WordHashes()
    for batch in batches:
        counts, keys, signatures = [], [], []
        for x in batch.column(1):
            s = shingle_set(x.as_py(), hashes)
            counts.append(len(s))
            keys.append(_digest(s) if len(s) else None)
            signatures.append(signature(s).view(np.int32) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.list_(pa.int32())), batch.column(2)],
            ["doc_id", "n_shingles", "key", "signature", "mark"],
        )


def _near(s, posted, coordinate, i, j):
    """Which pairs (i, j) of rows of a list are candidates that no list of an earlier coordinate has."""
    same = s[i] == s[j]
    earlier = (same & posted[i] & posted[j] & (np.arange(COORDINATES) < coordinate[i][:, None])).any(1)
    return (same.sum(1) >= AGREE) & ~earlier


def _small_lists(sizes, starts):
    """All pairs of rows within lists of at most `SMALL` rows, as two arrays."""
    left, right = [], []
    for size in range(2, SMALL + 1):
        at = starts[sizes == size]
        a, b = np.triu_indices(size, 1)
        left.append((at[:, None] + a).ravel())
        right.append((at[:, None] + b).ravel())
    return np.concatenate(left), np.concatenate(right)


def _large_list(s, posted, coordinate):
    """Root of every row of a larger list, by a search through the matrix of its pairs."""
    n = len(s)
    agree, earlier = np.zeros((n, n), np.uint8), np.zeros((n, n), bool)
    for c in range(COORDINATES):
        same = s[:, c][:, None] == s[:, c][None, :]
        agree += same
        if c < coordinate:
            earlier |= same & posted[:, c][:, None] & posted[:, c][None, :]
    near = (agree >= AGREE) & ~earlier
    root = np.full(n, -1)
    for i in range(n):
        if root[i] >= 0:
            continue
        front = np.array([i])
        root[i] = i
        while len(front):
            front = np.flatnonzero(near[front].any(0) & (root < 0))
            root[front] = i
    return root


def _list_edges(batches):
    """Edges among the candidates of each list (or pair of its blocks) that no earlier list has, one per row at most."""
    for rows, starts in whole_groups(batches, ("token", "row", "col")):
        n = rows.num_rows
        ids = rows.column("rep").to_numpy()
        s = rows.column("signature").combine_chunks().flatten().to_numpy().reshape(n, COORDINATES)
        posted = (rows.column("posted").to_numpy()[:, None] >> np.arange(COORDINATES)) & 1 == 1
        coordinate = rows.column("token").to_numpy() >> 32
        sizes = np.diff(np.append(starts, n))
        groups = Groups(n)
        left, right = _small_lists(sizes, starts)
        for k in range(0, len(left), 16_384):
            i, j = left[k : k + 16_384], right[k : k + 16_384]
            near = _near(s, posted, coordinate, i, j)
            for a, b in zip(i[near].tolist(), j[near].tolist(), strict=True):
                groups.join(a, b)
        for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
            end = start + size
            for i, root in enumerate(_large_list(s[start:end], posted[start:end], coordinate[start]).tolist()):
                groups.up[start + i] = start + root
        roots = np.array([groups.find(i) for i in range(n)])
        moved = roots != np.arange(n)
        yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[roots[moved]])], ["a", "b"])


def _candidates(classes):
    """Edges (a, b) that connect every class with the candidates of its list, and so all that may be similar."""
    tokens = classes.select("rep", F.posexplode("signature").alias("c", "v")).select(
        "rep", (F.shiftleft(F.col("c").cast("long"), 32) + F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("token")
    )
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    # What no other class has is rarest of all: it fills the prefix but needs no list.
    mine = dealt_join(tokens, shared, "token", rows=COORDINATES * classes.count()).groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("tokens"))
    mine = mine.where(F.size("tokens") >= AGREE).withColumn("tokens", F.slice("tokens", 1, F.size("tokens") - AGREE + 1))
    bit = F.aggregate("tokens", F.lit(0).cast("long"), lambda s, t: s.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(t["token"], 32).cast("int"))))
    posts = write_and_read(mine.select("rep", bit.alias("posted"), F.explode("tokens.token").alias("token")), "minhash-posts")
    sizes = posts.groupBy("token").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / LIST_BLOCK)
    lists = dealt_join(dealt_join(posts, sizes.select("token", blocks.alias("blocks")), "token", rows=posts.count()), classes.select("rep", "signature"), "rep")
    return _dealt(lists, "token").mapInArrow(_list_edges, "a long, b long")


def _dealt(rows, key):
    """Deal the rows of each key over `blocks` blocks by `rep`, and each pair of blocks to a cell (row, col), cell by cell."""
    block = F.expr("pmod(xxhash64(rep), blocks)")
    others = F.expr("CASE WHEN blocks = 1 THEN array(0L) ELSE filter(sequence(0L, blocks - 1), x -> x <> block) END")
    dealt = rows.withColumn("block", block).withColumn("other", F.explode(others))
    cells = dealt.withColumn("row", F.least("block", "other")).withColumn("col", F.greatest("block", "other")).drop("block", "other", "blocks")
    return cells.repartition(key, "row", "col").sortWithinPartitions(key, "row", "col", "rep")


def _sets(batches):
    """The full set of every class, from the text of its representative."""
    hashes = WordHashes()
    for batch in batches:
        keep, sets = [], []
        for i, (text, key) in enumerate(zip(batch.column("text"), batch.column("key"), strict=True)):
            s = shingle_set(text.as_py(), hashes)
            if _digest(s) == key.as_py():  # else another text under the same doc_id
                keep.append(i)
                sets.append(s.tobytes())
            if len(keep) >= 1024:
                yield _set_batch(batch, keep, sets)
                keep, sets = [], []
        if keep:
            yield _set_batch(batch, keep, sets)


def _set_batch(batch, keep, sets):
    return pa.RecordBatch.from_arrays([batch.column("rep").take(pa.array(keep)), batch.column("group").take(pa.array(keep)), pa.array(sets, pa.binary())], ["rep", "group", "shingles"])


def _links(batches, threshold):
    """Edges that connect what is similar, cell by cell."""
    for rows, starts in whole_groups(batches, ("group", "row", "col")):
        ids = rows.column("rep").to_numpy()
        sets = rows.column("shingles").combine_chunks()
        edges = []
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), rows.num_rows], strict=True):
            held = {(int(i), b.as_py()): None for i, b in zip(ids[start:end], sets.slice(start, end - start), strict=True)}
            edges += _similar(np.array([i for i, _ in held]), [np.frombuffer(b, np.uint64) for _, b in held], threshold)
        if edges:
            a, b = zip(*edges, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _similar(ids, sets, threshold):
    """Edges that connect the sets of one cell by exact intersections; ids come in ascending order.

    A few central sets are compared with all; what they link is one component. Each set outside of it is then compared
    with all, so any link that could join two components is seen.
    """
    numerator, denominator = threshold
    n, sizes = len(ids), np.array([len(s) for s in sets])
    if n == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        linked = denominator * common >= numerator * (sizes.sum() - common)
        return [(int(ids[1]), int(ids[0]))] if linked and ids[0] != ids[1] else []
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(token, kind="stable")
    docs, counts = owner[order], np.bincount(token)
    starts, first = np.cumsum(counts) - counts, np.cumsum(sizes) - sizes

    def linked(i):
        mine = token[first[i] : first[i] + sizes[i]]
        length = counts[mine]
        at = np.repeat(starts[mine] - np.cumsum(length) + length, length) + np.arange(length.sum())
        common = np.bincount(docs[at], minlength=n)
        return np.flatnonzero(denominator * common >= numerator * (sizes[i] + sizes - common))

    groups = Groups(n)
    for i in np.flatnonzero(ids[1:] == ids[:-1]).tolist():
        groups.join(i, i + 1)
    seen, core = np.zeros(n, bool), np.zeros(n, bool)
    centre = np.add.reduceat(counts[token], first) / sizes
    for _ in range(min(n, 16)):
        open_ = core & ~seen if core.any() else ~seen
        if not open_.any():
            break
        i = int(np.flatnonzero(open_)[np.argmax(centre[open_])])
        seen[i] = True
        near = linked(i)
        core[near] = True
        core[i] = True
        for j in near.tolist():
            groups.join(i, j)
    for i in np.flatnonzero(~core & ~seen).tolist():
        for j in linked(i).tolist():
            groups.join(i, j)
    roots = [groups.find(i) for i in range(n)]
    return [(int(ids[i]), int(ids[r])) for i, r in enumerate(roots) if r != i]


def _labelled(docs, threshold):
    """Rows (doc_id, n_shingles, component_id, mark, group), one per row of `docs`.

    Classes have numbers of their own, as one doc_id may stand for several; `component_id` is the smallest doc_id of the
    `group`. `mark` tells texts apart.
    """
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), _mark("text").alias("mark"))
    kind = dict(docs.dtypes)["doc_id"]
    signed = write_and_read(rows.mapInArrow(_signed, f"doc_id {kind}, n_shingles bigint, key binary, signature array<int>, mark string"), "minhash-signed")
    classes = signed.where("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").cast("long").alias("least"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n"))
    classes = write_and_read(classes.withColumn("rep", F.monotonically_increasing_id()), "minhash-classes")
    near = components(_candidates(classes.select("rep", "signature")), "group")
    near = write_and_read(near.withColumnRenamed("node", "rep"), "minhash-groups")
    members = dealt_join(classes, near, "rep").select("rep", "least", "key", "group", "n")
    blocks = members.groupBy("group").agg(F.ceil(F.sum("n") / SET_BLOCK).alias("blocks"))
    texts = dealt_join(rows, members, F.col("doc_id") == F.col("least")).select("rep", "key", "group", "text")
    sets = texts.mapInArrow(_sets, "rep long, group long, shingles binary").join(blocks, "group")
    links = _dealt(sets, "group").mapInArrow(lambda batches: _links(batches, threshold), "a long, b long")
    found = write_and_read(dealt_join(classes.select("rep", "key", "least"), components(links).withColumnRenamed("node", "rep"), "rep", "left"), "minhash-labels")
    found = found.withColumn("group", F.coalesce("component", "rep"))
    named = found.where("component IS NOT NULL").groupBy("group").agg(F.min("least").alias("first"))
    labels = found.join(named, "group", "left").select(F.col("key").alias("_key"), F.coalesce("first", "least").alias("_component"), "group")
    usual = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key"), "mark").join(labels, F.col("key") == F.col("_key"), "left")
    return usual.select("doc_id", "n_shingles", F.coalesce("_component", "doc_id").cast(kind).alias("component_id"), "mark", "group")


def _mark(text):
    return F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("null"))


def near_duplicates(docs, threshold=(75, 100)):
    """Per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept.

    A document's set holds its distinct runs of five words, or its words as one run if there are fewer. Documents are
    linked if `denominator * intersection >= numerator * union`; `component_id` is the smallest doc_id reachable, `kept`
    whether it is the row's own. Documents without words or text have an empty set and link with nothing; so do rows
    without doc_id (component null, kept). Rows that repeat give equal results; different texts under one doc_id are
    documents of their own, each with its links. Further columns are ignored. No rows, no rows.
    """
    out = _labelled(docs, threshold).drop("mark", "group")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs, threshold=(75, 100)):
    """The rows of `docs`, with all columns, that stay when each group of near-duplicates keeps its smallest doc_id.

    Rows without doc_id stay. Of rows of one group that share that doc_id, or of empty ones that share any, one stays, the
    first by hashes of the text and of the other columns; rows of one doc_id that are not alike all stay.
    """
    marked = _labelled(docs, threshold).where("doc_id = component_id").groupBy(F.col("doc_id").alias("_id"), "group").agg(F.min("mark").alias("_mark"))
    named = docs.where("doc_id IS NOT NULL").withColumn("_text", _mark("text"))
    kept = dealt_join(named, marked.select("_id", "_mark"), (F.col("doc_id") == F.col("_id")) & (F.col("_text") == F.col("_mark")))
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    # What is left of repeats has one text; the window takes the rows as the join has dealt them.
    order = Window.partitionBy("doc_id", "_text").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(0))
    one = kept.withColumn("_place", F.row_number().over(order)).where("_place = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
    return one.unionByName(docs.where("doc_id IS NULL"))
