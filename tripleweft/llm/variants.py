"""Spelling variants: words that differ by one letter, found by grams of variable length.

A gram that many words hold is too frequent to tell them apart, and is read one letter further; a dictionary of the
frequent grams says which. Each place of a word has one gram. An edit can only change the grams that read the place of the
edit, and at least all others are shared by both words: this bounds from below how many grams two near words share. A word
is posted under the rarest of its grams, one more than an edit can change, so two near words meet in a list. Within a list
common grams are counted, and pairs that reach the bound are compared letter by letter.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tripleweft.llm.common import whole_groups
from tripleweft.plans.joins import checked_join
from tripleweft.scratch import Steps, result_alone, write_and_read

# Letters of the contract.
RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lengths of grams; words need as many letters as both together, so that an edit cannot change all grams.
SHORT, LONG = 2, 4
#: Frequent grams of a length at most; and the number of places that makes a gram frequent, where that allows it.
MOST_GRAMS, FREQUENT = 50_000, 64
#: Words of a list that are compared at once; longer lists go as pairs of blocks.
BLOCK_ROWS = 2048
#: Columns in which the grams of a list are counted.
_COLUMNS = 256


def count_runs(docs, letters, times, slip=None):
    """Words of at least `letters` letters that occur at least `times` times in all texts of `docs`: (word, n).

    Words are runs of letters with A to Z lower-cased. With `slip`, a word loses the letter h mod its length wherever
    `slip` divides h, the CRC of `<doc_id>:<word>`, except in rows without doc_id.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= letters).select("doc_id", F.translate("run", _UPPER, _LOWER).alias("word"))
    if slip:
        h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")))
        at = (h % F.length("word")).cast("int")
        slipped = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        runs = runs.select(F.when(h % slip == 0, slipped).otherwise(F.col("word")).alias("word")).where(F.length("word") >= letters)
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= times)


def _frequent(words):
    """Grams that are read further, or are posted last, with the number of places they have."""
    places = words.agg(F.sum(F.length("word"))).first()[0] or 0
    least = max(FREQUENT, math.ceil(places / MOST_GRAMS))
    grams = F.flatten(F.array(*[F.transform(F.sequence(F.lit(1), F.length("word") - q + 1), lambda p, q=q: F.substring("word", p, F.lit(q))) for q in range(SHORT, LONG + 1)]))
    counts = words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # Each length has at most MOST_GRAMS grams with that many places.
    return {r["gram"]: r["n"] for r in counts.where(F.col("n") >= least).collect()}


def decompose(word, frequent):
    """The gram at each place of a word, and how many of them one edit can change at most."""
    size, grams, changed = len(word), [], [0] * (len(word) + 2)
    for p in range(size - SHORT + 1):
        end = p + SHORT
        while end < p + LONG and word[p:end] in frequent:
            if end == size:
                end += 1  # it has read the end of the word
                break
            end += 1
        grams.append(word[p:end])
        changed[p] += 1
        changed[end] -= 1
    return grams, int(np.cumsum(changed).max())


def _post(words, frequent):
    """Rows (key, guest, word, n, bound, grams): a word in the lists of its rarest grams, for its length and the next."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        known = shared.value
        for batch in batches:
            out = [[] for _ in range(6)]
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                grams, changed = decompose(word, known)
                bound = len(grams) - changed
                packed = b"".join(xxhash.xxh32_digest(g) for g in grams)
                rarest = sorted(grams, key=lambda g: (known.get(g, 0), g))[: changed + 1]
                for gram in set(rarest):
                    for guest in (0, 1):
                        key = xxhash.xxh3_64_intdigest(f"{len(word) + guest}:{gram}") - (1 << 63)
                        for column, value in zip(out, (key, guest, word, n, bound, packed), strict=True):
                            column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["key", "guest", "word", "n", "bound", "grams"])

    return words.select("word", "n").mapInArrow(run, "key bigint, guest int, word string, n bigint, bound int, grams binary")


def _cells(posts):
    """Posts with the pair of blocks (row, col) they are compared in; lists of up to `BLOCK_ROWS` words are one block."""
    sizes = posts.groupBy("key").agg(F.count(F.lit(1)).alias("_size"), F.sum(1 - F.col("guest")).alias("_own"))
    # A list without words of its own has no pairs; nor has one with a single word.
    idle = (F.col("_own") == 0) | (F.col("_size") == 1)
    sizes = sizes.select("key", F.when(idle, 0).otherwise(F.ceil(F.col("_size") / BLOCK_ROWS)).cast("int").alias("_blocks"))
    sizes = sizes.where("_blocks <> 1")
    blocks = F.coalesce("_blocks", F.lit(1))
    dealt = checked_join(posts, sizes, ["key"], how="left", write_right=True).where(blocks > 0)
    dealt = dealt.withColumn("_block", F.pmod(F.xxhash64("word"), blocks).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.select(
        "key",
        F.least("_block", "_other").alias("row"),
        F.greatest("_block", "_other").alias("col"),
        (F.col("_block") > F.col("_other")).cast("int").alias("side"),
        "guest",
        "word",
        "n",
        "bound",
        "grams",
    )


def _counts(grams):
    """Matrix of how often each gram occurs in each word, by hash; several grams may share a column."""
    sizes = np.fromiter(map(len, grams), np.int64, len(grams)) // 4
    column = np.frombuffer(b"".join(grams), np.uint32) % _COLUMNS
    out = np.zeros(len(grams) * _COLUMNS, np.float32)
    np.add.at(out, np.repeat(np.arange(len(grams)), sizes) * _COLUMNS + column, 1)
    return out.reshape(len(grams), _COLUMNS)


def _codes(words, size):
    return np.array(words, f"<U{size}").view(np.uint32).reshape(len(words), size)


def one_edit(short, long):
    """Of rows of code points, the pairs that differ by one: equal lengths, or one letter more in `long`."""
    width = short.shape[1]
    if width == long.shape[1]:
        return (short != long).sum(1) == 1
    ahead = np.logical_and.accumulate(short == long[:, :width], axis=1).sum(1)
    back = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return ahead + back >= width


def _compare(rows):
    """Pairs (i, j) of near words of one cell: j has as many letters as the list is for, i as many or one less."""
    side, guest, bound = rows["side"], rows["guest"], rows["bound"]
    own = np.flatnonzero(guest == 0)
    if not len(own) or len(side) < 2:
        return []
    size = len(rows["word"][own[0]])
    both = side.any() and not side.all()
    if rows["apart"] and not both:
        return []
    counts = _counts(rows["grams"])
    found = []
    for part in (own, np.flatnonzero(guest)):
        if not len(part):
            continue
        common = counts[part] @ counts[own].T
        near = common >= np.maximum(bound[part][:, None], bound[own][None, :])
        if rows["apart"]:
            near &= side[part][:, None] != side[own][None, :]
        if part is own:
            near &= part[:, None] < own[None, :]
        i, j = np.nonzero(near)
        if not len(i):
            continue
        i, j = part[i], own[j]
        words = rows["word"]
        width = size - int(part is not own)
        good = one_edit(_codes([words[k] for k in i], width), _codes([words[k] for k in j], size))
        found += zip(i[good].tolist(), j[good].tolist(), strict=True)
    return found


def near_pairs(words):
    """Rows (word, near, n), both ways: near words and how often `near` occurs. `words` (word, n) are distinct, and read twice."""
    posts = write_and_read(_post(words, _frequent(words)), "variant-posts")
    cells = _cells(posts).repartition("key", "row", "col").sortWithinPartitions("key", "row", "col")

    def run(batches):
        for rows, starts in whole_groups(batches, ["key", "row", "col"]):
            ends = [*starts[1:].tolist(), rows.num_rows]
            number = {c: rows.column(c).to_numpy() for c in ("row", "col", "side", "guest", "bound", "n")}
            text, grams = rows.column("word").to_pylist(), rows.column("grams").to_pylist()
            out = [], [], []
            for a, b in zip(starts.tolist(), ends, strict=True):
                if b - a < 2:
                    continue
                cell = {c: number[c][a:b] for c in ("side", "guest", "bound")}
                cell |= {"word": text[a:b], "grams": grams[a:b], "apart": number["row"][a] != number["col"][a]}
                for i, j in _compare(cell):
                    for p, q in ((a + i, a + j), (a + j, a + i)):
                        out[0].append(text[p])
                        out[1].append(text[q])
                        out[2].append(int(number["n"][q]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.string(), pa.string(), pa.int64()), strict=True)], ["word", "near", "n"])

    return cells.mapInArrow(run, "word string, near string, n bigint").distinct()


def group_variants(words, ratio=5):
    """Per row of `words` (word, n): word, n, n_near, form, form_n, root.

    Words are near if they differ by one inserted, deleted or replaced code point; `n_near` counts near words. `form` is
    the near word with the largest n, of equal ones the smallest, if its n is at least `ratio` times the word's; `root` is
    the word that forms lead to in the end, the word itself if it has none. Every near pair is found. Words are distinct
    and at least as long as the shortest and the longest gram together; others raise an error, as do nulls. Further columns
    are ignored. No rows, no rows. The result is written to the shared folder, and all that was written on the way deleted.
    """
    return result_alone(words.sparkSession, lambda: _grouped(words, ratio), "variants")


def _grouped(words, ratio):
    kept = write_and_read(words.select("word", "n"), "variant-words")
    if not kept.where(F.col("word").isNull() | F.col("n").isNull() | (F.length("word") < SHORT + LONG)).isEmpty():
        raise ValueError(f"words need {SHORT + LONG} letters and a number")
    best = near_pairs(kept).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("best"))
    found = kept.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "best.near", (-F.col("best.less")).alias("near_n"))
    fits = F.col("near_n") >= ratio * F.col("n")
    found = write_and_read(found.select("word", "n", "n_near", F.when(fits, F.col("near")).alias("form"), F.when(fits, F.col("near_n")).alias("form_n")), "variant-forms")
    # A form occurs more often than its word, so there are no circles; each round doubles the steps.
    links = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    steps = Steps("variant-roots")
    links = steps.write(links)
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links = links.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        links = steps.write(links)
        if links.where("_moved").isEmpty():
            break
        links = links.drop("_moved")
    return found.join(links.select("word", "root"), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
