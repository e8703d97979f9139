"""Periodic runs of words, and texts without the repeats.

A run is a maximal stretch with a smallest period that fits into it at least twice. Each run holds a word of the length of
its period that is the longest Lyndon word from its start, under the order of the letters or under the reverse order. The
first phase of a grouping suffix sorter yields the lengths of these words: from the greatest group down, tokens of a group
are hung on the token before them, whose group is split by the number of tokens it takes. What is left is to extend each
such root to both sides as far as words one period apart are equal.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tripleweft.llm.common import WORD, split_words

#: Words of a run at least, whatever its period.
LEAST_WORDS = 12
#: Bytes of text whose results leave a task together.
_BYTES_OUT = 4_000_000

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def lyndon_lengths(letters, size):
    """Length of the longest Lyndon word from each place of `letters` (0..size-1); the end is smaller than any letter.

    Tokens are stretches that later steps see as one letter; at first each letter is a token. All groups above the present
    one are gone, so what precedes a row of its tokens is smaller and takes them all.
    """
    n = len(letters)
    group = [*letters, -1]  # the last entry stands for both ends
    members = [[] for _ in range(size)]
    for i, g in enumerate(letters):
        members[g].append(i)
    spans = [1] * size
    below, above = list(range(-1, size - 1)), list(range(1, size + 1))
    above.append(0)
    before, after = list(range(-1, n)), list(range(1, n + 2))
    out = [0] * n
    g = size - 1

    def split(old, times, tokens):
        """Tokens that leave group `old` form one just above it, or all of it."""
        if len(tokens) == len(members[old]):
            spans[old] += times * span
            return
        new = len(spans)
        spans.append(spans[old] + times * span)
        members.append(tokens)
        top = above[old]
        below.append(old)
        above.append(top)
        above[old] = new
        below[top] = new
        for p in tokens:
            group[p] = new

    below.append(size - 1)  # below the end of the list, index `size`
    spans.append(0)
    members.append([])
    while g >= 0:
        span, tokens = spans[g], members[g]
        if len(tokens) == 1:
            i = tokens[0]
            if group[i] == g:
                out[i] = span
                p, j = before[i], after[i]
                after[p], before[j] = j, p
                if p >= 0:
                    h = group[p]
                    if len(members[h]) == 1:
                        spans[h] += span
                    else:
                        split(h, 1, [p])
        else:
            taken = {}
            for i in tokens:
                if group[i] != g:
                    continue
                out[i] = span
                p = before[i]
                if group[p] == g:
                    continue  # came with the first of its row
                j, times = after[i], 1
                while group[j] == g:
                    j, times = after[j], times + 1
                after[p], before[j] = j, p
                if p >= 0:
                    key = (times, group[p])
                    if key in taken:
                        taken[key].append(p)
                    else:
                        taken[key] = [p]
            # More tokens are greater, and each new group goes between the old one and those made before.
            for times, h in sorted(taken, reverse=True) if len(taken) > 1 else taken:
                split(h, times, taken[times, h])
        g = below[g]
    return out


def _common(x, a, b, step, most):
    """How many values agree from the places a and b on, going by `step` (1 or -1), `most` at most."""
    done, piece = 0, 16
    while done < most:
        k = min(piece, most - done)
        if step > 0:
            same = x[a + done : a + done + k] == x[b + done : b + done + k]
        else:
            same = (x[a - done - k + 1 : a - done + 1] == x[b - done - k + 1 : b - done + 1])[::-1]
        wrong = int(same.argmin())
        if not same[wrong]:
            return done + wrong
        done, piece = done + k, piece * 4
    return most


def runs_of(letters, size, least=LEAST_WORDS):
    """Sorted (start, period, length) of all runs of `letters` with at least `least` of them."""
    n = len(letters)
    if n < max(least, 2):
        return []
    x = np.array([*letters, -1], np.int64)
    place, top, roots = np.arange(n), size - 1, []
    # The words one period apart agree at max(period, least - period) places around the root: at three or more in a row on
    # one of its sides if there are 5 of them.
    need = 3 if least >= 10 else 1
    for order in (letters, [top - c for c in letters]):
        period = np.array(lyndon_lengths(order, size), np.int64)
        other = place + period
        right = np.flatnonzero(x[other] == x[:-1])
        left = np.flatnonzero(x[other[1:] - 1] == x[: n - 1]) + 1
        for k in range(1, need):
            right = right[x[np.minimum(other[right] + k, n)] == x[right + k]]
            left = left[left > k]
            left = left[x[other[left] - 1 - k] == x[left - 1 - k]]
        found = np.union1d(right, left)
        roots.append(np.stack([period[found], found], 1))
    out, last, end = set(), 0, 0
    for p, i in sorted(map(tuple, np.concatenate(roots).tolist())):
        if p == last and i + p <= end:
            continue  # a further root of the run before
        right = _common(x, i, i + p, 1, n - i - p)
        left = _common(x, i - 1, i + p - 1, -1, i)
        length = left + p + right
        if left + right >= p:
            last, end = p, i + p + right
            if length >= least:
                out.add((i - left, p, length))
    return sorted(out)


def _numbered(words):
    """Words as numbers in the order in which they first occur, and how many there are."""
    known = {}
    return [known.setdefault(w, len(known)) for w in words], len(known)


def find_runs(docs, least=LEAST_WORDS):
    """Per row of `docs` (doc_id, text): doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    Words are parted by ASCII white space and numbered from 0. `collapsed` joins by one blank the words that are in no run,
    or only within the first period of each run that holds them. A null or empty text has no words, no runs and an empty
    `collapsed`. Whole texts are read; a task holds one text and some 50 bytes a word at a time, so very long ones need
    memory in proportion. Rows that repeat give equal rows, further columns are ignored, no rows give no rows.
    """

    def run(batches):
        rows, held = [], 0

        def emit():
            ids, counts, runs, texts = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, kind), pa.array(counts, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

        for batch in batches:
            kind = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = split_words(text.as_buffer().to_pybytes() if text.is_valid else b"")
                runs = runs_of(*_numbered(words), least)
                kept = words
                if runs:
                    gone = np.zeros(len(words) + 1, np.int64)
                    for start, period, length in runs:
                        gone[start + period] += 1
                        gone[start + length] -= 1
                    kept = [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g]
                shown = [{"start": s, "length": m, "period": p} for s, p, m in runs]
                collapsed = b" ".join(kept).decode()
                rows.append((doc_id, len(words), shown, collapsed))
                held += len(collapsed) + 50 * len(runs)
                if held > _BYTES_OUT:
                    yield emit()
                    rows, held = [], 0
            if rows:
                yield emit()
                rows, held = [], 0

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint, runs {RUNS}, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def with_planted_runs(docs):
    """(doc_id, text) in which about every tenth text ends in a periodic tail, by a checksum of its doc_id.

    With h = crc32(doc_id), g = h div 10 and n words, h mod 10 = 0 makes each word i >= a word a + (i - a) mod p, where
    a = g mod n and p = 1 + (n - a) div (3 + g mod 8). Rows without doc_id or words stay.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    tail = F.expr("transform(sequence(0, n - 1), i -> words[CAST(IF(i >= a, a + (i - a) % (1 + (n - a) div (3 + g % 8)), i) AS INT)])")
    chosen = docs.select("doc_id", "text", (F.floor(h / 10)).alias("g"), (h % 10 == 0).alias("_mine"))
    words = F.when(F.col("_mine"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    counted = chosen.withColumn("words", words).withColumn("n", F.size("words"))
    counted = counted.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    return counted.select("doc_id", F.when(F.col("n") > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))
