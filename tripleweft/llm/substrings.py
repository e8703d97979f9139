"""Passages that earlier documents hold: suffix automata of reference shards, matched against streams of documents.

What may repeat is found first, by fingerprints and in three steps that each leave less: eight-word runs that are minimal
in some window of 50 words (equal windows pick equal runs), then the windows around runs that two documents share, then
the windows that two documents share. The first document of each such window is its reference. References are dealt over
shards of bounded size; a task builds the suffix automaton of a shard, each state knowing the smallest document that holds
it, and streams the passages of other documents past it for matching statistics. Where the match is 50 words long and held
by a smaller document, the words go. A shard that very many documents refer to is built in several tasks.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tripleweft.llm.common import WordHashes, gram_hashes, mixed, split_words
from tripleweft.scratch import write_and_read

WINDOW, RUN = 50, 8
#: Reference words of a shard, and words that stream past one copy of it.
SHARD_WORDS, STREAM_WORDS = 100_000, 2_000_000


def _sliding(x, width, least):
    """Minimum (or maximum) of every `width` consecutive values, by doubling."""
    pick = np.minimum if least else np.maximum
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def _window_minima(h):
    """For every window the smallest hash of its eight-word runs, and the hashes of all runs."""
    runs = gram_hashes(h, RUN)
    return _sliding(runs, WINDOW - RUN + 1, True), runs


def anchors(h):
    """Distinct hashes of the runs that are minimal in a window."""
    if len(h) < WINDOW:
        return np.zeros(0, np.uint64)
    return np.unique(_window_minima(h)[0])


def window_hashes(h):
    """Hash of every window, from runs that cover it."""
    runs = gram_hashes(h, RUN)
    n = len(h) - WINDOW + 1
    out = np.zeros(n, np.uint64)
    for at in [*range(0, WINDOW - RUN + 1, RUN), WINDOW - RUN]:
        out = mixed(out) + runs[at : at + n]
    return mixed(out)


def _sha(words):
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _surveyed(batches):
    hashes = WordHashes()
    for batch in batches:
        counts, shas, runs = [], [], []
        for x in batch.column(2):
            words = split_words(x.as_py())
            counts.append(len(words))
            shas.append(_sha(words))
            runs.append(anchors(hashes.of(words)).view(np.int64) if len(words) >= WINDOW else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(shas), pa.array(runs, pa.list_(pa.int64()))],
            ["doc_id", "key", "n_words", "sha", "runs"],
        )


def _candidate_windows(batches):
    """Windows around shared runs: (window, doc_id), each once per document."""
    hashes = WordHashes()
    for batch in batches:
        for doc, text, runs in zip(batch.column("doc_id"), batch.column("text"), batch.column("runs"), strict=True):
            h = hashes.of(split_words(text.as_py()))
            if len(h) < WINDOW:
                continue
            least, _ = _window_minima(h)
            near = np.isin(least, np.asarray(runs.values.to_numpy(zero_copy_only=False), np.int64).view(np.uint64))
            found = np.unique(window_hashes(h)[near]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(len(found), doc.as_py(), np.int64))], ["window", "doc_id"])


def _runs_of(mask):
    """Starts and ends (exclusive) of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)


def _pieces(batches):
    """References and passages to match: (first, role, doc_id, key, start, words), words as hashes.

    A maximal run of windows that a document is the first to hold is a reference (role 0); one whose windows have the
    same earlier first document is a passage to match with that document's references (role 1).
    """
    hashes = WordHashes()
    for batch in batches:
        out = []
        columns = [batch.column(n) for n in ("doc_id", "key", "text", "windows", "firsts")]
        for doc, key, text, windows, firsts in zip(*columns, strict=True):
            doc, key = doc.as_py(), key.as_py()
            h = hashes.of(split_words(text.as_py()))
            if len(h) < WINDOW:
                continue
            w = window_hashes(h).view(np.int64)
            known, first = windows.values.to_numpy(zero_copy_only=False), firsts.values.to_numpy(zero_copy_only=False)
            order = np.argsort(known)
            known, first = known[order], first[order]
            at = np.minimum(np.searchsorted(known, w), len(known) - 1)
            hit = known[at] == w
            owner = first[at]
            change = np.concatenate([[True], (owner[1:] != owner[:-1]) | (hit[1:] != hit[:-1])])
            starts = np.flatnonzero(change)
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(w)], strict=True):
                if hit[s]:
                    role = int(owner[s] != doc)
                    out.append((int(owner[s]), role, doc, key, s, h[s : e + WINDOW - 1].tobytes()))
        if out:
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["first", "role", "doc_id", "key", "start", "words"])


class SuffixAutomaton:
    """All substrings of some word sequences; every state knows the smallest document in which its strings end."""

    def __init__(self):
        self.next, self.link, self.length, self.doc = [{}], [-1], [0], [math.inf]
        self.last, self.separators = 0, 0

    def _state(self, length, doc, moves):
        self.next.append(moves)
        self.link.append(0)
        self.length.append(length)
        self.doc.append(doc)
        return len(self.next) - 1

    def add(self, words, doc):
        """Add a sequence; a separator that no text holds keeps it apart from the next."""
        for w in words:
            self._extend(w, doc)
        self.separators += 1
        self._extend(-self.separators, math.inf)

    def _extend(self, word, doc):
        nexts, link, length = self.next, self.link, self.length
        new = self._state(length[self.last] + 1, doc, {})
        p = self.last
        self.last = new
        while p >= 0 and word not in nexts[p]:
            nexts[p][word] = new
            p = link[p]
        if p < 0:
            return
        q = nexts[p][word]
        if length[p] + 1 == length[q]:
            link[new] = q
            return
        clone = self._state(length[p] + 1, math.inf, dict(nexts[q]))
        link[clone] = link[q]
        while p >= 0 and nexts[p].get(word) == q:
            nexts[p][word] = clone
            p = link[p]
        link[q] = link[new] = clone

    def finish(self):
        """Hand the smallest documents down the suffix links."""
        for state in np.argsort(np.array(self.length), kind="stable")[::-1].tolist():
            up = self.link[state]
            if up >= 0 and self.doc[state] < self.doc[up]:
                self.doc[up] = self.doc[state]
        return self

    def held(self, words, doc, width):
        """Ends (exclusive) of the runs of `width` words that a smaller document holds."""
        nexts, link, length, first = self.next, self.link, self.length, self.doc
        state, size, ends = 0, 0, []
        for i, w in enumerate(words):
            while state and w not in nexts[state]:
                state = link[state]
                size = length[state]
            to = nexts[state].get(w)
            if to is None:
                continue
            state, size = to, size + 1
            if size >= width:
                size = width
                while length[link[state]] >= width:
                    state = link[state]
                if first[state] < doc:
                    ends.append(i + 1)
        return ends


def _matched(batches):
    """Shard by shard: references first, then the passages; gives the maximal spans (doc_id, key, start, end) to remove."""
    shard, automaton, ready = None, None, False
    for batch in batches:
        out = []
        for number, salt, role, doc, key, start, words in zip(*[batch.column(i).to_pylist() for i in range(7)], strict=True):
            if (number, salt) != shard:
                shard, automaton, ready = (number, salt), SuffixAutomaton(), False
            sequence = np.frombuffer(words, np.uint64).tolist()
            if role == 0:
                automaton.add(sequence, doc)
                continue
            if not ready:
                automaton.finish()
                ready = True
            begin = end = None
            for e in automaton.held(sequence, doc, WINDOW):
                if end is None or e - WINDOW > end:
                    if end is not None:
                        out.append((doc, key, start + begin, start + end))
                    begin = e - WINDOW
                end = e
            if end is not None:
                out.append((doc, key, start + begin, start + end))
        if out:
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "key", "start", "end"])


def _cut(batches):
    for batch in batches:
        removed, shas = [], []
        for text, starts, ends in zip(batch.column("text"), batch.column("starts"), batch.column("ends"), strict=True):
            words = split_words(text.as_py())
            gone = np.zeros(len(words), bool)
            for s, e in zip(starts.as_py(), ends.as_py(), strict=True):
                gone[s:e] = True
            removed.append(int(gone.sum()))
            shas.append(_sha([w for w, g in zip(words, gone.tolist(), strict=True) if not g]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(removed, pa.int64()), pa.array(shas)], ["doc_id", "key", "removed", "cut_sha"])


def repeated_passages(docs):
    """Per row of `docs` (doc_id, text): doc_id, n_words, n_removed, kept_sha256.

    Removed is each word covered by a run of 50 words that also starts in a document with a smaller doc_id, judged on
    the texts as they are; `kept_sha256` is the digest of the other words, joined by one space. Null and empty texts have
    no words; rows without doc_id lose nothing and count as no reference. Rows that repeat give equal rows; texts that
    share a doc_id are not earlier than one another. Further columns are ignored.
    """
    kind = dict(docs.dtypes)["doc_id"]
    text = F.col("text").cast("binary")
    rows = docs.select("doc_id", F.unhex(F.md5(F.coalesce(text, F.lit(b"")))).alias("key"), text.alias("text"))
    survey = rows.mapInArrow(_surveyed, f"doc_id {kind}, key binary, n_words bigint, sha string, runs array<bigint>")
    survey = write_and_read(survey, "passages-survey")
    # Copies of a whole text: the first stands for all, of the others every word is in an earlier window.
    whole = survey.where(f"doc_id IS NOT NULL AND n_words >= {WINDOW}").groupBy("key").agg(F.min("doc_id").alias("first"), F.first("runs").alias("runs"))
    whole = write_and_read(whole, "passages-texts")
    runs = whole.select(F.col("first").cast("long").alias("_id"), F.explode("runs").alias("run"))
    shared = runs.groupBy("run").agg(F.count("*").alias("n")).where("n > 1").select("run")
    listed = runs.join(shared, "run").groupBy("_id").agg(F.collect_set("run").alias("runs"))
    texts = rows.join(listed, F.col("doc_id") == F.col("_id")).select(F.col("_id").alias("doc_id"), "key", "text", "runs")
    texts = write_and_read(texts.dropDuplicates(["doc_id", "key"]), "passages-candidates")
    windows = write_and_read(texts.mapInArrow(_candidate_windows, "window bigint, doc_id bigint"), "passages-windows")
    first = windows.groupBy("window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("window", "first")
    known = windows.join(first, "window").groupBy("doc_id").agg(F.collect_set(F.struct("window", "first")).alias("known"))
    known = known.select("doc_id", F.col("known.window").alias("windows"), F.col("known.first").alias("firsts"))
    pieces = texts.join(known, "doc_id").select("doc_id", "key", "text", "windows", "firsts")
    pieces = write_and_read(pieces.mapInArrow(_pieces, "first bigint, role int, doc_id bigint, key binary, start bigint, words binary"), "passages-pieces")
    size = F.octet_length("words") / 8
    total = pieces.where("role = 0").agg(F.sum(size)).first()[0] or 0
    shards = max(1, math.ceil(total / SHARD_WORDS))
    pieces = pieces.withColumn("shard", F.expr(f"pmod(xxhash64(first), {shards})"))
    load = pieces.where("role = 1").groupBy("shard").agg(F.ceil(F.sum(size) / STREAM_WORDS).alias("salts"))
    salt = F.expr("CASE WHEN role = 0 THEN sequence(0L, salts - 1) ELSE array(pmod(xxhash64(doc_id, start), salts)) END")
    dealt = pieces.join(load, "shard").withColumn("salt", F.explode(salt)).select("shard", "salt", "role", "doc_id", "key", "start", "words")
    dealt = dealt.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "role")
    spans = dealt.mapInArrow(_matched, "doc_id bigint, key binary, start bigint, end bigint")
    spans = spans.groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = spans.select("doc_id", "key", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))
    cut = texts.join(spans, ["doc_id", "key"]).select("doc_id", "key", "text", "starts", "ends")
    cut = cut.mapInArrow(_cut, "doc_id bigint, key binary, removed bigint, cut_sha string").withColumnsRenamed({"doc_id": "_id", "key": "_cut"})
    firsts = whole.select(F.col("key").alias("_key"), F.col("first"))
    marked = survey.join(firsts, (F.col("key") == F.col("_key")) & F.col("doc_id").isNotNull(), "left")
    marked = marked.join(cut, (F.col("doc_id") == F.col("_id")) & (F.col("key") == F.col("_cut")), "left")
    copy = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    return marked.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(_sha([]))).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
    )
