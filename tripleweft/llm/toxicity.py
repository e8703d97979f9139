"""Toxicity by a noisy channel: disguised words are restored under a character model, and the restored text is scored.

The channel swaps letters for digits and signs, repeats letters, and puts spaces or signs between them. A Viterbi search
through the lattice of what a writer may have meant finds the reading that the character model and the channel's costs
like best. The character model counts trigrams over the words of all documents. Scores come from words and word beginnings
that labelled toxic documents have far more often, set against their frequency in the other labelled documents.
"""

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tripleweft.llm.common import Memory
from tripleweft.scratch import write_and_read

#: Labelled rows of either class that the score is learnt from, by the order of a hash of doc_id. They bound the features; more
#: bytes of them than this are an error.
SAMPLE_ROWS, FEATURE_BYTES = 20_000, 64_000_000
#: Toxic texts that a feature stands in at least, however many there are, and log odds from which it tells.
LEAST_TEXTS, LEAST_ODDS = 3, 3
#: Distinct chunks that a task counts before it starts anew, and that it remembers; of the latter twice as many at most.
MOST_WORDS, MOST_CHUNKS = 100_000, 75_000
# Letters that the character model tells apart; all others are one further letter.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïñòóôõöøùúûüœ"
OTHER = "?"
# What a sign may stand for.
MEANT = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i",
}
# Signs between letters that mean nothing, and costs of the channel in nats.
FILL = ".-_*~'’/,:;#"
SWAP, STRETCH, SQUEEZE, FILLED, BREAK = 0.7, 0.3, 3.0, 0.5, 5.0
# Lengths of the word beginnings that are features.
STARTS = (4, 5, 6)

_WORD = re.compile(r"[^\W\d_]+")
_SIGNS = re.escape("".join(c for c in MEANT if not c.isalnum()))
_ODD = re.compile(rf"[^\W\d_][0-9{_SIGNS}]|[0-9{_SIGNS}][^\W\d_]|([^\W\d_])\1|[^\W\d_][{re.escape(FILL)}]+[^\W\d_]")
# Runs of single letters or signs with blanks between, and what follows.
_SPACED = re.compile(rf"(?<!\S)[\w{_SIGNS}](?:\s++[\w{_SIGNS}](?![\w{_SIGNS}]))++(?=\s*+(\S++)|)")
_LETTER = re.compile(r"[^\W\d_]")
_BLANK = re.compile(r"\s++")


def _folded(word):
    return "".join(c if c in _KNOWN else OTHER for c in word)


_KNOWN = frozenset(LETTERS)


def count_words(docs):
    """Words of all documents, lower-cased, and how often each occurs: (word, n)."""

    def emit(chunks):
        words = Counter()
        for chunk, n in chunks.items():
            for w in _WORD.findall(chunk):
                words[w] += n
        return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])

    def run(batches):
        chunks = Counter()
        for batch in batches:
            for x in batch.column(0):
                chunks.update((x.as_py() or "").lower().split())
                if len(chunks) >= MOST_WORDS:
                    yield emit(chunks)
                    chunks = Counter()
        yield emit(chunks)

    return docs.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def count_trigrams(words):
    """Trigrams of the words with their borders: a dictionary with at most as many entries as the alphabet has triples."""

    def run(batches):
        grams = Counter()
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                padded = f"^^{_folded(word)}$"
                for i in range(len(padded) - 2):
                    grams[padded[i : i + 3]] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], ["gram", "n"])

    sums = words.mapInArrow(run, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in sums.collect()}


class CharacterModel:
    """Log probability of a letter after two others, backing off to one and none."""

    def __init__(self, trigrams):
        self.three, self.two, self.pairs, self.one, self.letters = trigrams, Counter(), Counter(), Counter(), Counter()
        for gram, n in trigrams.items():
            self.two[gram[:2]] += n
            self.pairs[gram[1:]] += n
            self.one[gram[1]] += n
            self.letters[gram[2]] += n
        self.total = sum(self.letters.values())
        self.known = {}

    def cost(self, before, letter):
        """Minus the log probability of `letter` after the two letters `before`."""
        key = before + letter
        value = self.known.get(key)
        if value is None:
            p = (self.letters[letter] + 0.5) / (self.total + 0.5 * (len(LETTERS) + 2))
            p = (self.pairs[key[1:]] + 5 * p) / (self.one[key[1]] + 5)
            p = (self.three.get(key, 0) + 5 * p) / (self.two[before] + 5)
            value = self.known[key] = -math.log(p)
        return value

    def restore(self, text, breaks=False):
        """The likeliest reading of a disguised text without white space; with `breaks` it may be several words."""
        # A reading is a chain (all before, last letter), so that long texts are not copied at each letter.
        states, known = {"^^": (0.0, None)}, self.known

        def best(into, state, cost, reading):
            if state not in into or cost < into[state][0]:
                into[state] = (cost, reading)

        def spell(states, letter, times, extra):
            shown = letter if letter in _KNOWN else OTHER
            for _ in range(times):
                step = {}
                for state, (cost, reading) in states.items():
                    value = known.get(state + shown)
                    best(step, state[1] + shown, cost + (self.cost(state, shown) if value is None else value), (reading, letter))
                states = step
            return {s: (c + extra, r) for s, (c, r) in states.items()} if extra else states

        at = 0
        while at < len(text):
            sign, length = text[at], 1
            while at + length < len(text) and text[at + length] == sign:
                length += 1
            at += length
            if breaks:
                split = dict(states)
                for state, (cost, reading) in states.items():
                    if reading and reading[1] != " ":
                        best(split, "^^", cost + self.cost(state, "$") + BREAK, (reading, " "))
                states = split
            if length == 1 and sign.isalpha():  # most letters stand for themselves
                if len(states) == 1:
                    [(state, (cost, reading))], shown = states.items(), sign if sign in _KNOWN else OTHER
                    states = {state[1] + shown: (cost + (known.get(state + shown) or self.cost(state, shown)), (reading, sign))}
                else:
                    states = spell(states, sign, 1, 0.0)
                continue
            step = {}
            meant = [(sign, 0.0)] if sign.isalpha() else [(m, SWAP) for m in MEANT.get(sign, "")]
            for letter, extra in meant:
                counts = {1: 0.0} if length == 1 else {1: SQUEEZE, 2: 0.0} if length == 2 else {1: STRETCH, 2: STRETCH}
                for times, more in counts.items():
                    for state, (cost, reading) in spell(states, letter, times, extra * times + more).items():
                        best(step, state, cost, reading)
            if not meant or sign in FILL:
                for state, (cost, reading) in states.items():
                    best(step, state, cost + FILLED, reading)
            states = step
        if not states:
            return ""
        chain, out = min(((cost + self.cost(state, "$"), reading) for state, (cost, reading) in states.items()), key=lambda x: x[0])[1], []
        while chain:
            chain, letter = chain
            out.append(letter)
        return "".join(reversed(out))


def features_of(word):
    """What a word may be known by: itself and its beginnings."""
    return ["=" + word, *["^" + word[:k] for k in STARTS if len(word) > k]]


def _likeness():
    """For each letter and sign, the least of the letters that one sign may stand for with it, or any of these with others."""
    same = {c: c for c in LETTERS}
    for letters in MEANT.values():
        old, new = {same[c] for c in letters}, min(same[c] for c in letters)
        same = {c: new if s in old else s for c, s in same.items()}
    return same | {sign: same[letters[0]] for sign, letters in MEANT.items()}


class _Outline(dict):
    """Translation of characters: signs to the letters they may be, all that is dropped to nothing."""

    def __missing__(self, code):
        c = chr(code)
        self[code] = value = _LIKE.get(c) or (c if c.isalpha() else None)
        return value


_LIKE, _OUTLINE, _AGAIN = _likeness(), _Outline(), re.compile(r"(.)\1+", re.DOTALL)


def outline(text):
    """What all readings of a text have in common: letters that signs do not tell apart are one, and none is doubled."""
    return _AGAIN.sub(r"\1", text.translate(_OUTLINE))


class _Outlines:
    """Whether a reading of a text may have a feature; it has the same outline as the text, or parts of it."""

    def __init__(self, features):
        self.whole = {outline(f[1:]) for f in features if f[0] == "="}
        self.starts = {outline(f[1:]) for f in features if f[0] == "^"}
        self.sizes = sorted({len(s) for s in self.starts})
        self.within = ahocorasick.Automaton()
        for s in self.whole | self.starts:
            if s:
                self.within.add_word(s, 1)
        self.within.make_automaton()

    def as_word(self, text):
        shape = outline(text)
        return shape in self.whole or any(shape[:k] in self.starts for k in self.sizes)

    def inside(self, text):
        return len(self.within) > 0 and next(self.within.iter(outline(text)), None) is not None


class _Chunks(Memory):
    """Words that a chunk of text stands for, or what `value` makes of them, by chunk; bounded.

    With `outlines` of all that `value` looks for, chunks that cannot be read as any of it are not restored.
    """

    def __init__(self, model, value, outlines=None):
        super().__init__(self.read, MOST_CHUNKS)
        self.model, self.value, self.outlines = model, value, outlines

    def read(self, chunk):
        words = _WORD.findall(chunk)
        if _ODD.search(chunk):
            edge = chunk.strip(FILL + '"”“?)}]>')
            # A final mark of exclamation may be one or a letter.
            for form in {edge, edge.rstrip("!")}:
                if not self.outlines or self.outlines.as_word(form):
                    words += self.model.restore(form).split()
        return self.value(words)


def _spaced(model, text, outlines=None):
    """Words that stand letter by letter, per run of letters: those of the run, and the run joined to the chunks beside it.

    Words broken into parts of two letters or more, such as 'id iot', cannot be told from two words and are not read. With
    `outlines`, what cannot be read as any of them is left out.
    """
    for m in _SPACED.finditer(text):
        run, after = _BLANK.sub("", m.group()), (m.group(1) or "").strip(FILL)
        if len(run) < 4 and not _LETTER.search(run):
            continue
        end = m.start()
        while end and text[end - 1].isspace():
            end -= 1
        start = end
        while start and not text[start - 1].isspace():
            start -= 1
        before = text[start:end].strip(FILL)
        forms = {run + after, before + run, before + run + after} - {run}
        if outlines:
            forms = {f for f in forms if outlines.as_word(f)}
        alone = model.restore(run, True).split() if not outlines or outlines.inside(run) else []
        yield alone, [run, *forms, *map(model.restore, forms)]


def restored_words(model, text, chunks):
    """Distinct words of a text, disguised ones restored."""
    low = (text or "").lower()
    return {w for c in low.split() for w in chunks[c]}.union(*[w for pair in _spaced(model, low) for w in pair])


class Scorer:
    """What tasks need to score texts."""

    def __init__(self, trigrams, weights, line):
        self.model, self.weights, self.line = CharacterModel(trigrams), weights, line
        self.outlines = _Outlines(weights)
        self.heads = {f[1 : 1 + STARTS[0]] for f in weights}  # all words with a feature begin so
        self.chunks = _Chunks(self.model, self.weight, self.outlines)

    def weight(self, words):
        """The strongest feature of some words, 0 if they have none."""
        known, heads = self.weights, self.heads
        return max((known.get(f, 0.0) for w in words if w[: STARTS[0]] in heads for f in features_of(w)), default=0.0)

    def evidence(self, text):
        """Number of words with a weight, their mean weight and their share, each bounded."""
        low = (text or "").lower()
        chunks = low.split()
        found = [w for w in map(self.chunks.__getitem__, chunks) if w]
        for run, joined in _spaced(self.model, low, self.outlines):
            known = [w for s in run if (w := self.weight([s]))]
            found += known or [w for w in [self.weight(joined)] if w]
        if not found:
            return (0.0, 0.0, 0.0)
        return math.log1p(len(found)), sum(found) / len(found), math.log1p(100 * len(found) / max(1, len(chunks)))

    def score(self, text):
        z = self.line[0] + sum(a * b for a, b in zip(self.line[1:], self.evidence(text), strict=True))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


_scorers = {}


def _share(session, trigrams, weights, line):
    """What a `Scorer` takes as a broadcast, with a name: trigrams and features are bounded by the constants above."""
    return session.sparkContext.broadcast((uuid.uuid4().hex, (trigrams, weights, line)))


def _scorer(shared):
    """One scorer per Python worker and broadcast."""
    name, parts = shared.value
    if name not in _scorers:
        _scorers.clear()
        _scorers[name] = Scorer(*parts)
    return _scorers[name]


def held_out(doc_id):
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _sample(docs, labels):
    """Distinct labelled texts to learn from, at most `SAMPLE_ROWS` of either class, and the rows of each class."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = write_and_read(known, "toxicity-labels")
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    parts = [known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS) for t in (0, 1)]
    ids = parts[0].unionByName(parts[1])  # bounded by the two limits, a few hundred kilobytes
    texts = docs.select(F.col("doc_id").alias("_id"), "text").join(F.broadcast(ids), F.col("_id") == F.col("doc_id")).select("toxic", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.dropDuplicates(["toxic", "text"])
    return write_and_read(texts, "toxicity-sample"), [totals.get(0, 0), totals.get(1, 0)]


def _features(sample, trigrams):
    """Weights of the features that toxic texts have much more often: smoothed log odds by number of texts."""
    shared = sample.sparkSession.sparkContext.broadcast(trigrams)

    def run(batches):
        model = CharacterModel(shared.value)
        chunks = _Chunks(model, tuple)
        counts = Counter()
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.update((w, toxic) for w in restored_words(model, text, chunks))
        words, kinds = zip(*counts, strict=True) if counts else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(kinds, pa.int32()), pa.array(list(counts.values()), pa.int64())], ["word", "toxic", "n"])

    sums = [F.sum(F.when(F.col("toxic") == t, F.col("n")).otherwise(0)).alias(name) for t, name in ((0, "clean"), (1, "bad"))]
    words = sample.select(F.col("toxic").cast("int"), "text").mapInArrow(run, "word string, toxic int, n bigint").groupBy("word").agg(*sums)
    starts = [F.when(F.length("word") > k, F.concat(F.lit("^"), F.substring("word", 1, k))) for k in STARTS]
    shown = words.select("clean", "bad", F.explode(F.array(F.concat(F.lit("="), "word"), *starts)).alias("feature")).where("feature IS NOT NULL")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, clean = sizes.get(1, 0), sizes.get(0, 0)
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    found = shown.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad")).where(F.col("bad") >= LEAST_TEXTS)
    # A single clean text may quote a word, so the odds and not their certainty decide.
    found = found.select("feature", odds.alias("weight")).where(f"weight >= {LEAST_ODDS}")
    found = write_and_read(found, "toxicity-features")
    size = found.agg(F.sum(F.octet_length("feature") + 100)).first()[0] or 0
    if size > FEATURE_BYTES:
        raise ValueError(f"the features would take {size} bytes, more than {FEATURE_BYTES}: learn from fewer rows")
    return {r["feature"]: r["weight"] for r in found.collect()}


def _line(x, y, weight):
    """Logistic regression by Newton steps with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    line = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + 0.05 * line
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(line))
        step = np.linalg.solve(curvature, gradient)
        line -= step
        if np.abs(step).max() < 1e-8:
            break
    return line.tolist()


def learn(docs, labels):
    """Everything that `Scorer` takes, from all texts and a bounded sample of labels.

    Without labels of both classes the score is the smoothed share of toxic labels for every text.
    """
    trigrams = count_trigrams(write_and_read(count_words(docs), "toxicity-words"))
    sample, totals = _sample(docs, labels)
    if not all(totals):
        share = (totals[1] + 1) / (sum(totals) + 2)
        return trigrams, {}, [math.log(share / (1 - share)), 0.0, 0.0, 0.0]
    weights = _features(sample, trigrams)
    shared = _share(sample.sparkSession, trigrams, weights, [0.0] * 4)

    def run(batches):
        scorer = _scorer(shared)
        for batch in batches:
            rows = [scorer.evidence(t) for t in batch.column(1).to_pylist()]
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.float64()) for c in columns]], ["toxic", "a", "b", "c"])

    seen = sample.select(F.col("toxic").cast("int"), "text").mapInArrow(run, "toxic int, a double, b double, c double").collect()  # bounded by the sample
    y = np.array([r["toxic"] for r in seen], np.float64)
    x = np.array([[r["a"], r["b"], r["c"]] for r in seen], np.float64).reshape(-1, 3)
    weight = np.where(y == 1, totals[1] / max(1, y.sum()), totals[0] / max(1, (1 - y).sum()))
    return trigrams, weights, _line(x, y, weight)


def _score_column(docs, learnt):
    shared = _share(docs.sparkSession, *learnt)

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _scorer(shared)
        for texts in columns:
            yield pa.array([scorer.score(t.as_py()) for t in texts], pa.float64())
        _scorers.clear()  # a worker that goes on with other work should not hold it

    return score(F.col("text"))


def score_documents(docs, labels):
    """Per row of `docs` (doc_id, text): doc_id, held_out, score, predicted.

    `labels` has doc_id and toxic (0 or 1); rows that are held out, null or otherwise labelled teach nothing, and a document
    that is labelled both ways is toxic. A null or empty text is scored as having no words. Very long texts are scored
    whole. Rows that repeat score alike; further columns are ignored. No rows, no rows.
    """
    scored = docs.select("doc_id", "text").withColumn("score", _score_column(docs, learn(docs, labels)))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs, labels):
    """The rows of `docs`, with all columns, that `score_documents` does not predict as toxic."""
    columns = docs.columns
    scored = docs.withColumn("_toxicity", _score_column(docs, learn(docs, labels)))
    return scored.where("_toxicity < 0.5").select(*[F.col(f"`{c}`") for c in columns])
