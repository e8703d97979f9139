"""Language model, spelling variants and periodic runs against brute force."""

import hashlib
import math
import os
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripleweft.llm import ngram_lm, periodic_runs, variants
from tripleweft.llm.ngram_lm import score_corpus, score_texts, train
from tripleweft.llm.periodic_runs import find_runs, lyndon_lengths, runs_of
from tripleweft.llm.queries import QUERIES
from tripleweft.llm.variants import count_runs, decompose, group_variants, one_edit
from tripleweft.scratch import base_dir

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string"
#: Null, empty and blank texts, control characters, other scripts, repeated rows, no doc_id.
ODD = [(9001, None), (9002, ""), (9003, "  \t A  b\x1cc \x85 é \x0b"), (9004, "x"), (9005, "zz zz zz"), (9005, "zz zz zz"), (None, "no id here"), (9006, "ÀB 🙂 ß c")]


@pytest.fixture(scope="module")
def texts(spark):
    found = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    return found + ODD


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, SCHEMA).withColumns({"n": F.lit("clash"), "level": F.lit(1), "word": F.lit(2)}).repartition(5)


# --- language model -------------------------------------------------------------------


def tokens(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")] + [" end"]


def kneser_ney(training, order):
    """Figures of the training tokens, and the probability of a token after others, from plain counts."""
    levels, raw = [None, *[Counter() for _ in range(order)]], Counter()
    for t in training:
        raw.update(t)
        s = [" start", *t]
        levels[order].update(tuple(s[k : k + order]) for k in range(len(s) - order + 1))
        for m in range(2, order):
            if len(s) >= m:
                levels[m][tuple(s[:m])] += 1
    for m in range(order - 1, 0, -1):
        levels[m].update(g[1:] for g in levels[m + 1])
    off = [None, *[[0, *ngram_lm._discounts([sum(v == k for v in levels[m].values()) for k in range(1, 5)])] for m in range(1, order + 1)]]
    context = [None, None, *[defaultdict(lambda: [0, 0.0]) for _ in range(2, order + 1)]]
    for m in range(2, order + 1):
        for g, v in levels[m].items():
            context[m][g[:-1]][0] += v
            context[m][g[:-1]][1] += off[m][min(v, 3)]
    freed = sum(off[1][min(v, 3)] for v in levels[1].values())

    def probability(before, word):
        v = levels[1][(word,)]
        p = (v - off[1][min(v, 3)] + freed / (len(raw) + 1)) / sum(levels[1].values())
        for m in range(2, min(order, len(before) + 1) + 1):
            c = tuple(before[-(m - 1) :])
            if c in context[m]:
                v, (total, held) = levels[m][(*c, word)], context[m][c]
                p = (v - off[m][min(v, 3)] + held * p) / total
        return p

    return raw, probability


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_brute_force(docs, texts, monkeypatch, order):
    if order > 2:  # many shards and small pieces
        monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 60_000)
        monkeypatch.setattr(ngram_lm, "PIECE_BYTES", 20_000)
        monkeypatch.setattr(ngram_lm, "SCORE_BYTES", 9_000)
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts}
    raw, probability = kneser_ney([tokens(t) for i, t in texts if not held[i]], order)
    total = sum(raw.values())
    start = [" start", *tokens(texts[0][1])[:4]]
    assert sum(probability(start, w) for w in raw) + probability(start, " unseen") == pytest.approx(1)
    want = []
    for i, text in texts:
        t = tokens(text)
        s = [" start", *t]
        base = sum(math.log10((raw[w] + 1) / (total + len(raw) + 1)) for w in t)
        score = sum(math.log10(probability(s[max(0, k - order + 1) : k], s[k])) for k in range(1, len(s)))
        want.append((i, held[i], len(t), sum(raw[w] > 0 for w in t), total, base, score))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in score_corpus(docs, order).collect()]
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=repr), sorted(want, key=repr), strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9)
    assert sum(g[6] for g in got if g[1]) > sum(g[5] for g in got if g[1])


def test_model_of_nothing(spark, docs):
    empty = docs.where(F.lit(False))
    assert score_corpus(empty).count() == 0
    [r] = score_texts(spark.createDataFrame([(1, "a b")], SCHEMA), train(empty)).collect()
    assert (r.n_tokens, r.n_known, r.score, r.perplexity) == (3, 0, 0.0, 1.0)


def test_model_files_go_with_the_scores(spark, docs):
    before = set(os.listdir(base_dir(spark)))
    score_corpus(docs).count()
    assert {p.split("-")[1] for p in set(os.listdir(base_dir(spark))) - before} == {"scores"}


def test_a_frequent_pair_is_no_shard_of_its_own(spark, monkeypatch):
    """A third of all words follow one word; the grams spread over the shards by their own hash."""
    rng = random.Random(4)
    words = [w for _ in range(3000) for w in ("hot", f"w{rng.randrange(10**6)}", f"v{rng.randrange(50)}")]
    pairs = np.array([ngram_lm.xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    keys = ngram_lm._keys(np.stack([pairs[:-1], pairs[1:]], 1))
    sizes = np.bincount(ngram_lm._shard(np.unique(keys), 16), minlength=16)
    assert sizes.max() < 1.5 * sizes.mean()


class _Run:
    """Takes the function that a plan would run in its tasks."""

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


def _counted(texts, rows=100):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    return ngram_lm._count(_Run(), 2, 8)(batch.slice(k, rows) for k in range(0, len(texts), rows))


def test_grams_are_sorted_by_ranges_of_their_hash(monkeypatch):
    """Counting takes little more than the tokens of a piece, and a shard is merged range by range to the same sums."""
    rng = random.Random(6)
    texts = [" ".join(f"w{int(rng.expovariate(0.0002))}" for _ in range(1000)) for _ in range(600)]
    monkeypatch.setattr(ngram_lm, "GRAMS_AT_ONCE", 30_000, raising=False)
    monkeypatch.setattr(ngram_lm, "SCORE_BYTES", 100_000)
    peak, packed = 0, defaultdict(list)
    tracemalloc.start()
    for batch in _counted(texts, len(texts)):
        for r in batch.to_pylist():
            packed[r["level"], r["shard"]].append(r["grams"])
        peak = max(peak, tracemalloc.get_traced_memory()[1] - sum(len(b) for x in packed.values() for b in x))
    tracemalloc.stop()
    assert peak < 55 * 601 * 1000  # bytes a token
    hashes = {w: ngram_lm.xxhash.xxh3_64_intdigest(w) for t in texts for w in t.split()} | {" start": int(ngram_lm._START), " end": int(ngram_lm._END)}
    want = Counter(tuple(hashes[w] for w in p) for t in texts for p in zip([" start", *t.split()], tokens(t), strict=True))
    got = Counter()
    for shard in range(8):
        keys, grams, stats = ngram_lm._merged(packed[2, shard], 2, shard, 8)
        assert not packed[2, shard] and (np.diff(keys) > 0).all() and (ngram_lm._keys(grams) == keys).all()
        got.update(dict(zip(map(tuple, grams.tolist()), stats[0].tolist(), strict=True)))
    assert got == want


def test_pieces_reach_over_batches(monkeypatch):
    """Small batches are counted together, so that a gram that they share is passed on once."""
    monkeypatch.setattr(ngram_lm, "SCORE_BYTES", 50)
    texts = ["a b c", None, "", "a b"] * 25
    one, many = (sum(batch.num_rows for batch in _counted(texts, rows)) for rows in (100, 2))
    assert one == many


# --- spelling variants ------------------------------------------------------------------


def one_off(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(words, ratio=5):
    near = {w: [v for v in words if one_off(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], words[form[w]] if form[w] else None, root)
    return out


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(8)
    bases = ["".join(rng.choice("abcé") for _ in range(rng.randint(6, 12))) for _ in range(60)]
    words = {w: rng.choice([5, 30, 700, 9000]) for w in bases}
    for w in bases * 6:
        k = rng.randrange(len(w))
        v = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abcé") + w[k:], w[:k] + rng.choice("abcé") + w[k + 1 :]])
        if len(v) >= 6:
            words.setdefault(v, rng.choice([5, 6, 100, 700]))
    return words


@pytest.mark.parametrize(("frequent", "block"), [(64, 2048), (3, 7), (10**9, 50)])
def test_variants_equal_brute_force(spark, vocabulary, monkeypatch, frequent, block):
    monkeypatch.setattr(variants, "FREQUENT", frequent)
    monkeypatch.setattr(variants, "BLOCK_ROWS", block)
    df = spark.createDataFrame([(w, n, "clash") for w, n in vocabulary.items()], "word string, n long, near string").repartition(3)
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in group_variants(df).collect()}
    assert got == brute_variants(vocabulary)


def test_bounds_hold_for_all_edits(vocabulary):
    """What one edit leaves of the grams of a word is never less than its bound."""
    rng = random.Random(9)
    counts = Counter(w[p : p + q] for w in vocabulary for q in (2, 3, 4) for p in range(len(w) - q + 1))
    frequent = {g: n for g, n in counts.items() if n >= 12}
    for w in vocabulary:
        grams, changed = decompose(w, frequent)
        assert len(grams) - changed >= 1
        for _ in range(12):
            k = rng.randrange(len(w) + 1)
            v = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abcé") + w[k:], w[:k] + rng.choice("abcéz") + w[k + 1 :]])
            if len(v) >= 6:
                assert sum((Counter(grams) & Counter(decompose(v, frequent)[0])).values()) >= len(grams) - changed


def test_one_edit():
    def codes(*words):
        return np.array(words).view(np.uint32).reshape(len(words), -1)

    assert one_edit(codes("abcd", "abcd", "abcd"), codes("abcd", "abxd", "bacd")).tolist() == [False, True, False]
    assert one_edit(codes("aab", "abc", "abc"), codes("aaab", "xabc", "acbb")).tolist() == [True, True, False]


def test_words_of_texts_equal_brute_force(docs, texts):
    counts = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % 11 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    got = {r.word: r.n for r in count_runs(docs, 3, 2, slip=11).collect()}
    assert got == {w: n for w, n in counts.items() if len(w) >= 3 and n >= 2}


def test_only_the_result_is_left(spark, vocabulary):
    df = spark.createDataFrame(list(vocabulary.items()), "word string, n long")
    before = set(os.listdir(base_dir(spark)))
    found = group_variants(df)
    assert [p.split("-")[0] for p in set(os.listdir(base_dir(spark))) - before] == ["variants"]
    assert found.count() == len(vocabulary)


def test_no_or_wrong_words(spark):
    none = spark.createDataFrame([], "word string, n long")
    assert group_variants(none).count() == 0
    assert [tuple(r) for r in group_variants(spark.createDataFrame([("abcdef", 5)], "word string, n long")).collect()] == [("abcdef", 5, 0, None, None, "abcdef")]
    for bad in (("short", 5), (None, 5), ("abcdefg", None)):
        with pytest.raises(ValueError, match="letters"):
            group_variants(spark.createDataFrame([bad], "word string, n long"))


# --- periodic runs ------------------------------------------------------------------------


def brute_runs(s, least):
    n, out = len(s), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and s[j] == s[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(least, 2 * p) and not any(s[i : i + length - q] == s[i + q : i + length] for q in range(1, p)):
                out.append((i, p, length))
            i = max(j, i + 1)
    return sorted(out)


def numbered(s):
    return periodic_runs._numbered(s)


def test_lyndon_lengths_equal_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        s, k = numbered([rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(1, 20))])
        want = []
        for i in range(len(s)):
            ends = [j for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[m:j] for m in range(i + 1, j))]
            want.append(max(ends) - i)
        assert lyndon_lengths(s, k) == want


def test_runs_equal_brute_force():
    rng = random.Random(2)
    for _ in range(1500):
        s = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.5:
            s = (s[: rng.randint(1, len(s))] * 12)[: len(s) + 8]
        for least in (2, 7, 12):
            assert runs_of(*numbered(s), least) == brute_runs(s, least)


def test_runs_of_long_texts():
    fibonacci = ["a", "b"]
    while len(fibonacci[-1]) < 3000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    s = fibonacci[-1][:700]
    assert runs_of(*numbered(s)) == brute_runs(s, 12)
    assert runs_of([0] * 200_000, 1) == [(0, 1, 200_000)]
    assert runs_of([k % 50_000 for k in range(120_000)], 50_000) == [(0, 50_000, 120_000)]


def brute_query(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words, 12)
    best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
    gone = {k for i, p, m in runs for k in range(i + p, i + m)}
    lines = "".join(f"{i},{m},{p}\n" for i, p, m in runs)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    shown = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    return (doc_id, len(runs), *shown, *digests)


def test_runs_query_equals_brute_force(spark, docs, texts, monkeypatch):
    texts = [(i, t) for i, t in texts if len(t or "") < 4000] + [(9100 + k, "a b c d e f g h " * 5) for k in range(40)]
    df = spark.createDataFrame(texts, SCHEMA).withColumns({"runs": F.lit("clash"), "words": F.lit(1), "g": F.lit(2)}).repartition(3)
    monkeypatch.setattr("tripleweft.llm.queries.table", lambda *a: df)
    got = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()]
    assert sorted(got, key=repr) == sorted([brute_query(i, t) for i, t in texts], key=repr)
    assert sum(r[1] for r in got) > 30


def test_runs_of_no_rows(docs):
    assert find_runs(docs.where(F.lit(False))).count() == 0
