"""Mixing, chat formatting, toxicity and the pipeline."""

import hashlib
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import rows
from tripleweft.llm import chat, mixing, toxicity
from tripleweft.llm.minhash import near_duplicates
from tripleweft.llm.mixing import mix, plan_mix
from tripleweft.llm.pii import masked
from tripleweft.plans.components import components

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


# --- mixing -------------------------------------------------------------------------


def weighted(sizes, share=1.5, cap=2, weights=(5, 2, 1)):
    """Brute force of the targets by source."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in stopped]
        level = (total - sum(stopped.values())) / sum(w[s] for s in open_) if open_ else 0
        above = [s for s in open_ if level * w[s] > cap * sizes[s]]
        if not above:
            return {s: stopped.get(s, level * w[s]) for s in names}
        stopped |= {s: cap * sizes[s] for s in above}


@pytest.fixture(scope="module")
def sources(spark):
    data, n = [], 0
    for name, count in (("big", 900), ("B", 60), ("a", 40), (None, 30), ("é", 20), ("one", 1), ("none", 3)):
        for i in range(count):
            n += 1
            data.append((n, None if name == "none" and i else "" if name == "none" else "w " * (1 + (n * 37) % 90), name, "clash"))
    data += [data[0], data[0], (None, "x y z", "a", "clash"), (None, "x y z", "a", "clash")]
    return spark.createDataFrame(data, "doc_id long, text string, source string, size string").repartition(3)


def test_mix_meets_its_targets(sources):
    got = plan_mix(sources).collect()
    assert len(got) == sources.count()
    sizes, taken, target = {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    want = weighted(sizes)
    for s, t in want.items():
        assert target[s] == pytest.approx(t, rel=1e-12)
        assert all(r.source_size == sizes[s] for r in got if r.source == s)
        assert abs(taken[s] - t) <= max(2, 0.01 * t) or s == "one"
    assert abs(taken["one"] - want["one"]) <= sizes["one"]


def test_mix_repeats_rows_and_reruns_agree(sources):
    plan = plan_mix(sources)
    assert rows(plan) == rows(plan_mix(sources.repartition(7)))
    mixed = mix(sources)
    assert mixed.columns == sources.columns
    count = {r.doc_id: r.n for r in mixed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    want = {}
    for r in plan.where("doc_id IS NOT NULL").collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    assert count == {k: v for k, v in want.items() if v}


def test_mix_spreads_a_hot_source(sources, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    got = plan_mix(sources).where("source = 'big'").agg(F.sum("taken").alias("t"), F.first("target").alias("want")).first()
    assert abs(got.t - got.want) < 0.01 * got.want


def test_repeated_rows_meet_the_target(spark):
    """A source of equal rows cannot give each the same; some get one copy more, whichever column tells them apart."""
    data = [(1, "a b c d e f g h", "same", k % 3) for k in range(2000)] + [(k + 10, "w " * (1 + k % 20), "other", k) for k in range(300)] + [(5, "x y", "third", 0)] * 7
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, more int").repartition(3)
    plan = plan_mix(docs).collect()
    taken = {s: sum(r.taken for r in plan if r.source == s) for s in ("same", "other", "third")}
    target = {r.source: r.target for r in plan}
    assert all(abs(taken[s] - target[s]) <= 20 for s in taken)
    assert {r.copies for r in plan if r.source == "same"} in ({0, 1}, {1, 2})
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert counts["same"] * 8 == taken["same"] and counts["third"] * 2 == taken["third"]
    assert rows(mixed) == rows(mix(docs.repartition(5)))


def test_unmet_targets_are_an_error(sources, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_STEPS", 1)
    with pytest.raises(ValueError, match="misses its target"):
        plan_mix(sources)


def test_mix_of_nothing(spark, sources):
    assert plan_mix(sources.where(F.lit(False))).count() == 0
    assert [tuple(r)[4:6] for r in plan_mix(sources.where("source = 'none'")).collect()] == [(0.0, 0)] * 3


def test_tilt_is_exponential_in_size(sources):
    """Rates of a source grow (or fall) with size as exp does, up to the cap."""
    sized = mixing._sized(sources.where("source = 'big'"))
    histogram = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    total = sized.agg(F.sum("size")).first()[0]
    for share in (0.4, 1.3):
        targets = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")).withColumn("target", F.lit(share * total))
        state = mixing._solve(histogram, targets, 2).first()
        value = histogram.select(F.sum(F.col("n") * F.col("size") * F.least(F.lit(2.0), F.exp(F.lit(state.lam / state["mean"]) * F.col("size"))))).first()[0]
        assert value == pytest.approx(share * total, rel=1e-6) and (state.lam > 0) == (share > 1)


# --- chat ----------------------------------------------------------------------------

TURNS = [
    (1, 1, "assistant", "<|im_end|><\\|x <\\\\|"),
    (1, 0, "user", "é 🙂\n<|im_start|>"),
    (2, 0, None, None),
    (2, 1, "assistant", ""),
    (2, 1, "assistant", "tie"),
    (3, None, "a\nb\\n<|", "x"),
    (None, 0, "user", "no id"),
    (4, 0, "assistant", "long " * 3000),
    (4, 1, "assistant", "same"),
    (4, 1, "assistant", "same"),
]


def digests(turns):
    groups = {}
    for c, t, r, x in turns:
        groups.setdefault(c, []).append((t is not None, t or 0, r is not None, r or "", x is not None, x or ""))
    out = {}
    for c, g in groups.items():
        g.sort()
        said = "".join(x for *_, r, _, x in [(a, b, d, r, e, x) for a, b, d, r, e, x in g] if r == "assistant")
        every = "".join(f"{r}\n{x}\n" for _, _, _, r, _, x in g)
        out[c] = (len(g), hashlib.sha256(every.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


@pytest.mark.parametrize("part", [8_000_000, 40])
def test_chats_read_back(spark, part):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1 if part == 40 else 10_000)
    try:
        formatted = chat.format_chats(turns, part)
        got = chat.chat_digests(formatted).collect()
        parts = formatted.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.conv_id: tuple(r)[1:5] for r in got} == digests(TURNS)
    assert (max(p.part for p in parts) > 0) == (part == 40)
    for p in parts:
        assert p.n_turns == len(chat.parse_chat(p.formatted))
    whole = {r.conv_id: r.formatted_chars for r in got}
    assert whole == {c: sum(len(p.formatted) for p in parts if p.conv_id == c) for c in whole}


def test_escape_is_reversible():
    import itertools

    import pyarrow as pa

    texts = ["".join(t) for n in range(7) for t in itertools.product("<\\|", repeat=n)]
    escaped = chat._escaped(pa.array(texts)).to_pylist()
    assert [chat.unescape(e) for e in escaped] == texts and not any("<|" in e for e in escaped)
    roles = ["".join(t) for n in range(5) for t in itertools.product("<\\|\nn", repeat=n)]
    escaped = chat._escaped_role(pa.array(roles)).to_pylist()
    assert [chat.unescape_role(e) for e in escaped] == roles and not any("\n" in e or "<|" in e for e in escaped)


def test_no_turns(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.chat_digests(chat.format_chats(empty)).count() == 0
    assert rows(chat.chat_digests(chat.format_chats(chat.with_probe(empty))).select("conv_id", "n_turns", "loss_chars")) == [(-1, 2, 34)]


# --- toxicity --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    """Texts in which toxic ones say 'rotten' or 'vermin', and labels for most of them."""
    plain = "the quick brown fox jumps over a lazy dog near the old river bank and sees rooster mint".split()
    data, labels = [], []
    for i in range(400):
        toxic = int(i % 4 == 0)
        words = [plain[(i * 7 + j * j) % len(plain)] for j in range(30)]
        if toxic:
            words[i % 29] = ("rotten", "vermin")[i // 4 % 2]
            words[(i + 5) % 29] = ("rotten", "vermin")[i // 8 % 2]
        data.append((i, " ".join(words), "clash"))
        labels.append((i, toxic, 1))
    data += [(900, None, "clash"), (901, "", "clash"), (902, "word " * 20_000, "clash"), (None, "rotten vermin", "clash"), (1, data[1][1], "clash")]
    labels += [(None, 1, 0), (5, None, 0), (6, 7, 0), (1, 0, 1)]
    return (
        spark.createDataFrame(data, "doc_id long, text string, score string").repartition(4),
        spark.createDataFrame(labels, "doc_id long, toxic int, quality int"),
    )


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None and r.doc_id < 400:
            assert r.predicted == int(r.doc_id % 4 == 0)
        elif r.doc_id is not None:
            assert r.predicted == 0
        else:
            assert r.predicted == 1 and not r.held_out
    assert 50 < sum(r.held_out for r in got) < 120
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(1 for r in got if not r.predicted)


def test_held_out_labels_teach_nothing(labelled):
    """Turning the labels of held-out rows round changes no score."""
    docs, labels = labelled
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert rows(toxicity.score_documents(docs, turned)) == rows(toxicity.score_documents(docs, labels))


@pytest.mark.parametrize("disguised", ["r0tt3n", "rrrooottteeennn", "r.o.t.t.e.n", "r o t t e n", "ro++en", "v3rm1n", "v-e-r-m-i-n", "VERM!N", "v e r m i n", "v*e*r*m*i*n"])
def test_disguised_words_are_restored(labelled, disguised):
    docs, labels = labelled
    scorer = toxicity.Scorer(*learnt(docs, labels))
    text = "the old dog sees " + disguised + " near the river " + disguised
    assert scorer.score(text) > 0.5 > scorer.score("the old dog sees 4 mint a b c d near the river +1 555")


_learnt = []


@pytest.mark.parametrize("disguised", ["rot-ten", "ver_min", "rott.en", "ro-tt-en", "ver.m*in", "veermin", "vveerrmmiinn", "v  e  r  m  i  n", "v e rmin", "verm i n", "ve r m in"])
def test_words_disguised_in_part_are_restored(labelled, disguised):
    scorer = toxicity.Scorer(*learnt(*labelled))
    text = "the old dog sees " + disguised + " near the river " + disguised
    assert scorer.score(text) > 0.5 > scorer.score("the old-dog sees mint/rooster, a b near the river's bank")


def test_three_spaced_letters_and_long_runs():
    scorer = toxicity.Scorer({}, {"=ass": 6.0}, [0.0] * 4)
    assert scorer.evidence("what an a s s he is")[0] > 0 == scorer.evidence("a b c is 1 2 3")[0]
    assert len(scorer.model.restore("a.b" * 100_000)) == 200_000


def test_rare_words_of_many_toxic_texts_are_learnt(spark):
    texts = [(t, f"plain words number {i} stand here") for t in (0, 1) for i in range(1500)]
    sample = spark.createDataFrame(texts + [(1, f"a slur of the tail, number {i}") for i in range(12)], "toxic int, text string")
    weights = toxicity._features(sample, {})
    assert weights["=slur"] > toxicity.LEAST_ODDS  # in 12 of 1,512 toxic texts
    assert "=plain" not in weights and "=number" not in weights


def learnt(docs, labels):
    if not _learnt:
        _learnt.append(toxicity.learn(docs, labels))
    return _learnt[0]


def readings(text, breaks=False):
    """All readings of a text under the channel, each with its cost: runs of one sign give one or two letters, or none."""
    import itertools

    parts = []
    for sign, run in itertools.groupby(text):
        n = len(list(run))
        t = toxicity
        letters = [(sign, 0.0)] if sign.isalpha() else [(m, t.SWAP) for m in t.MEANT.get(sign, "")]
        counts = {1: {1: 0.0}, 2: {1: t.SQUEEZE, 2: 0.0}}.get(n, {1: t.STRETCH, 2: t.STRETCH})
        options = [(c * k, swap * k + more) for c, swap in letters for k, more in counts.items()]
        parts.append(options or [("", t.FILLED)])
    for chosen in itertools.product(*parts):
        for cut in itertools.product(*[("", " ") if breaks and k else ("",) for k in range(len(chosen))]):
            yield "".join(c + w for c, (w, _) in zip(cut, chosen, strict=True)), sum(x for _, x in chosen)


@pytest.mark.parametrize("text", ["r0t", "1d1", "v3rm1n", "0ld", "s!de", "ro.tt-en", "rrott3en", "veerm", "mmm1nnt", "a-s*s", "00ld", "--"])
def test_viterbi_is_the_best_reading(labelled, text):
    """The search equals trying every reading: swaps, fillers, stretched and squeezed letters."""
    model = toxicity.CharacterModel(learnt(*labelled)[0])

    def price(word):
        padded = "^^" + word + "$"
        return sum(model.cost(padded[i : i + 2], padded[i + 2]) for i in range(len(padded) - 2))

    costs = {}
    for word, more in readings(text):
        costs[word] = min(costs.get(word, 1e9), price(word) + more)
    assert costs[model.restore(text)] == pytest.approx(min(costs.values()))


@pytest.mark.parametrize("text", ["oldog", "th3ol", "rotnear", "amint"])
def test_viterbi_breaks_words_best(labelled, text):
    model = toxicity.CharacterModel(learnt(*labelled)[0])

    def price(words):
        out = 0.0
        for k, w in enumerate(words.split(" ")):
            padded = "^^" + w + "$"
            out += sum(model.cost(padded[i : i + 2], padded[i + 2]) for i in range(len(padded) - 2)) + (toxicity.BREAK if k else 0)
        return out

    costs = {}
    for words, more in readings(text, True):
        if "  " not in words:
            costs[words] = min(costs.get(words, 1e9), price(words) + more)
    assert costs[model.restore(text, True)] == pytest.approx(min(costs.values()))


def test_outlines_change_no_score(labelled):
    """Chunks that cannot be read as a feature are not restored; all others are."""
    import random

    rng, scorer = random.Random(3), toxicity.Scorer(*learnt(*labelled))
    plain = toxicity.Scorer(*learnt(*labelled))
    plain.outlines, plain.chunks = None, toxicity._Chunks(plain.model, plain.weight)
    found = 0
    for _ in range(2000):
        word = list(rng.choice(["rotten", "vermin", "rooster", "minty", "verm"]))
        for _ in range(rng.randint(1, 6)):
            k = rng.randrange(len(word))
            word[k : k + 1] = rng.choice([word[k] * 2, rng.choice("013$!|+"), word[k] + rng.choice(".-_* '"), word[k]])
        text = "the dog " + "".join(word) + " near"
        assert scorer.evidence(text) == plain.evidence(text)
        found += scorer.evidence(text)[0] > 0
    assert 300 < found < 1900


def test_too_many_features_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FEATURE_BYTES", 100)
    sample = spark.createDataFrame([(t, f"{('clean', 'nasty')[t]} words here") for t in (0, 1) for _ in range(60)], "toxic int, text string")
    with pytest.raises(ValueError, match="fewer rows"):
        toxicity._features(sample, {})


def test_toxicity_without_labels(labelled, spark):
    docs, labels = labelled
    none = toxicity.score_documents(docs.limit(5), labels.where(F.lit(False))).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity.score_documents(docs.where(F.lit(False)), labels).count() == 0


# --- components and pipeline ---------------------------------------------------------------


def test_components(spark):
    chain = [(i, i + 1) for i in range(59) if i % 20 != 19]
    star = [(1000, i) for i in range(1001, 1100)]
    edges = spark.createDataFrame([*chain, *star, (5, 5), (3, 2), (None, 4)], "a long, b long")
    want = [(i, i // 20 * 20) for i in range(60)] + [(i, 1000) for i in range(1000, 1100)]
    assert {r.node: r.component for r in components(edges).collect()} == dict(want)
    assert components(edges.where(F.lit(False))).count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir).cache()
        out.append((name, docs, after))
        docs = after
    return out


def test_pipeline_stages_do_what_their_operators_say(spark, stages):
    by = {name: (before, after) for name, before, after in stages}
    assert [name for name, _, _ in stages] == ["toxicity", "minhash_near_dedup", "pii", "source_mixing", "bpe_encoding"]
    for name, before, after in stages[:-1]:
        assert after.columns == before.columns
    before, after = by["toxicity"]
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    gone = rows(toxicity.score_documents(before, labels).where("predicted = 1").select("doc_id"))
    assert rows(before.join(after, "doc_id", "left_anti").select("doc_id")) == gone
    before, after = by["minhash_near_dedup"]
    assert rows(after.select("doc_id")) == rows(near_duplicates(before).where("kept").select("doc_id"))
    before, after = by["pii"]
    assert {r.doc_id: r.text for r in after.collect()} == {r.doc_id: masked(r.text) for r in before.collect()}
    before, after = by["source_mixing"]
    assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] == 2
    assert after.count() == plan_mix(before).agg(F.sum("copies")).first()[0]
    before, after = by["bpe_encoding"]
    assert after.count() == before.count() and after.where("length(ids) = 0 AND length(text) > 10").count() == 0


def test_rest_imports_without_the_subpackage(tmp_path):
    """A copy of the library without the operators still registers its other queries."""
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('tripleweft.llm', 'corpus_pipeline')):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'bgp_query' in e.queries() and not any(q.startswith('op') for q in e.queries() if q[2:3].isdigit())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
