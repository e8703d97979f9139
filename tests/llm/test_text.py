"""Operators on texts against brute force, on fixtures with nulls, copies, long texts and clashing columns."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import plan_of, rows
from tripleweft.llm import pii, substrings
from tripleweft.llm.bpe import WordBpe, encode_decode
from tripleweft.llm.minhash import keep_one_of_each, near_duplicates
from tripleweft.llm.substrings import SuffixAutomaton, repeated_passages
from tripleweft.llm.token_counts import Trie, count_tokens, read_ranks

WORDS = [f"w{i}" for i in range(400)]


def texts(seed=1, n=60):
    """Made-up documents: copies, near copies, shared passages, short and empty texts."""
    r = random.Random(seed)
    base = [" ".join(r.choices(WORDS, k=r.randint(60, 220))) for _ in range(n)]
    passage = " ".join(r.choices(WORDS, k=70))
    for i in range(0, n, 6):
        base[i] = base[i + 5]
        words = base[i + 4].split()
        words[r.randrange(len(words))] = "edited"
        base[i + 1] = "\n ".join(words)
        base[i + 2] += " " + passage + " tail"
    return [*base, None, "", " \t", "a b", "A  b", "one two three four", "ONE two three four", " ".join(["again"] * 300)]


@pytest.fixture(scope="module")
def docs(spark):
    """Ids in another order than the texts, a repeated row, a null id, and columns with the names of outputs."""
    data = [(i * 7 % 101, t) for i, t in enumerate(texts())]
    data += [data[3], (None, data[5][1]), (None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    for name in ("n_words", "component_id", "kept", "key", "token", "ids", "row", "spans", "size"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def known(docs):
    return {r.doc_id: r.text or "" for r in docs.where("doc_id IS NOT NULL").select("doc_id", "text").collect()}


# --- repeated passages -----------------------------------------------------------


def cut(by_id, width=50):
    """Brute force: (words, removed, digest of the rest) by id."""
    split = {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in by_id.items()}
    first = {}
    for i in sorted(split):
        for j in range(len(split[i]) - width + 1):
            first.setdefault(tuple(split[i][j : j + width]), i)
    out = {}
    for i, w in split.items():
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if first[tuple(w[j : j + width])] < i:
                gone[j : j + width] = [True] * width
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[i] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def test_passages_equal_brute_force(docs):
    got = repeated_passages(docs).collect()
    assert len(got) == docs.count()
    want = cut(known(docs))
    assert sum(v[1] for v in want.values()) > 500
    for r in got:
        if r.doc_id is not None:
            assert tuple(r)[1:] == want[r.doc_id]
        else:
            assert r.n_removed == 0


@pytest.mark.parametrize("size", [1, 40])
def test_passages_over_many_shards(docs, monkeypatch, size):
    """Tiny shards and salts change nothing."""
    want = rows(repeated_passages(docs))
    monkeypatch.setattr(substrings, "SHARD_WORDS", 100 * size)
    monkeypatch.setattr(substrings, "STREAM_WORDS", 100 * size)
    assert rows(repeated_passages(docs)) == want


def test_passages_of_different_texts_under_one_id(spark):
    w = " ".join(WORDS[:60])
    df = spark.createDataFrame([(5, w), (5, w + " more"), (6, "x " + w)], "doc_id int, text string")
    assert [r.n_removed for r in sorted(repeated_passages(df).collect())] == [0, 0, 60]
    assert repeated_passages(df.where("doc_id > 9")).count() == 0


def test_suffix_automaton_equals_search():
    r = random.Random(4)
    for _ in range(60):
        references = [([r.randrange(3) for _ in range(r.randint(1, 12))], r.randrange(5)) for _ in range(4)]
        automaton = SuffixAutomaton()
        for words, doc in references:
            automaton.add(words, doc)
        automaton.finish()
        query, doc, width = [r.randrange(3) for _ in range(15)], r.randrange(6), r.randint(1, 4)
        want = [
            e
            for e in range(width, 16)
            if any(d < doc and w[k : k + width] == query[e - width : e] for w, d in references for k in range(len(w) - width + 1))
        ]
        assert automaton.held(query, doc, width) == want


# --- near-duplicates ---------------------------------------------------------------


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def linked(by_id):
    """Brute force: smallest id reachable, by id."""
    sets = {i: shingles(t) for i, t in by_id.items()}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_near_duplicates_equal_brute_force(docs):
    got = near_duplicates(docs).collect()
    want = linked(known(docs))
    assert len(got) == docs.count() and sum(not v[2] for v in want.values()) > 15
    for r in got:
        if r.doc_id is not None:
            assert tuple(r)[1:] == want[r.doc_id]
        else:
            assert r.component_id is None and r.kept


def test_one_group_over_many_blocks(spark, monkeypatch):
    """A chain of near copies, whose ends are not similar, in lists and sets cut into small blocks."""
    from tripleweft.llm import minhash

    r = random.Random(7)
    words, chain = r.choices(WORDS, k=150), []
    for _ in range(80):
        words = list(words)
        words[r.randrange(150)] = f"x{r.random()}"
        chain.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(chain)), "doc_id long, text string")
    want = linked(dict(enumerate(chain)))
    for block in (2048, 30):
        monkeypatch.setattr(minhash, "LIST_BLOCK", block)
        monkeypatch.setattr(minhash, "SET_BLOCK", block * 100)
        assert {x.doc_id: tuple(x)[1:] for x in near_duplicates(df).collect()} == want


def test_one_of_each_group_stays(docs):
    kept = keep_one_of_each(docs)
    want = linked(known(docs))
    assert kept.columns == docs.columns
    ids = [x.doc_id for x in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, v in want.items() if v[2])
    assert ids.count(None) == 2
    assert keep_one_of_each(docs.where(F.lit(False))).count() == 0


def test_unlike_rows_of_one_id_all_stay(spark):
    data = [(1, "a b c d e f g h"), (1, "totally other words stand here now"), (1, "A b c d e f g h"), (2, "a b c d e f g h"), (3, "totally other words stand here now"), (4, "new words of its own")]
    data += [(5, ""), (5, None), (5, ""), (2, "second text of two")]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("group", F.lit("clash")).repartition(3)
    got = sorted((r.doc_id, r.text) for r in keep_one_of_each(docs).collect() if r.text)
    assert [(i, t.lower()) for i, t in got] == [(1, "a b c d e f g h"), (1, "totally other words stand here now"), (2, "second text of two"), (4, "new words of its own")]
    assert keep_one_of_each(docs).where("coalesce(text, '') = ''").count() == 1
    assert {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()} == {(1, 1), (2, 1), (2, 2), (3, 1), (4, 4), (5, 5)}


# --- personal data ------------------------------------------------------------------

PII = (
    "mail a.b+c@x-y.example.org, or x@y.z_q@r.s; ip 10.0.0.255 not 10.0.0.256 nor 1.2.3; v 1.2.3.4.5 card 4111 1111 1111 1111 "
    "and 4111-1111-1111-1112, phone +1 (555) 010-9999 or +49 30 1234567, iban DE89 3704 0044 0532 0130 00 é 🙂 b@c.d"
)
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }
            if fits[kind]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_personal_data_equals_the_patterns():
    r = random.Random(3)
    assert [pii.KINDS[k] for _, k, _, _ in pii.spans_of(PII)].count("iban") == 1
    pieces = ["@", "a", "b.c", "_", "1", "23", ".", " ", "-", "+", "4111111111111111", "(", ")", "255", "é", "x@y.z", "%"]
    for text in [PII, *("".join(r.choices(pieces, k=25)) for _ in range(3000))]:
        assert [(s, k, e) for s, k, e, _ in pii.spans_of(text) if k < 4] == base_spans(text)


def test_personal_data_in_long_runs_is_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1 " * 100_000, "@" * 200_000):
        pii.spans_of(text)


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE88370400440532013000")
    assert pii.spans_of("ssn 123-45-6789")[0][3] > pii.LEAST and not pii.spans_of("order 123-45-6789")


def test_account_numbers_before_other_words():
    for text in ("IBAN ES9121000418450200051332 BIC CAIXESBB", "AT61 1904 3002 3457 3201 12 May", "pay AT61 1904 3002 3457 3201 ABCD EFGH by May"):
        [(start, kind, end, _)] = [s for s in pii.spans_of(text) if pii.KINDS[s[1]] == "iban"]
        assert text[start:end] in ("ES9121000418450200051332", "AT61 1904 3002 3457 3201")
    text = "AT61 1904 3002 3457 3201 DE89 3704 0044 0532 0130 00"
    assert [text[s:e] for s, k, e, _ in pii.spans_of(text) if pii.KINDS[k] == "iban"] == ["AT61 1904 3002 3457 3201", "DE89 3704 0044 0532 0130 00"]


def test_masking(spark, docs):
    df = spark.createDataFrame([(1, PII, 5, "x"), (2, None, 6, "y"), (3, "", 7, "z")], "doc_id int, text string, n_chars long, spans string")
    got = {r.doc_id: r for r in pii.mask_pii(df).collect()}
    assert "[EMAIL]" in got[1].text and "[CARD]" in got[1].text and "4111 1111" not in got[1].text
    assert got[1].n_chars == len(got[1].text) and got[1].spans == "x" and got[2].text is None and got[2].n_chars == 6
    found = pii.find_pii(docs).collect()
    assert len(found) == docs.count() and not any(r.spans for r in found)


# --- encoding -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def word_bpe():
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return WordBpe(f.read()), Tokenizer.from_file(path)


def test_encoder_equals_the_library(word_bpe):
    bpe, library = word_bpe
    r = random.Random(2)
    pieces = ["a", "b", "the", "ing", "'s", "'", "<|endoftext|>", "<|startoftext|>", "<|", "|>", " ", "\n", "é", "é", "Σ", "İ", "1", "23", "!!"]
    pieces += ["th", "aaaa", "ß", "中", "😀", "\x1c", "\x85", "\xa0", "'LL", "zzzzzzz", "Un", "lesslesslessless"]
    for text in ["", " ", "a" * 5000, *("".join(r.choices(pieces, k=r.randint(1, 14))) for _ in range(4000))]:
        want = library.encode(text, add_special_tokens=False).ids
        ids = bpe.encode(text.encode())
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert bpe.decode(ids).decode() == library.decode(want, skip_special_tokens=False)


def test_encoding_keeps_columns(docs, word_bpe):
    coded = encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    assert sorted(coded.columns) == sorted([*docs.columns, "decoded"])
    for r in coded.collect():
        want = word_bpe[1].encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r["row"] == "clash"
    assert encode_decode(docs.where(F.lit(False)), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_encoding_sends_texts_once(spark, docs, word_bpe):
    """Beside the columns that stay a task gets no copy of the text; only one that is replaced goes by itself."""
    path = public_tokenizers.path("word_bpe_49k.json")
    [sent] = re.findall(r"MapInArrow run\(([^)]*)\)", plan_of(encode_decode(docs, path)))
    assert sent.startswith("row#") and "," not in sent
    odd = spark.createDataFrame([(1, "a  b", b"c"), (2, None, None)], "n int, t string, b binary")
    for column, replaced in (("t", "decoded"), ("b", "decoded"), ("t", "t"), ("T", "decoded")):
        found = sorted(encode_decode(odd, path, text=column, decoded=replaced).collect())
        want = [word_bpe[0].encode(x) for x in ((b"c" if column == "b" else b"a  b"), b"")]
        assert [bytes(r["ids"]) for r in found] == want and [r[replaced] for r in found] == [word_bpe[0].decode(x).decode() for x in want]
        assert replaced == "t" or [(r.t, r.b) for r in found] == [("a  b", b"c"), (None, None)]


# --- token counts -----------------------------------------------------------------------


def best_pieces(scores, data):
    """Brute force: pieces of the best segmentation, fewest among equals."""
    best = [(0.0, 0)]
    for end in range(1, len(data) + 1):
        best.append(max((best[s][0] + scores[data[s:end]], best[s][1] - 1) for s in range(end) if data[s:end] in scores))
    return -best[-1][1]


def test_token_counts_equal_brute_force(docs):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    scores = read_ranks(path)
    cache = defaultdict(int)
    for r in count_tokens(docs, path, pattern).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        pieces = regex.findall(pattern, r.text or "")
        for p in pieces:
            cache[p] = cache[p] or best_pieces(scores, p.encode())
        assert (r.n_pretokens, r.n_tokens) == (len(pieces), sum(cache[p] for p in pieces))


def test_trie_shares_prefixes_and_stays_bounded(monkeypatch):
    from tripleweft.llm import token_counts

    scores = {bytes([b]): -6.0 for b in range(256)} | {b"ab": -5.0, b"abc": -20.0}
    trie = Trie(scores)
    assert (trie.count("abab"), trie.count("abc"), trie.count("")) == (2, 2, 0)
    assert len(trie.forward) == 1 + len({"a", "ab", "aba", "abab", "abc"})
    monkeypatch.setattr(token_counts, "MOST_NODES", 10)
    monkeypatch.setattr(token_counts, "MOST_WORDS", 3)
    assert [trie.count(f"x{i}") for i in range(50)] == [len(f"x{i}") for i in range(50)]
    assert len(trie.forward) < 20


def test_classes_and_their_values_are_not_broadcast(spark, monkeypatch):
    """Spark sizes exploded signatures by the files of their classes; a few files may hold half a gigabyte of values."""
    from tripleweft.llm import minhash, mixing
    from tripleweft.plans import joins

    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    plans, write = {}, minhash.write_and_read
    monkeypatch.setattr(minhash, "write_and_read", lambda df, label: plans.update({label: plan_of(df)}) or write(df, label))
    words = [f"w{k}" for k in range(40)]
    docs = spark.createDataFrame([(k, " ".join(words[:39] + [f"x{k // 2}"]), "s", 1) for k in range(20)], "doc_id long, text string, source string, more int")
    kept = keep_one_of_each(docs)
    assert kept.count() == 1 and "Broadcast" not in plans["minhash-posts"] and "SortMergeJoin" in plans["minhash-posts"]
    assert "BroadcastHashJoin" not in plan_of(mixing.mix(docs))
