"""BPE encoding and decoding with a given vocabulary whose tokens may mark the end of a word.

Encoding is exact without running merges: at each place the longest token that an Aho-Corasick automaton finds is tried,
then its shorter prefixes; a token may follow another only if no merge would cut across the two. Going back over a place
marks it as a dead end, so the work is linear in the word. Decoding looks up token texts in one buffer by offset.
"""

import json
import struct
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleweft.llm.common import Memory

#: Distinct chunks and pairs that a task remembers; twice as many at most.
MOST_WORDS, MOST_PAIRS = 150_000, 100_000
_END = "\n"  # stands for the end of a word; no byte is written as it
#: Bytes of text whose results leave a task together.
_BYTES_OUT = 4_000_000


def _byte_letters():
    """The letter that byte-level vocabularies write for each byte: itself if printable in Latin-1, else the next free one."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, text):
        spec = json.loads(text)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        vocab = model["vocab"]
        self.ids = {self._own(t, suffix): i for t, i in vocab.items()}
        self.letters = _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.marks = {t[0] for t in self.special}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern)
        self._merges([m if isinstance(m, list) else m.split(" ") for m in model["merges"]], suffix)
        self._matches()
        size = max([*vocab.values(), *self.special.values()]) + 1
        shown = [b""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            shown[i] = t.encode() + b" "
        self.blob = np.frombuffer(b"".join(shown), np.uint8)
        self.lengths = np.array([len(s) for s in shown], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.chunks, self.pairs = Memory(self._chunk, MOST_WORDS), Memory(self._pair, MOST_PAIRS, None)

    @staticmethod
    def _own(token, suffix):
        return token[: -len(suffix)] + _END if suffix and token.endswith(suffix) and token != suffix else token

    def _merges(self, merges, suffix):
        """Rank and parts of every token that a merge makes; single letters have none."""
        self.parts, self.merged = {}, {}
        for r, (a, b) in enumerate(merges):
            a, b = self.ids[self._own(a, suffix)], self.ids[self._own(b, suffix)]
            self.merged[a, b] = r
        names = {i: t for t, i in self.ids.items()}
        self.rank = [-1] * (max(names) + 1)
        for (a, b), r in self.merged.items():
            made = self.ids[names[a] + names[b]]
            if made not in self.parts:
                self.rank[made], self.parts[made] = r, (a, b)

    def _matches(self):
        """The automaton over all tokens that encode to themselves, and the next shorter such prefix of each."""
        self.find = ahocorasick.Automaton()
        self.shorter, self.sizes = {}, {}
        good = self.good = {t: i for t, i in self.ids.items() if t != _END and (i not in self.parts or self._whole(i))}
        for t in good:
            self.find.add_word(t, (len(t), self.ids[t]))
        self.find.make_automaton()
        for t in good:
            p = t[:-1]
            while p and p not in good:
                p = p[:-1]
            self.shorter[self.ids[t]] = self.ids[p] if p else None
            self.sizes[self.ids[t]] = len(t)

    def _whole(self, token):
        """Whether merging the letters of a token gives the token."""
        a, b = self.parts[token]
        return self._fits(a, b, self.rank[token])

    def _fits(self, a, b, before=None):
        """Whether a and b stay apart: no merge across their border comes up before the merges that make them.

        Going back in time, the younger of the two is replaced by the part of it at the border; a pair across the border
        that merges earlier than the piece just undone would have been joined. With `before`, only merges of a lower
        rank than that count.
        """
        limit = before if before is not None else len(self.merged)
        rank, parts, merged = self.rank, self.parts, self.merged
        while True:
            r = merged.get((a, b))
            if r is not None and r < limit:
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = min(limit, ra), parts[a][1]
            else:
                # Among equal merges the left one comes first, so the right part was made after any such pair.
                limit, b = min(limit, rb + 1), parts[b][0]

    def _pair(self, key):
        return self._fits(key >> 20, key & 0xFFFFF)

    def encode_word(self, piece):
        """Token ids of one piece of the split pattern."""
        word = piece if piece.isascii() and piece.isprintable() else "".join([self.letters[b] for b in piece.encode()])
        word += _END
        known = self.good.get(word)
        if known is not None:
            return [known]
        # The longest matches one after the other are most of the places that are reached.
        longest = {end - size + 1: token for end, (size, token) in self.find.iter_long(word)}
        n, out, at, token = len(word), [], 0, longest[0]
        alive = bytearray(b"\x01") * (n + 1)
        alive[n - 1] = 0  # the end mark belongs to the last letter
        sizes, shorter, pairs = self.sizes, self.shorter, self.pairs
        while True:
            end = at + sizes[token]
            if alive[end] and (not out or pairs[out[-1] << 20 | token]):
                out.append(token)
                if end == n:
                    return out
                at = end
                token = longest.get(at)
                if token is None:
                    token = longest[at] = self._longest(word[at:])
                continue
            token = shorter[token]
            while token is None:
                alive[at] = 0
                token = out.pop()
                at -= sizes[token]
                token = shorter[token]

    def _longest(self, rest):
        """The longest token that a text begins with."""
        size, good = self.find.longest_prefix(rest), self.good
        while rest[:size] not in good:
            size -= 1
        return good[rest[:size]]

    def forget(self):
        """Drop what was remembered; a worker that goes on with other work should not hold it."""
        self.chunks.forget()
        self.pairs.forget()

    def _plain(self, text):
        if text.isascii():
            text = text.lower()
        else:
            # Letter by letter: a sigma at the end of a word is no special case.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return [i for piece in self.pieces.findall(text) for i in self.encode_word(piece)]

    def _chunk(self, chunk):
        """Ids, as bytes, of text without ASCII white space, over which no piece reaches."""
        text = chunk.decode()
        if not self.marks.isdisjoint(text) and self.special_split.search(text):
            ids = [i for c in self.special_split.split(text) if c for i in ([self.special[c]] if c in self.special else self._plain(c))]
        else:
            ids = self._plain(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, data):
        """Ids of UTF-8 bytes as little-endian 32-bit integers."""
        return b"".join(map(self.chunks.__getitem__, data.split()))

    def decode(self, ids):
        """Text of such ids as UTF-8 bytes: token texts with a space between."""
        ids = np.frombuffer(ids, "<u4")
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        where = np.repeat(self.offsets[ids] - ends + lengths, lengths) + np.arange(ends[-1])
        return self.blob[where].tobytes()[:-1]


_loaded = {}


def _of(shared):
    """One coder per Python worker and vocabulary."""
    key = hash(shared.value)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = WordBpe(shared.value)
    return _loaded[key]


def read_vocabulary(spark, path):
    """The tokenizer file as a broadcast: a few megabytes, fixed by the vocabulary and not by the data."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _runs(sizes):
    """Row ranges of about `_BYTES_OUT` bytes each."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= _BYTES_OUT:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def encode_decode(docs, path, text="text", ids="ids", decoded="decoded"):
    """`docs` with the ids of its text (binary, little-endian 32-bit integers), and the text decoded from them.

    One narrow pass. A null text counts as empty: no ids, empty text. Very long texts are encoded whole. All columns
    stay; a column named as one of the outputs is replaced. Results leave a task in batches of bounded size, and texts go
    to it once, among the columns that stay.
    """
    shared = read_vocabulary(docs.sparkSession, path)
    kept = [c for c in docs.columns if c not in (ids, decoded)]
    among = kept.index(text) if text in kept and isinstance(docs.schema[text].dataType, T.StringType | T.BinaryType) else None

    def run(batches):
        bpe = _of(shared)
        for batch in batches:
            rows = batch.column(0)
            texts = (batch.column(1) if among is None else rows.field(among)).cast(pa.binary())
            del batch
            for start, end in _runs(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                coded = [bpe.encode(x.as_py() or b"") for x in texts.slice(start, end - start)]
                plain = pa.array([bpe.decode(x) for x in coded], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([rows.slice(start, end - start), pa.array(coded, pa.binary()), plain], ["row", "ids", "decoded"])
                del coded, plain
            del rows, texts  # before the next ones come
        bpe.forget()
        pa.default_memory_pool().release_unused()

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), *[F.col(f"`{text}`").cast("binary").alias("text")] * (among is None))
    schema = T.StructType([T.StructField("row", packed.schema["row"].dataType), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    out = packed.mapInArrow(run, schema)
    return out.select(*[F.col(f"row.`{c}`") for c in kept], F.col("ids").alias(ids), F.col("decoded").alias(decoded))
