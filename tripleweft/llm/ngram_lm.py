"""Interpolated modified Kneser-Ney n-gram model: counted by shuffles, stored as sorted hash arrays, mapped by tasks.

Grams are counted per piece of text, and only the sums are shuffled, dealt over shards by ranges of a hash of the gram, so
that neither a frequent gram nor a frequent context makes a shard large. The shard of the longest grams writes its sorted
hashes and counts, and passes on what the level below needs: one continuation for the end of each distinct gram, and the
follow-up counts of its beginning. So level after level is merged. Scoring sorts the grams of a piece of text and walks
through the files, one mapped at a time.
"""

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pf
import xxhash
from pyspark.sql import functions as F

from tripleweft.llm.common import mixed
from tripleweft.scratch import drop_path, new_path, write_and_read

#: Words of a gram of the highest level.
ORDER = 2
#: Bytes of training text for a shard, and of text that is counted, and scored, at once.
SHARD_BYTES, PIECE_BYTES, SCORE_BYTES = 16_000_000, 16_000_000, 4_000_000
#: Grams that are sorted at once, about: those of a piece or a shard are taken by ranges of their hash.
GRAMS_AT_ONCE = 500_000
# Before the first token, and after the last word; no word holds a blank.
_START, _END = np.uint64(xxhash.xxh3_64_intdigest(b" start")), np.uint64(xxhash.xxh3_64_intdigest(b" end"))
# Per gram: how often it occurs (below the highest level: after how many words), as a word: how often at all; and of the
# grams that it begins: their sum, and how many occur once, twice, or more often.
STATS = ("n", "raw", "total", "ones", "twos", "more")
_PACKED = "level int, shard int, grams binary"
_CODEC = "zstd"


def _pieces(batches, most):
    """(doc_id and text columns) of at most `most` bytes of text, or one row."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            past = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, past + most, "right")))
            yield batch.slice(start, end - start)
            start = end


def _tokens(texts):
    """Hashes of the tokens of texts, one start and one end each, and where each text starts; the last entry is the size."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten().dictionary_encode()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.as_buffer()) for w in words.dictionary), np.uint64, len(words.dictionary))
    real = np.array([len(w.as_buffer()) > 0 for w in words.dictionary], bool)
    codes = words.indices.to_numpy()
    real = real[codes] if len(codes) else np.zeros(0, bool)
    # White space at the ends of a text gives empty words.
    before = np.concatenate([[0], np.cumsum(real, dtype=np.int32)])
    counts = np.diff(before[lists.offsets.to_numpy()]).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(counts + 2)])
    out = np.empty(starts[-1], np.uint64)
    inner = np.ones(len(out), bool)
    inner[starts[:-1]] = inner[starts[1:] - 1] = False
    out[starts[:-1]] = _START
    out[starts[1:] - 1] = _END
    if len(codes):
        out[inner] = hashes[codes[real]]
    return out, starts


def _held(batches, most):
    """Tokens of at most `most` bytes of text, or one row, from as many batches as that takes, and where each text starts."""
    held, size = [], 0
    for piece in _pieces(batches, min(most, SCORE_BYTES)):
        more = pc.sum(pc.binary_length(piece.column(1))).as_py() or 0
        if held and size + more > most:
            yield _one(held)
            size = 0
        held.append(_tokens(piece.column(1)))
        size += more
    if held:
        yield _one(held)


def _one(held):
    """Some (tokens, starts), which are taken out of the list, as one."""
    counts = np.concatenate([np.diff(starts) for _, starts in held])
    tokens = np.concatenate([tokens for tokens, _ in held])
    held.clear()
    return tokens, np.concatenate([[0], np.cumsum(counts)])


def _keys(grams):
    """One hash for each row of word hashes, by its words and their order."""
    out = grams[:, 0]
    for k in range(1, grams.shape[1]):
        out = mixed(out + np.uint64(k)) + grams[:, k]
    return mixed(out)


def _shard(keys, shards):
    """Shards are ranges of the hash."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _sums(grams, stats):
    """Distinct grams in the order of their keys, with the sums of their rows of `stats`."""
    keys = _keys(grams)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], grams[order[first]], [None if s is None else np.add.reduceat(s[order], first, dtype=np.int64) if len(first) else np.zeros(0, np.int64) for s in stats]


def _grams(tokens, at, level):
    grams = np.empty((len(at), level), np.uint64)
    for k in range(level):
        grams[:, k] = tokens[at + k]
    return grams


def _small(x):
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def _pack(grams, stats):
    """Grams as numbers into their distinct words, sorted, with small integers: most of it compresses well."""
    words, codes = np.unique(grams, return_inverse=True)
    codes = codes.reshape(grams.shape)
    order = np.lexsort(codes.T[::-1])
    data = pickle.dumps((words, [_small(c) for c in codes[order].T], [None if s is None else _small(s[order]) for s in stats]))
    return len(data).to_bytes(8, "little") + pa.compress(data, codec=_CODEC, asbytes=True)


def _unpack(data):
    words, codes, stats = pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec=_CODEC, asbytes=True))
    return np.stack([words[c] for c in codes], 1), stats


def _together(parts):
    """Some (grams, stats) as one; a stat that none has stays None."""
    stats = []
    for known in zip(*[s for _, s in parts], strict=True):
        zero = [np.zeros(len(g), np.uint8) if s is None else s for (g, _), s in zip(parts, known, strict=True)]
        stats.append(None if all(s is None for s in known) else np.concatenate(zero))
    return np.concatenate([g for g, _ in parts]), stats


def _joined(packed, level):
    """All grams of some packed ones, and their stats."""
    return _together([(np.zeros((0, level), np.uint64), _only()), *map(_unpack, packed)])


def _ranges(grams):
    """Ranges of the hash that hold about `GRAMS_AT_ONCE` of so many grams each."""
    return max(1, -(-grams // GRAMS_AT_ONCE))


def _by_range(tokens, at, level, shards):
    """Where grams start, by ranges of shards."""
    ranges = min(shards, _ranges(len(at)))
    if ranges == 1:
        yield at
        return
    place = np.empty(len(at), np.int32)
    for k in range(0, len(at), GRAMS_AT_ONCE):
        part = slice(k, k + GRAMS_AT_ONCE)
        place[part] = _shard(_keys(_grams(tokens, at[part], level)), shards) * ranges // shards
    for k in range(ranges):
        yield at[place == k]


def _merged(packed, level, shard, shards):
    """`_sums` of the packed grams of a shard; they are taken out of the list."""
    parts = []
    while packed:
        parts.append(_unpack(packed.pop()))
    ranges = _ranges(sum(len(g) for g, _ in parts))
    split = [[] for _ in range(ranges)]
    while parts:
        grams, stats = parts.pop()
        place = _shard(_keys(grams), shards * ranges) - shard * ranges
        for k in np.unique(place).tolist():
            here = place == k
            split[k].append((grams[here], [None if s is None else s[here] for s in stats]))
    none = (np.zeros((0, level), np.uint64), _only())
    found = []
    while split:
        found.append(_sums(*_together([none, *split.pop(0)])))
    keys, grams, stats = zip(*found, strict=True)
    del found
    known = [None if all(s is None for s in x) else np.concatenate([np.zeros(len(k), np.int64) if s is None else s for k, s in zip(keys, x, strict=True)]) for x in zip(*stats, strict=True)]
    return np.concatenate(keys), np.concatenate(grams), known


def _dealt(level, grams, stats, shards):
    """Rows of sums for each shard."""
    keys, grams, stats = _sums(grams, stats)
    cuts = np.searchsorted(_shard(keys, shards), np.arange(shards + 1))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        part = slice(int(cuts[k]), int(cuts[k + 1]))
        yield level, k, _pack(grams[part], [None if s is None else s[part] for s in stats])


def _rows(rows, names=("level", "shard", "grams"), kinds=(pa.int32(), pa.int32(), pa.binary())):
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))


def _only(**stats):
    return [stats.get(name) for name in STATS]


def _count(texts, order, shards):
    """Packed sums of all grams of `texts` (doc_id, text): the highest level, beginnings of texts, and words."""

    def run(batches):
        for tokens, starts in _held(batches, PIECE_BYTES):
            for level in range(1, order + 1):
                # Below the highest level a count is one of words before, and nothing comes before the start.
                if level in (1, order):
                    fits = np.ones(len(tokens), bool)
                    fits[starts[:-1]] = level > 1
                    for k in range(1, level):  # too near to the end of a text
                        fits[starts[1:] - k] = False
                    at = np.flatnonzero(fits)
                    del fits
                else:
                    at = starts[:-1][np.diff(starts) >= level]
                for part in _by_range(tokens, at, level, shards):
                    once = np.ones(len(part), np.uint8)
                    yield _rows(list(_dealt(level, _grams(tokens, part, level), _only(raw=once) if level == 1 else _only(n=once), shards)))
                del at, part, once
            del tokens, starts
            pa.default_memory_pool().release_unused()

    return texts.mapInArrow(run, _PACKED)


def _files(folder):
    """The file system of a folder, and its path there."""
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return pf.FileSystem.from_uri(folder)


def _store(folder, name, columns):
    """Write arrays as an Arrow file that a reader sees whole or not at all; a task that runs again writes the same."""
    system, path = _files(folder)
    system.create_dir(path)
    rows = pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))
    written = f"{path}/{name}.{xxhash.xxh3_64_hexdigest(np.random.bytes(16))}"
    with system.open_output_stream(written) as out, pa.ipc.new_file(out, rows.schema) as file:
        file.write(rows)
    system.move(written, f"{path}/{name}")


def _load(folder, name):
    """The arrays of a file: mapped where the folder is mounted, else read."""
    system, path = _files(folder)
    source = pa.memory_map(f"{path}/{name}") if isinstance(system, pf.LocalFileSystem) else system.open_input_file(f"{path}/{name}")
    rows = pa.ipc.open_file(source).get_batch(0)
    return {f.name: rows.column(k).to_numpy() for k, f in enumerate(rows.schema)}


def _discounts(counts):
    """What is taken off grams that occur once, twice, or more often, from how many occur 1 to 4 times."""
    n1, n2, n3, n4 = counts
    if not (n1 and n2 and n3 and n4):
        return [0.5, 1.0, 1.5]  # fixed values: usual ones where too little is known
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return found if all(0 < d <= k + 1 for k, d in enumerate(found)) else [0.5, 1.0, 1.5]


def _merge(packed, level, order, shards, folder):
    """Merge `level` shard by shard: its file, one row of figures (level 0), and rows for the levels below.

    Above the words, each distinct gram is one more continuation of its end and follows its beginning. Figures of other
    levels pass.
    """

    def run(table):
        shard = table.column("shard")[0].as_py()
        given = list(zip(table.column("level").to_pylist(), table.column("grams").to_pylist(), strict=True))
        del table
        rows = [(0, shard, b) for k, b in given if k == 0 and b]
        parts = {k: [b for m, b in given if m == k] for k in range(1, level + 1)}
        del given
        keys, grams, stats = _merged(parts.pop(level), level, shard, shards)
        n, raw, *follow = [np.zeros(len(keys), np.int64) if s is None else s for s in stats]
        columns = {"key": keys, "n": _small(n)}
        if level == 1:
            columns["raw"] = _small(raw)
        if level < order:
            columns |= {name: _small(x) for name, x in zip(STATS[2:], follow, strict=True)}
        _store(folder, f"{level}-{shard}", columns)
        figures = [int((n == k).sum()) for k in range(1, 5)] + [int(n.sum()), int(raw.sum()), int((raw > 0).sum()), int((n > 0).sum())]
        rows.append((0, shard, pickle.dumps((level, figures))))
        del keys, columns, follow, raw, stats
        if level > 1:
            below = [_joined(parts.pop(level - 1), level - 1)]
            below.append(_sums(grams[:, 1:], _only(n=np.ones(len(grams), np.uint8)))[1:])
            below.append(_sums(grams[:, :-1], _only(total=n, ones=n == 1, twos=n == 2, more=n > 2))[1:])
            rows += _dealt(level - 1, *_together(below), shards)
            for k, more in parts.items():
                rows += _dealt(k, *_joined(more, k), shards)
        pa.default_memory_pool().release_unused()
        return pa.Table.from_batches([_rows(rows)])

    # Every shard has a row, so that each writes its file, though it may be empty.
    every = packed.sparkSession.range(shards).select(F.lit(0).alias("level"), F.col("id").cast("int").alias("shard"), F.lit(b"").alias("grams"))
    # As many partitions as shards, so that none grows with the corpus.
    return packed.unionByName(every).repartition(shards, "shard").groupBy("shard").applyInArrow(run, _PACKED)


class Model:
    """Where the arrays of a model lie, and its figures by level."""

    def __init__(self, folder, order, shards):
        self.folder, self.order, self.shards = folder, order, shards
        self.discounts, self.freed, self.types, self.tokens, self.words = {}, 0.0, 0, 0, 0

    def learn(self, figures):
        """Take up the figures of all levels."""
        self.discounts = {level: _discounts(sums[:4]) for level, sums in figures.items()}
        one, two, _, _, self.types, self.tokens, self.words, seen = figures[1]
        # What the discounts take off words is shared out evenly, over all words and one unknown.
        self.freed = float(np.dot(self.discounts[1], [one, two, seen - one - two]))

    def lookup(self, level, keys):
        """How often grams occur at a level; below the highest also how often as words, and the sum and the discounts of
        what follows them. 0 for grams that it does not have."""
        distinct, back = np.unique(keys, return_inverse=True)
        cuts = np.searchsorted(_shard(distinct, self.shards), np.arange(self.shards + 1))
        names = ("n",) if level == self.order else STATS
        found = {name: np.zeros(len(distinct)) for name in names}
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = int(cuts[k]), int(cuts[k + 1])
            columns = _load(self.folder, f"{level}-{k}")
            known = columns["key"]
            place = np.minimum(np.searchsorted(known, distinct[a:b]), max(0, len(known) - 1))
            hit = known[place] == distinct[a:b] if len(known) else np.zeros(b - a, bool)
            for name in names:
                if name in columns:
                    found[name][a:b][hit] = columns[name][place[hit]]
        if level < self.order:
            found["held"] = sum(d * found.pop(name) for d, name in zip(self.discounts[level + 1], STATS[3:], strict=True))
        return {name: values[back] for name, values in found.items()}

    def discounted(self, level, n):
        """Counts less their discounts."""
        return n - np.array([0.0, *self.discounts[level]])[np.minimum(n, 3).astype(np.int64)]

    def score(self, tokens, starts):
        """Per token that is no start: its count as a word in training, and the logarithm of its probability."""
        place = np.arange(len(tokens)) - np.repeat(starts[:-1], np.diff(starts))
        words = self.lookup(1, _keys(tokens[:, None]))
        p = np.full(len(tokens), 1 / (self.words + 1))
        if self.types:
            p = (self.discounted(1, words["n"]) + self.freed * p) / self.types
        before = words
        for level in range(2, self.order + 1):
            at = np.flatnonzero(place >= level - 1)
            grams = self.lookup(level, _keys(np.stack([tokens[at - level + 1 + k] for k in range(level)], 1)))
            # `before` has the grams of the level below by the place they end at: here, what precedes the last token.
            total, held = before["total"][at - 1], before["held"][at - 1]
            seen = total > 0
            p[at[seen]] = (self.discounted(level, grams["n"][seen]) + held[seen] * p[at[seen]]) / total[seen]
            if level < self.order:
                wide = {name: np.zeros(len(tokens)) for name in grams}
                for name, values in grams.items():
                    wide[name][at] = values
                before = wide
        return words["raw"], np.log10(p)


def train(docs, order=ORDER):
    """A `Model` of the texts of `docs` (text); null texts are empty. It lies below the shared folder until dropped.

    The number of shards follows from the bytes of text. The driver gets eight sums for each level. A task that runs again
    writes the same files again, so a lost executor costs what it had not yet shuffled.
    """
    if order < 2:
        raise ValueError("a gram has two words at least")
    spark = docs.sparkSession
    texts = docs.select(F.lit(0).alias("doc_id"), "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    model = Model(new_path(spark, "ngram-model"), order, max(1, -(-size // SHARD_BYTES)))
    packed = _count(texts, order, model.shards)
    for level in range(order, 0, -1):
        packed = _merge(packed, level, order, model.shards, model.folder)

    def figures(batches):
        for batch in batches:
            found = [pickle.loads(b) for b in batch.column(0).to_pylist()]
            yield _rows(found, ("level", "sums"), (pa.int32(), pa.list_(pa.int64())))

    # The one job that counts, merges all levels and writes their files.
    sums = packed.select("grams").mapInArrow(figures, "level int, sums array<bigint>")
    sums = sums.groupBy("level").agg(F.array(*[F.sum(F.col("sums")[k]) for k in range(8)]).alias("sums"))
    model.learn({r["level"]: r["sums"] for r in sums.collect()})
    return model


def score_texts(docs, model):
    """Per row of `docs` (doc_id, text): doc_id, n_tokens, n_known, base_score, score, perplexity.

    Tokens are the words, parted by ASCII white space, with A to Z lower-cased, and one end; `n_known` counts those that the
    training texts hold. `score` is the logarithm to base 10 of the probability of the tokens, `base_score` the same under
    single words with one added to each count. A null or empty text is its end alone. Whole texts are read, a very long one
    at once. Rows that repeat score alike; further columns are ignored; no rows, no rows. A model of no texts gives each
    token the probability of an unknown word.
    """

    def run(batches):
        for piece in _pieces(batches, SCORE_BYTES):
            tokens, starts = _tokens(piece.column(1))
            raw, logs = model.score(tokens, starts)
            rows, sizes = len(piece), np.diff(starts)
            real = np.ones(len(tokens), bool)
            real[starts[:-1]] = False
            row = np.repeat(np.arange(rows), sizes)[real]
            raw, logs = raw[real], logs[real]
            single = np.log10((raw + 1) / (model.tokens + model.words + 1))
            score = np.bincount(row, logs, rows)
            columns = [sizes - 1, np.bincount(row, raw > 0, rows).astype(np.int64), np.bincount(row, single, rows), score, 10 ** np.minimum(300, -score / (sizes - 1))]
            yield pa.RecordBatch.from_arrays([piece.column(0), *map(pa.array, columns)], ["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double, perplexity double")


def held_out(doc_id):
    """Rows that the model of `score_corpus` does not learn from; rows without doc_id are learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def score_corpus(docs, order=ORDER):
    """`score_texts` of all `docs` under a model of those that are not held out, with held_out and train_tokens.

    The scores are written to the shared folder, and the model's files are deleted.
    """
    model = train(docs.where(~held_out(F.col("doc_id"))), order)
    scored = score_texts(docs, model).withColumn("held_out", held_out(F.col("doc_id"))).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
    scored = write_and_read(scored, "ngram-scores")
    drop_path(docs.sparkSession, model.folder)
    return scored
