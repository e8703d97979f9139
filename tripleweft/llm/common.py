"""What the operators of this subpackage share: words, 64-bit hashes, union of labels."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

# Fixed value: a word of every contract here; ASCII white space parts words, nothing else does.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text):
    """Number of words of a text column, 0 for null, as a long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def split_words(data):
    """Words of UTF-8 bytes: `bytes.split()` parts at just the white space of `WORD`."""
    return data.split() if data else []


class WordHashes(dict):
    """64-bit hash by word; forgets everything once it holds `most` words, so memory is bounded."""

    def __init__(self, most=200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word):
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.most:
            self[word] = value
        return value

    def of(self, words):
        """Hashes of a list of words as an array of uint64."""
        if len(self) >= self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Memory(dict):
    """What `make` gives for a key. It remembers the last `most` to twice as many distinct short keys that were asked for."""

    def __init__(self, make, most, longest=64):
        super().__init__()
        self.make, self.most, self.longest, self.older = make, most, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if self.longest and len(key) >= self.longest:
                return value
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value

    def forget(self):
        self.older = {}
        self.clear()


def mixed(x):
    """A bijective scramble of uint64 values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(h, size):
    """Hash of every run of `size` consecutive values of `h`; empty if there are fewer."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = mixed(out + np.uint64(i + 1)) + h[i : i + n]
    return mixed(out)


class Groups:
    """Disjoint sets of 0..n-1; the root of a set is its smallest member."""

    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a, b):
        """Unite the sets of a and b; False if they were one already."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def whole_groups(batches, keys):
    """Tables of whole groups from batches that are sorted by their integer `keys`, with the row each group starts at.

    Small groups come many at once, so that the work on them can be vectorised; the last group of a batch waits for its
    rest, so a task holds a batch and one group.
    """
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = (pa.concat_tables([held, rows]) if held is not None else rows).combine_chunks()
        if not rows.num_rows:
            continue
        new = np.zeros(rows.num_rows, bool)
        new[0] = True
        for key in keys:
            values = rows.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(new)
        if len(starts) > 1:
            yield rows.slice(0, int(starts[-1])), starts[:-1]
        held = rows.slice(int(starts[-1]))
    if held is not None:
        yield held, np.zeros(1, np.int64)
