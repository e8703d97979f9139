"""Token counts by a unigram model: forward scores over a trie of pre-tokens, once per shared prefix.

The model's pieces are those of a public vocabulary. Their log probabilities follow from their ranks by Zipf's law, as rank
files give no counts. The best segmentation of a pre-token maximises the sum of log probabilities, fewer pieces first
among equals; the count of a text is the sum over its pre-tokens.
"""

import base64
import math

import pyarrow as pa
import regex
from pyspark.sql import functions as F

#: Nodes of a task's trie, and pre-tokens whose count it remembers, before it starts anew.
MOST_NODES, MOST_WORDS = 2_000_000, 400_000


def read_ranks(path):
    """Pieces and their log probabilities from lines 'base64 rank'."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    total = math.log(sum(1.0 / (r + 1) for r in ranks.values()))
    return {piece: -math.log(r + 1) - total for piece, r in ranks.items()}


class Trie:
    """Forward scores by prefix: of all segmentations of the prefix, the best score and its number of pieces."""

    def __init__(self, scores):
        self.scores = scores
        self.longest = max(map(len, scores))
        self.words = {}
        self._clear()

    def _clear(self):
        self.next, self.forward = {}, [(0.0, 0)]

    def insert(self, word):
        """Number of pieces of a pre-token, stored at its last node."""
        node, path = 0, [0]
        forward, scores = self.forward, self.scores
        for depth in range(1, len(word) + 1):
            key = node << 8 | word[depth - 1]
            child = self.next.get(key)
            if child is None:
                child = self.next[key] = len(forward)
                best = (-math.inf, 0)
                for start in range(max(0, depth - self.longest), depth):
                    score = scores.get(word[start:depth])
                    if score is not None:
                        value, pieces = forward[path[start]]
                        best = max(best, (value + score, pieces - 1))
                forward.append(best)
            node = child
            path.append(node)
        return -forward[node][1]

    def count(self, pretoken):
        """Number of pieces, remembered; the trie holds each prefix once and is cut down when it is full."""
        known = self.words.get(pretoken)
        if known is None:
            if len(self.forward) >= MOST_NODES:
                self._clear()
            if len(self.words) >= MOST_WORDS:
                self.words.clear()
            known = self.insert(pretoken.encode())
            if len(pretoken) < 64:
                self.words[pretoken] = known
        return known


def count_tokens(docs, path, pattern):
    """Per row of `docs`: doc_id, n_pretokens, n_tokens, in one narrow pass over whole texts.

    `path` names the rank file, `pattern` parts texts into pre-tokens. A null or empty text counts 0; further columns are
    ignored. A pre-token of thousands of letters takes time in proportion to it; a task's memory is bounded by the two
    numbers above and its longest text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches):
        trie, pieces = Trie(shared.value), regex.compile(pattern)
        for batch in batches:
            words, tokens = [], []
            for x in batch.column(1):
                found = pieces.findall(x.as_py() or "")
                words.append(len(found))
                tokens.append(sum(map(trie.count, found)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_pretokens", "n_tokens"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text")).mapInArrow(run, f"doc_id {kind}, n_pretokens bigint, n_tokens bigint")
