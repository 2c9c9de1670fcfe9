"""Token counts by unigram segmentation, shared over prefixes in a trie.

Texts are cut into pre-tokens. Every distinct pre-token goes into a trie once;
a node holds the best score of any segmentation of its path and how many tokens
that takes, computed from the nodes above it: the pieces that end at the node
each start at one of its ancestors. Pre-tokens with a common prefix thus share
its forward scores, and a pre-token's count is read at its last node.
"""

from __future__ import annotations

import base64
import math

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens.llm.remembered import Remembered
from streetlens.llm.tables import text_batches

NODES = 400_000  # nodes kept by a Python worker before it starts a new trie
COUNTS = 150_000  # terminal counts of a generation in a Python worker
SHIFT = 2.7  # of the rank in the score


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a vocabulary file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Trie:
    """Forward scores of all pre-tokens met so far.

    A piece of rank r scores -log(r + SHIFT), which follows the usual falling of
    frequency with rank. Of equal scores the one with fewer tokens wins. All
    single bytes must be pieces, so every text can be segmented.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary must have all single bytes")
        # pieces by their bytes in reverse order, as a tree: from a node upwards, its ancestors tell which pieces end there
        self.root: list = [{}, None]
        for piece, rank in ranks.items():
            at = self.root
            for b in reversed(piece):
                at = at[0].setdefault(b, [{}, None])
            at[1] = -math.log(rank + SHIFT)
        self.counts = Remembered(COUNTS)
        self.clear()

    def clear(self) -> None:
        self.edges: dict[int, int] = {}  # child by parent and byte
        self.best: list[float] = [0.0]
        self.tokens: list[int] = [0]

    def insert(self, text: str) -> int:
        """Number of tokens of a pre-token; only nodes that are new are computed."""
        raw = text.encode("utf-8", "surrogatepass")
        edges, best, tokens = self.edges, self.best, self.tokens
        path = [0]
        node = 0
        for depth, b in enumerate(raw):
            nxt = edges.get(node << 8 | b)
            if nxt is None:
                nxt = len(best)
                edges[node << 8 | b] = nxt
                top, few = -math.inf, 0
                at, k = self.root, depth
                while k >= 0:
                    at = at[0].get(raw[k])
                    if at is None:
                        break
                    if at[1] is not None:
                        start = path[k]
                        score, many = best[start] + at[1], tokens[start] + 1
                        if score > top or score == top and many < few:
                            top, few = score, many
                    k -= 1
                best.append(top)
                tokens.append(few)
            node = nxt
            path.append(node)
        return tokens[node]  # the terminal's count

    def count(self, pretokens: list[str]) -> int:
        if len(self.best) > NODES:
            self.clear()
        self.counts.turn()
        for p in self.counts.missing(set(pretokens)):
            self.counts.new[p] = self.insert(p)
        return sum(map(self.counts.new.__getitem__, pretokens))


_TRIES: dict[int, Trie] = {}


def _trie(ranks: dict[bytes, int]) -> Trie:
    """One trie per Python worker and vocabulary."""
    key = hash(frozenset(ranks.items()))
    if key not in _TRIES:
        _TRIES.clear()
        _TRIES[key] = Trie(ranks)
    return _TRIES[key]


def _counted(ranks: dict[bytes, int], pattern: str, names: list[str]):
    def run(batches):
        trie, find = _trie(ranks), regex.compile(pattern).findall
        for batch in batches:
            many, total = [], []
            for text in batch["_text"]:
                pretokens = find(text.as_py() or "")
                many.append(len(pretokens))
                total.append(trie.count(pretokens))
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(many, pa.int64()), pa.array(total, pa.int64())], names=[*names, "n_pretokens", "n_tokens"]
            )

    return run


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_pretokens and n_tokens (long).

    ``vocabulary`` is the path of a rank file, read by the driver and sent with
    the tasks; ``pattern`` cuts pre-tokens. A null or empty text has zeros.
    Columns of ``docs`` named like a result are replaced.
    """
    text_batches(docs)
    names = [c for c in docs.columns if c not in (text, "n_pretokens", "n_tokens", "_text")]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name in names)
    return docs.select(*names, F.col(text).cast("string").alias("_text")).mapInArrow(
        _counted(read_ranks(vocabulary), pattern, names), f"{schema}n_pretokens long, n_tokens long"
    )
