"""Word-piece counts by a linear longest-match automaton.

The vocabulary is a trie over symbols (the bytes of a word, the last marked as the
word's end). A failure link leads from a node to the node that holds what is left
when the longest pieces of its path are taken off; how many are taken off is
counted beforehand. One pass over a word then gives the number of pieces that
greedy longest-match-first splitting makes, without making any piece.

Defined results: a null or empty text has no words and no tokens; repeated rows,
empty tables and other columns don't matter. Counts are cached by word up to a bound.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.bpe_automaton import END, WordSplit
from tidegrid.llm.common import per_process

WORD_CACHE = 400_000


class LongestMatch:
    """Trie, failure links and popped counts of a vocabulary that holds every single symbol."""

    def __init__(self, pieces: list[str]):
        self.child: list[dict[str, int]] = [{}]
        piece = array("b", [0])
        for p in pieces:
            node = 0
            for c in self.marked(p.removesuffix(END), p.endswith(END)):
                nxt = self.child[node].get(c)
                if nxt is None:
                    nxt = self.child[node][c] = len(self.child)
                    self.child.append({})
                    piece.append(0)
                node = nxt
            piece[node] = 1
        self.fail, self.popped = array("i", [0]) * len(self.child), array("i", [0]) * len(self.child)
        level = [(0, c, v) for c, v in self.child[0].items()]
        while level:
            below = []
            for u, c, v in level:
                if piece[v]:
                    self.fail[v], self.popped[v] = 0, 1
                else:
                    z, n = self.fail[u], self.popped[u]
                    while c not in self.child[z]:
                        n += self.popped[z]
                        z = self.fail[z]
                    self.fail[v], self.popped[v] = self.child[z][c], n
                below += [(v, c2, w) for c2, w in self.child[v].items()]
            level = below

    @staticmethod
    def marked(symbols: str, ends: bool) -> str:
        """The last symbol of a word is another symbol than the same one inside it."""
        return symbols[:-1] + chr(ord(symbols[-1]) + 0x10000) if ends else symbols

    def count(self, symbols: str) -> int:
        child, fail, popped, u, n = self.child, self.fail, self.popped, 0, 0
        for c in self.marked(symbols, True):
            while c not in child[u]:
                n += popped[u]
                u = fail[u]
            u = child[u][c]
        while u:
            n += popped[u]
            u = fail[u]
        return n


class WordCounts:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = [t["content"] for t in spec["added_tokens"]]
        self.split = WordSplit(special)
        self.match = LongestMatch([p for p in spec["model"]["vocab"] if p not in special])
        self.of: dict[str, int] = {}

    def count(self, text: str) -> tuple[int, int]:
        """Words and tokens of text; a special token is one of both."""
        n_words = n = 0
        for special, part in self.split.parts(text):
            if special:
                n_words, n = n_words + 1, n + 1
                continue
            words = self.split.words(part)
            n_words += len(words)
            try:
                n += sum(map(self.of.__getitem__, words))
            except KeyError:
                if len(self.of) > WORD_CACHE:
                    self.of.clear()
                for w in set(words):
                    if w not in self.of:
                        self.of[w] = self.match.count(self.split.symbols(w))
                n += sum(map(self.of.__getitem__, words))
        return n_words, n


def word_counts(path: str) -> WordCounts:
    kept = per_process()
    if ("word_counts", path) not in kept:
        kept["word_counts", path] = WordCounts(path)
    return kept["word_counts", path]


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_words and n_tokens of every text of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = word_counts(vocabulary_path)
        for batch in batches:
            both = [counts.count(x or "") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in both], pa.int64()), pa.array([x for _, x in both], pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_words long, n_tokens long")
