"""BPE encoding and decoding by a tokenization automaton.

The automaton reads words of a BPE with word ends and emits one label (token) per
arc. It starts as one state with an arc for each base symbol and takes the merges
in order. The gadget of a merge (u, v) -> w gives every state that has an arc u an
arc w as well, leads it to a copy of the state behind v, and deletes the arc v
behind u. Since the state behind an arc is determined by its label, the gadgets
are kept as three tables over labels (where an arc was copied from, which state
was copied, which arc was deleted when); a transition is looked up in them, and
in a bounded table of those already determined. Exactly one path reads a prefix
of a word, so encoding walks the word once, keeping the last label per prefix.
Decoding writes the labels of the path.

Defined results: a null or empty text has no ids and decodes to the empty text;
repeated rows, empty tables and other columns don't matter. Words are cached up to
a bound, so memory does not follow the corpus.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import per_process, splitter

WORD_CACHE = 400_000
ARC_CACHE = 4_000_000
#: The pre-split of the word-end vocabulary and its end mark, fixed values of its format.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
NEVER = 1 << 60


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if it prints in Latin-1, else the next from 256 on."""
    own = [b for b in range(256) if chr(b).isprintable() and b != 32 and b != 0xA0 and b != 0xAD]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


class WordSplit:
    """What the vocabulary does to a text before merging: special tokens, NFC, white space, lower case, pre-split."""

    def __init__(self, special: list[str]):
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.split = splitter(SPLIT)
        self.table = byte_alphabet()

    def parts(self, text: str) -> list[tuple[bool, str]]:
        """(is a special token, the part) of text."""
        if self.special is None or not self.special.search(text):
            return [(False, text)]
        return [(k % 2 == 1, x) for k, x in enumerate(self.special.split(text)) if x]

    def words(self, part: str) -> list[str]:
        if not part.isascii():
            part = unicodedata.normalize("NFC", part)
        # A sigma at a word's end has its own lower case in str.lower, not here.
        return self.split("".join(map(str.lower, part)) if "Σ" in part else part.lower())

    def symbols(self, word: str) -> str:
        """One character a byte."""
        return "".join([self.table[b] for b in word.encode("utf-8", "surrogatepass")])


class Automaton:
    """vocab: id by label; merges: pairs of labels in order."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        n = max(vocab.values()) + 1
        self.vocab, self.labels = vocab, [""] * n
        for k, v in vocab.items():
            self.labels[v] = k
        self.born = array("q", [-1]) * n
        self.copied_arc, self.copied_state = array("q", [-1]) * n, array("q", [-1]) * n
        self.deleted: dict[tuple[int, int], int] = {}
        for k, (a, b) in enumerate(merges):
            self.gadget(k, vocab[a], vocab[b], vocab[a + b])
        self.last: dict[tuple[int, int], int] = {}
        self.longest = max(len(x.removesuffix(END)) for x in vocab)

    def gadget(self, k: int, u: int, v: int, w: int) -> None:
        if self.born[w] < 0:
            self.born[w], self.copied_arc[w], self.copied_state[w] = k, u, v
        self.deleted.setdefault((u, v), k)
        if u == v:  # a run of u pairs up from its left, so none is left before a pair
            self.deleted.setdefault((u, w), k)

    def until(self, p: int, x: int) -> int:
        """The merge that deletes arc x behind label p; NEVER if it stays, -1 if it never was."""
        key = (p, x)
        if (t := self.last.get(key)) is not None:
            return t
        born = max(self.born[p], self.born[x])
        t = self.deleted.get(key, NEVER)
        if t < born:
            t = -1
        elif born >= 0:
            # The younger label came by copying: its arc from that of u, or its state from that of v.
            before = self.until(p, self.copied_arc[x]) if self.born[x] > self.born[p] else self.until(self.copied_state[p], x)
            if p == x:
                before = self.until(self.copied_state[p], self.copied_arc[x])
            if before < born:
                t = -1
        if len(self.last) > ARC_CACHE:
            self.last.clear()
        self.last[key] = t
        return t

    def path(self, word: str) -> list[int]:
        """The labels of the only path that reads word (one character a byte, its end implied)."""
        n, vocab, until = len(word), self.vocab, self.until
        if (whole := vocab.get(word + END)) is not None and n == 1:
            return [whole]
        at: list[int] = [-1] * (n + 1)
        for i in range(1, n + 1):
            for j in range(max(0, i - self.longest), i):
                x = vocab.get(word[j:i] if i < n else word[j:] + END)
                if x is not None and (j == 0 or until(at[j], x) == NEVER):
                    at[i] = x
                    break
        out, i = [], n
        while i:
            out.append(at[i])
            i -= len(self.labels[at[i]].removesuffix(END)) if i == n else len(self.labels[at[i]])
        return out[::-1]


class WordBpe:
    """Encoder and decoder of whole texts for a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = WordSplit(list(self.special))
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.automaton = Automaton(spec["model"]["vocab"], merges)
        self.ids: dict[str, bytes] = {}
        names = {v: k for k, v in self.special.items()}
        labels = self.automaton.labels
        #: The arc label of each id, or the special token's text.
        self.label = [names.get(x) or (labels[x] if x < len(labels) else None) for x in range(max([len(labels) - 1, *names]) + 1)]

    def learn(self, words: list[str]) -> None:
        if len(self.ids) > WORD_CACHE:
            self.ids.clear()
        for w in set(words):
            if w not in self.ids:
                self.ids[w] = array("I", self.automaton.path(self.split.symbols(w))).tobytes()

    def encode(self, text: str) -> tuple[bytes, str]:
        """Little-endian unsigned 32-bit ids of text, and the text that these ids decode to."""
        ids = []
        for special, part in self.split.parts(text):
            if special:
                ids.append(array("I", [self.special[part]]).tobytes())
                continue
            words = self.split.words(part)
            try:
                ids.append(b"".join(map(self.ids.__getitem__, words)))
            except KeyError:
                self.learn(words)
                ids.append(b"".join(map(self.ids.__getitem__, words)))
        out = b"".join(ids)
        return out, self.decode(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids: the labels of their arcs joined by spaces, special tokens kept."""
        a = array("I")
        a.frombytes(ids)
        return " ".join(map(self.label.__getitem__, a))


def word_bpe(path: str) -> WordBpe:
    kept = per_process()
    if ("word_bpe", path) not in kept:
        kept["word_bpe", path] = WordBpe(path)
    return kept["word_bpe", path]


def encoded(docs: DataFrame, tokenizer_path: str, with_text: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and decoded of every text; or, without the
    texts, their SHA-256 in place of ids and decoded, so that nothing large leaves the Python worker."""
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string()) if with_text else (pa.int64(), pa.int64(), pa.string(), pa.string())
    names = ["doc_id", "n_tokens", *(["ids", "decoded"] if with_text else ["ids_sha256", "decoded_sha256"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part, rows = batch.slice(lo, 1000), []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids, out = bpe.encode(text or "")
                    if not with_text:
                        rows.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(out.encode()).hexdigest()))
                    else:
                        rows.append((doc, len(ids) // 4, ids, out))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "doc_id long, n_tokens long, " + ("ids binary, decoded string" if with_text else "ids_sha256 string, decoded_sha256 string")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
