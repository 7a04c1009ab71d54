"""Best-fit packing of tokenised documents by the sum-of-squares rule.

Documents become ids of a byte-level BPE plus an end id. One longer than the
capacity is cut so that only its first piece may be shorter. Pieces are dealt to
tasks by a hash of the document, sorted by falling length, and placed one at a
time: each goes to the residual gap (or a new sequence) for which the sum over
gaps of (open sequences with that gap) squared becomes smallest.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each on their own; an empty table gives an empty result; other columns of
the input are not read. Only a document's own pieces and one counter per gap are
held, so memory does not follow the corpus.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import lean, per_process

#: Distinct pre-split words whose ids a Python worker keeps.
WORD_CACHE = 300_000
#: Texts, and bytes of them unless one alone has more, that are split at a time.
TEXTS, TEXT_BYTES = 500, 2 << 20
#: Documents a packing task handles; open sequences at its end are what splitting costs.
DOCS_PER_TASK = 25_000
#: The pre-split of the byte-level vocabulary, a fixed value of its format; bounds() follows it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The characters by which a byte-level vocabulary names bytes, fixed too: printable ones name themselves, the others go on from 256.
ALPHABET = np.arange(256, dtype="<u2")
ALPHABET[[*range(33), *range(127, 161), 173]] = np.arange(256, 256 + 68)
#: Classes of characters in SPLIT: white space, letters, numbers, others.
SPACE, LETTER, NUMBER, OTHER = range(4)
PIECES = "doc_id long, piece int, start long, length long, ids binary"


def classes() -> np.ndarray:
    """The class of each code point."""
    import regex

    out, every = np.full(0x110000, OTHER, np.uint8), np.arange(0x110000, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    for k, name in ((SPACE, "White_Space"), (LETTER, "L"), (NUMBER, "N")):
        for m in regex.finditer(rf"\p{{{name}}}+", every):
            out[m.start() : m.end()] = k
    return out


def bounds(data: np.ndarray, at: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Where the words by SPLIT begin in the UTF-8 bytes of texts that begin at these places, and the end; known are classes().

    All steps are over whole arrays. A byte has the class of its character.
    """
    end = len(data)
    kind = np.frombuffer(data.tobytes().translate(known[:256].tobytes()), np.uint8)
    if end and data.max() > 127:
        kind = kind.copy()
        lead = np.flatnonzero(data >= 0xC0)
        code = np.frombuffer(data[data > 127].tobytes().decode().encode("utf-32-le"), "<u4")
        for k, least in enumerate((0, 0, 0x800, 0x10000)):
            long = code >= least
            kind[lead[long] + k] = known[code[long]]
    first = np.zeros(end + 4, bool)  # of a text; behind the end too
    first[at] = first[end:] = True
    begins = first.copy()
    begins[1:end] |= kind[1:] != kind[:-1]
    # The last white space before anything else stands alone, or goes with it if it is a blank.
    after = 1 + np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE))
    after = after[~first[after]]
    last = after - 1
    while len(inner := np.flatnonzero(data[last] & 0xC0 == 0x80)):
        last[inner] -= 1
    begins[last] = True
    begins[after] = data[last] != 32
    # 's, 't, 'm, 'd, 're, 've and 'll are words where a word begins.
    quote = np.flatnonzero(data == 39)
    quote = quote[begins[quote] & ~first[quote + 1]]
    if len(quote):
        more = np.concatenate([data, np.zeros(3, np.uint8)])
        one, two = more[quote + 1], more[quote + 2]
        short = np.isin(one, list(b"stmd"))
        long = ~first[quote + 2] & ((two == 101) & ((one == 114) | (one == 118)) | (two == 108) & (one == 108))
        begins[quote[short | long] + 1] = False
        begins[quote[short] + 2] = True
        begins[quote[long] + 3] = True
    begins[end] = True
    return np.flatnonzero(begins[: end + 1])


class ByteBpe:
    """Ids of whole texts by the tokenizers library, which is asked for distinct pre-split words.

    Texts are split and words made distinct in Arrow's and NumPy's arrays; only distinct words of a lot become Python's objects.
    Those met first stay known, since frequent words come early; the others are asked for again with each lot of texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.tokenize = self.tok.model.tokenize
        self.classes = classes()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def asked(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each word by the library's merges alone: it needs no splitting, and a whole encoding costs twice as much."""
        # All are named by one look into ALPHABET; 255, which is no byte of UTF-8, names itself and parts them.
        named = ALPHABET[np.frombuffer(b"\xff".join(x.encode() for x in words), np.uint8)].tobytes().decode("utf-16-le").split("\xff") if words else []
        return (array("I", [t.id for t in self.tokenize(x)]).tobytes() for x in named)

    def ids(self, words: list[str]) -> list[bytes]:
        """Ids of each of these distinct words."""
        found = list(map(self.words.get, words))
        new = [k for k, x in enumerate(found) if x is None]
        full = len(self.words) + len(new) > WORD_CACHE
        if full and 2 * len(new) > len(words):  # other texts than before
            self.words.clear()
            new, full = range(len(words)), len(words) > WORD_CACHE
        ask = [words[k] for k in new]
        for k, x in zip(new, self.asked(ask), strict=True):
            found[k] = x
        if not full:
            self.words.update(zip(ask, (found[k] for k in new), strict=True))
        return found

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text of an Arrow array; a null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        _, ends, data = texts.buffers()
        ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        lo, hi = int(ends[0]), int(ends[-1])
        if lo == hi:
            return [b""] * len(texts)
        data, ends = np.frombuffer(data, np.uint8)[lo:hi], ends - lo
        begins = bounds(data, ends[:-1], self.classes)
        words = pa.Array.from_buffers(pa.large_string(), len(begins) - 1, [None, pa.py_buffer(begins), pa.py_buffer(data)]).dictionary_encode()
        all_ids = pa.array(self.ids(words.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(words.indices)
        _, upto, flat = all_ids.buffers()
        flat = memoryview(flat)
        upto = np.frombuffer(upto, np.int64)[all_ids.offset + np.searchsorted(begins, ends)].tolist()
        out = [flat[a:b].tobytes() for a, b in zip(upto, upto[1:], strict=False)]
        raw = data.tobytes()
        if any(s.encode() in raw for s in self.special):
            for k, x in enumerate(texts.to_pylist()):
                if any(s in x for s in self.special):
                    out[k] = self.whole(x)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_column(pa.array(texts, pa.string()))


def byte_bpe(path: str) -> ByteBpe:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    kept = per_process()
    if ("byte_bpe", path) not in kept:
        kept["byte_bpe", path] = ByteBpe(path)
    return kept["byte_bpe", path]


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of total ids."""
    if total <= capacity:
        return [(0, total)]
    first = total % capacity
    return [(0, first)] * (first > 0) + [(at, capacity) for at in range(first, total, capacity)]


class SumOfSquares:
    """Open sequences of one task by residual gap."""

    def __init__(self, capacity: int):
        self.capacity, self.made = capacity, 0
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def place(self, size: int) -> tuple[int, int]:
        """Sequence and offset of the next piece; offsets are gapless since a sequence is filled from its start."""
        c, n = self.capacity, self.count
        # Moving a sequence from gap g to g - size changes the sum of squares by 2 (n[g - size] - n[g]) + 2,
        # by 1 - 2 n[g] when it closes, and by 2 n[c - size] + 1 when a new one opens.
        gaps = n[size : c]
        best, at = 2 * int(n[c - size]) + 1 if size < c else 0, c
        if len(gaps):
            cost = np.where(gaps > 0, 2 * (n[: c - size] - gaps) + 2, 1 << 60)
            if gaps[0]:
                cost[0] = 1 - 2 * gaps[0]
            k = int(cost.argmin())
            if cost[k] <= best:
                at = k + size
        if at == c:
            seq, self.made = self.made, self.made + 1
        else:
            seq = self.open[at].pop()
            n[at] -= 1
        if at > size:
            self.open[at - size].append(seq)
            n[at - size] += 1
        return seq, c - at


def lots(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch by TEXTS and by TEXT_BYTES of a column."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < batch.num_rows:
        most = (upto[lo - 1] if lo else 0) + TEXT_BYTES
        n = max(1, min(TEXTS, int(np.searchsorted(upto, most, "right")) - lo))
        yield batch.slice(lo, n)
        lo += n


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of every piece of docs."""
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer_path)
        for batch in batches:
            for part in lots(batch, 1):
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), bpe.encode_column(part.column(1)), strict=True):
                    ids += end
                    rows += [(doc, k, at, n, ids[4 * at : 4 * (at + n)]) for k, (at, n) in enumerate(cut(len(ids) // 4, capacity))]
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lean(run), PIECES)


def pack(pieces: DataFrame, tasks: int, capacity: int = 2048) -> DataFrame:
    """pieces with sequence_id and offset. A sequence belongs to one task; its number holds the task's.

    Only lengths go to Python: ids, up to four times the capacity a piece, would stand there and on the way in lots of thousands.
    """

    def run(lengths: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from pyspark import TaskContext

        base, bins = TaskContext.get().partitionId() << 40, SumOfSquares(capacity)
        for batch in lengths:
            placed = [bins.place(n) for n in batch.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([base + s for s, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())], ["sequence_id", "offset"])

    # Not deterministic for the optimiser: it follows the order of rows and runs once for each.
    place = F.arrow_udf(run, "sequence_id long, offset long").asNondeterministic()
    dealt = pieces.repartition(tasks, F.xxhash64("doc_id", "piece")).sortWithinPartitions(F.desc("length"), "doc_id", "piece")
    return dealt.withColumn("_at", place("length")).select(*pieces.columns, "_at.sequence_id", "_at.offset")


def packed(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Every piece of docs with its ids and its place in a sequence of at most capacity ids."""
    tasks = max(1, -(-docs.count() // DOCS_PER_TASK))
    return pack(tokenized_pieces(docs, tokenizer_path, capacity, end_id), tasks, capacity)
