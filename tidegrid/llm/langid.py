"""Language identification by error-correcting output codes.

Every language has a codeword. For each bit a binary classifier over hashed
character 2- and 3-grams (log odds of the languages whose bit is set against the
rest) votes with its mean over the text. Decoding is loss-weighted: a classifier
counts for a language by how often it was right on that language's sample, and
the codeword with the least logistic loss wins. A narrow lead is flagged.

It is fitted on at most sample_rows rows a language (drawn by a hash of doc_id,
the share set from counts over all rows), and predicts from the whole text alone.

Defined results: `und` with score 0 where the text is null or has no letter, or no
language was learned; repeated rows get equal results; an empty table gives an
empty result; columns other than doc_id, text and (for fitting) lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import lean, per_process

BUCKETS = 1 << 16
CHUNK = 1 << 16
#: Mean log odds are multiplied by this before the logistic loss.
SHARPNESS = 4.0
#: A lead in score below this is ambiguous.
NARROW = 0.05
UNKNOWN = "und"


def codewords(n: int) -> np.ndarray:
    """n rows of -1 and 1: the exhaustive code up to 7 languages, else the best-separated of 32 seeded random ones."""
    if n <= 7:
        bits = [b for b in product((-1, 1), repeat=n) if b[:1] == (1,) and -1 in b]
        return np.array(bits or [(1,)], np.float32).T.reshape(n, -1)
    tries = [np.random.default_rng(s).choice(np.array([-1, 1], np.float32), (n, 10 * n.bit_length())) for s in range(32)]
    return max(tries, key=lambda c: -np.max(c @ c.T - 1e9 * np.eye(n)))


def letters() -> np.ndarray:
    """By code point below 65,536: the lower-case letter, or 32."""
    kept = per_process()
    if "letters" not in kept:
        low = [chr(c).lower() if chr(c).isalpha() else " " for c in range(0x10000)]
        kept["letters"] = np.array([ord(x) if len(x) == 1 else c for c, x in enumerate(low)], np.uint32)
    return kept["letters"]


def lowered(c: np.ndarray) -> np.ndarray:
    """Code points with letters in lower case and everything else 32."""
    out = letters()[np.minimum(c, 0xFFFF)]
    high = c > 0xFFFF
    if high.any():  # told by the distinct code points of the chunk
        points, at = np.unique(c[high], return_inverse=True)
        low = [chr(x).lower() if chr(x).isalpha() else " " for x in points.tolist()]
        out[high] = np.array([ord(x) if len(x) == 1 else c for c, x in zip(points.tolist(), low, strict=True)], np.uint32)[at]
    return out


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the character 2- and 3-grams of text that hold a letter, chunk by chunk."""
    for lo in range(0, len(text), CHUNK):
        c = np.frombuffer(text[max(0, lo - 2) : lo + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.concatenate([np.full(1, 32, np.uint32), lowered(c), np.full(1, 32, np.uint32)])
        two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA6B)
        three = (two[:-1] ^ (two[:-1] >> np.uint32(15))) * np.uint32(0xC2B2AE35) + c[2:] * np.uint32(0x27D4EB2F)
        has = (c[:-1] != 32) | (c[1:] != 32)
        yield np.concatenate([(two[has] >> np.uint32(16)), (three[has[:-1] | (c[2:] != 32)] >> np.uint32(16))])


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weight: np.ndarray  # buckets x bits
    trust: np.ndarray  # languages x bits

    def sent(self, rows: DataFrame):
        """Its fields as a broadcast, which needs no module of ours on the executors: BUCKETS x bits numbers."""
        return rows.sparkSession.sparkContext.broadcast((self.langs, self.code, self.weight, self.trust))

    def bits(self, text: str) -> np.ndarray | None:
        """The mean vote of each bit; None if text has no letter."""
        total, n = np.zeros(self.code.shape[1]), 0
        for g in grams(text):
            total += self.weight[g].sum(0, dtype=np.float64)
            n += len(g)
        return total / n if n else None

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, score and whether the lead is narrow."""
        if not self.langs or (votes := self.bits(text)) is None:
            return UNKNOWN, 0.0, True
        loss = (self.trust * np.logaddexp(0, -SHARPNESS * self.code * votes)).sum(1) / self.trust.sum(1)
        p = np.exp(loss.min() - loss)
        p /= p.sum()
        k = int(p.argmax())
        return self.langs[k], float(p[k]), bool(len(p) > 1 and p[k] - np.partition(p, -2)[-2] < NARROW)


def fit(rows: DataFrame, sample_rows: int = 4000) -> Model:
    """Model of the languages of rows (text, lang, doc_id); rows without a language teach nothing."""
    rows = rows.filter(F.col("lang").isNotNull()).select(F.col("doc_id").cast("string").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a language
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((0, 1)), np.zeros((BUCKETS, 1), np.float32), np.zeros((0, 1)))
    share = F.element_at(F.create_map(*[F.lit(x) for lang in langs for x in (lang, int(min(1.0, sample_rows / counts[lang]) * (1 << 20)))]), F.col("lang"))
    sample = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share).select("lang", "text")
    index = {x: k for k, x in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for g in grams(text or ""):
                    n.setdefault(index[lang], np.zeros(BUCKETS, np.int64))[:] += np.bincount(g, minlength=BUCKETS)
        for k, v in n.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(v[at])], ["k", "at", "n"])

    table = np.zeros((len(langs), BUCKETS))
    # At most BUCKETS rows a language.
    got = sample.mapInArrow(lean(count), "k int, at int, n long").groupBy("k", "at").agg(F.sum("n").alias("n")).toPandas()
    table[got["k"], got["at"]] = got["n"]
    # Each language counts alike, however many rows it has.
    rate = (table + 0.5) / (table.sum(1, keepdims=True) + 0.5 * BUCKETS)
    code = codewords(len(langs))
    ones, zeros = (code > 0).astype(float), (code < 0).astype(float)
    mean = lambda side: (side.T @ rate) / np.maximum(1, side.sum(0))[:, None]
    weight = np.log((mean(ones) + 1e-9) / (mean(zeros) + 1e-9)).T.astype(np.float32) if len(langs) > 1 else np.ones((BUCKETS, 1), np.float32)
    model = Model(langs, code, weight, np.ones(code.shape))
    sent = model.sent(rows)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        right = np.zeros((len(m.langs), m.code.shape[1] + 1), np.int64)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (votes := m.bits(text or "")) is not None:
                    k = index[lang]
                    right[k, :-1] += np.sign(votes) == m.code[k]
                    right[k, -1] += 1
        k, b = np.nonzero(right)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(right[k, b])], ["k", "b", "n"])

    right = np.zeros((len(langs), code.shape[1] + 1))
    got = sample.mapInArrow(lean(check), "k int, b int, n long").groupBy("k", "b").agg(F.sum("n").alias("n")).toPandas()
    right[got["k"], got["b"]] = got["n"]
    model.trust = (right[:, :-1] + 1) / (right[:, -1:] + 2)
    return model


#: Texts whose results are sent on together.
TEXTS = 500


def _judged(texts: pa.Array, model: Model) -> tuple[pa.Array, pa.Array, pa.Array]:
    lang, score, narrow = zip(*[model.predict(x or "") for x in texts.to_pylist()], strict=True) if len(texts) else ((), (), ())
    return pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(narrow, pa.bool_())


def _parts(batches: Iterator[pa.RecordBatch | pa.Array]) -> Iterator[pa.RecordBatch | pa.Array]:
    for batch in batches:
        for lo in range(0, len(batch), TEXTS):
            yield batch.slice(lo, TEXTS)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and ambiguous for every row of docs."""
    sent = model.sent(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for part in _parts(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), *_judged(part.column(1), m)], ["doc_id", "lang_pred", "score", "ambiguous"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(lean(run), "doc_id long, lang_pred string, score double, ambiguous boolean")


def recognised(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all their columns whatever these are called, whose language is told and not ambiguous."""
    sent = model.sent(docs)

    def told(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Model(*sent.value)
        for part in _parts(texts):
            lang, _, narrow = _judged(part, m)
            yield pc.and_(pc.not_equal(lang, UNKNOWN), pc.invert(narrow))

    # Only texts go to Python and a bit for each comes back: whole rows would stand there and on both ways in lots of thousands.
    return docs.filter(F.arrow_udf(lean(told), "boolean")(F.col("text").cast("string")))


def held_out() -> Column:
    """Rows that never teach: crc32 of doc_id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
