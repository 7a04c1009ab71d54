"""Jaccard self-join of documents on word n-grams, by rare-first prefix filtering.

A document is the set of its distinct n-word shingles. All shingles stand in one order, rare before frequent, by
their exact numbers of sets over all documents. Two sets that reach the threshold share a shingle in their prefixes,
and a shingle of one set alone can't be shared, so of a set only those shingles travel on that stand in its prefix and
that another set has as well. Pairs that meet pass the length and positional filters and, with their sets at hand, the
suffix filter; then they are verified once.

The counts: equal sets are one node over all tasks, named by the smallest doc_id. Each task deals the shingles of its
nodes, packed, to shards by their leading bits; as many shards as the corpus needs. A shard counts and answers
(node, token, count) for each token of two sets or more, where a token is the leading bits of a shingle's hash; shingles
with one token only make candidates. Shingles in so many sets that they would weigh on a shard are found beforehand over
all documents, and their few counts are known to all tasks: they stand last in the order and are not dealt out.

Pairs within large groups are never all formed at once. In star rounds each token's nodes are compared with one
leader, a number of pairs linear in the prefixes; what is linked so is one component. In the last round all pairs
of nodes that share enough prefix tokens and lie in different components are compared,
so that no link is lost; it comes at once where tokens are shared by few. In it a
node is compared with its best partner first, and with others only if they are in
another component after that. There a pair forms only where its first shared token can
stand and if marks of the two prefixes leave room for enough shared tokens.

Defined results: null and empty texts and texts without words have no shingles and
link with nothing; with fewer words than n the whole sequence is one shingle; equal
rows are linked and keep one result each; a null doc_id links with nothing and has
a null component; an empty table gives an empty result. doc_id tells documents
apart (of rows that repeat one with another text, one text stands for it); columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import discard, lean, let_go, per_process, saved, shuffle_partitions, small
from tidegrid.llm.components import components

#: Bytes of a text worked on at once, texts and shingles held before they are sent on, and shingles of a shard.
PIECE, TEXTS, CHUNK, SHARD = 1 << 18, 500, 1 << 19, 1 << 21
#: Leading bits of a hash that tell the shard, at most.
MOST_BITS = 16
#: A shingle of so many sets, or of one set in HOT_SHARE, doesn't travel to a shard.
HOT_LEAST, HOT_SHARE = 4096, 256
#: Star rounds at most; and all remaining pairs are formed as soon as they are at most so many times the rows that form them.
STAR_ROUNDS, FEW_PAIRS = 2, 8
#: Sets up to this size have 16 bits of each hash compared first.
SHORT = 1024
#: Longs that mark the shingles of a node in the last round.
MARKS = 4


class Shingles:
    """Sorted 64-bit hashes of the distinct n-word shingles of texts, in whole-array steps.

    A word's hash is the sum of a random number for each byte times a power of an odd factor, taken as a
    difference of running sums over the text and divided by the power at its start.
    """

    def __init__(self, n: int):
        r = np.random.default_rng(n)
        odd = lambda k: r.integers(1, 1 << 62, k, np.uint64) * np.uint64(4) + np.uint64(3)
        self.n, self.factors, self.byte = n, odd(n), odd(256)
        self.byte[65:91] = self.byte[97:123]
        self.white = np.zeros(256, bool)
        self.white[[9, 10, 11, 12, 13, 32]] = True
        base = int(odd(1)[0])
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def powers(self, size: int) -> None:
        while len(self.up) < size:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))])

    def words(self, raw: bytes) -> np.ndarray:
        """A hash for each word of raw."""
        b = np.frombuffer(raw, np.uint8)
        self.powers(len(b) + 1)
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(self.byte[b] * self.up[: len(b)], out=sums[1:])
        edge = np.ones(len(b) + 2, bool)
        edge[1:-1] = self.white[b]
        at = np.flatnonzero(edge[1:] != edge[:-1])
        begin, end = at[::2], at[1::2]
        return (sums[end] - sums[begin]) * self.down[begin]

    def of(self, text: str) -> np.ndarray:
        raw, parts, lo = text.encode("utf-8", "surrogatepass"), [], 0
        while lo < len(raw):  # long texts go piece by piece, cut at white space
            hi = lo + PIECE
            while hi < len(raw) and not self.white[raw[hi]]:
                hi += 1
            parts.append(self.words(raw[lo:hi]))
            lo = hi
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        if not len(ids):
            return ids
        # A text of fewer words is one shingle, with a factor of its own number of words.
        n = min(self.n, len(ids))
        m = len(ids) - n + 1
        h = np.full(m, self.n - n, np.uint64)
        for k in range(n):
            h += ids[k : k + m] * self.factors[k]
            h ^= h >> np.uint64(29)
        h *= self.factors[0]
        h ^= h >> np.uint64(32)
        h.sort()
        return h[np.concatenate([[True], h[1:] != h[:-1]])]


def shingles(n: int) -> Shingles:
    kept = per_process()
    if ("shingles", n) not in kept:
        kept["shingles", n] = Shingles(n)
    return kept["shingles", n]


def prefix_length(size: int, percent: int) -> int:
    """Shingles of a set of size of which one must be shared with any set that reaches the threshold."""
    return size - -(-percent * size // 100) + 1


def least_overlap(a: int, b: int, percent: int) -> int:
    """Shared shingles at which sets of sizes a and b reach the threshold."""
    return -(-percent * (a + b) // (100 + percent))


def suffix_bound(x: np.ndarray, y: np.ndarray, depth: int = 2) -> int:
    """At most so many shared values of two sorted sets of distinct values, by halving them at a common value."""
    if not depth or len(x) < 8 or len(y) < 8:
        return min(len(x), len(y))
    pivot = y[len(y) // 2]
    i, j = int(np.searchsorted(x, pivot)), len(y) // 2
    return suffix_bound(x[:i], y[:j], depth - 1) + suffix_bound(x[i:], y[j:], depth - 1)


def found_in(x: np.ndarray, y: np.ndarray) -> int:
    """How many of the sorted values x are among the sorted values y."""
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    need = least_overlap(len(x), len(y), percent)
    if suffix_bound(x, y) < need:
        return False
    return found_in(x, y) >= need


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """doc_id and text of few rows at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, TEXTS):
            part = batch.slice(lo, TEXTS)
            yield part.column(0).to_pylist(), part.column(1).to_pylist()


def _measured(docs: DataFrame, n: int) -> DataFrame:
    """A row (doc_id, n_shingles, sig) for each document and rows (hash, n) of shingles that many documents of a task share."""
    names = ["doc_id", "n_shingles", "sig", "hash", "n"]

    def often(chunk: list[np.ndarray]) -> pa.RecordBatch:
        h, count = np.unique(np.concatenate(chunk), return_counts=True)
        found = count >= max(2, len(chunk) / HOT_SHARE)
        h, count = h[found].view(np.int64), count[found].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.nulls(len(h), pa.int64()), pa.nulls(len(h), pa.int64()), pa.nulls(len(h), pa.binary()), pa.array(h), pa.array(count)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, chunk, held = shingles(n), [], 0
        for ids, texts in _texts(batches):
            size, sig = [], []
            for text in texts:
                h = make.of(text or "")
                size.append(len(h))
                sig.append(hashlib.md5(h.tobytes()).digest() if len(h) else None)
                if len(h):
                    chunk.append(h)
                    held += len(h)
            rows = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(size, pa.int64()), pa.array(sig, pa.binary()), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64())], names)
            if held >= CHUNK:
                yield often(chunk)
                chunk, held = [], 0
        if chunk:
            yield often(chunk)

    return _read(docs).mapInArrow(lean(run), "doc_id long, n_shingles long, sig binary, hash long, n long")


def _hot(often: DataFrame, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the shingles of one document in HOT_SHARE or more.

    Their counts add up to the corpus's shingles at most, so there are HOT_SHARE times the mean set size at most.
    """
    rows = often.groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(HOT_LEAST, n_docs / HOT_SHARE)).toPandas()
    h, count = rows["hash"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64)
    order = np.argsort(h)
    return h[order], count[order]


def _packed(ids: np.ndarray) -> bytes:
    """Ascending numbers as the first and the steps from each to the next."""
    steps = np.diff(ids).astype(np.uint64)
    kind = next(k for k in (1, 2, 4, 8) if k == 8 or not len(steps) or int(steps.max()) < 1 << 8 * k)
    return bytes([kind]) + ids[:1].astype("<i8").tobytes() + steps.astype(f"<u{kind}").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.concatenate([np.frombuffer(raw, "<i8", 1, 1), np.frombuffer(raw, f"<u{raw[0]}", offset=9).astype(np.int64)]).cumsum()


#: What a packed row holds: tokens of a shard and their nodes; nodes, their sizes and how many hot shingles are left out
#: since they can't stand in the prefix; nodes, hot tokens and their counts.
TOKENS, NODES, HOT = 0, 1, 2


def _dealt(nodes: DataFrame, n: int, percent: int, bits: int, hot) -> DataFrame:
    """The shingles of nodes, packed by shard (the leading bits of their hashes, of which the next 32 are kept)."""

    def sent(ids: list[int], sets: list[np.ndarray]) -> Iterator[tuple]:
        order = sorted(range(len(ids)), key=ids.__getitem__)
        ids, sets = np.array([ids[i] for i in order], np.int64), [sets[i] for i in order]
        size = np.array([len(h) for h in sets], np.int64)
        h, at = np.concatenate(sets), np.repeat(np.arange(len(ids)), size)
        any_shard, left_out = int(ids[0]) % (1 << bits), np.zeros(len(ids), np.int64)
        hashes, counts = hot.value
        if len(hashes):
            place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            known = hashes[place] == h
            many = np.bincount(at[known], minlength=len(ids))
            reach = size - many < size - -(-percent * size // 100) + 1
            goes = known & reach[at]
            left_out = np.where(reach, 0, many)
            if goes.any():
                yield any_shard, HOT, ids[at[goes]].tobytes(), (h[goes] >> np.uint64(32 - bits)).tobytes(), counts[place[goes]].tobytes()
            h, at = h[~known], at[~known]
        yield any_shard, NODES, ids.tobytes(), size.tobytes(), left_out.tobytes()
        shard = (h >> np.uint64(64 - bits)).astype(np.uint16) if bits else np.zeros(len(h), np.uint16)
        order = np.argsort(shard, kind="stable")
        low, of, edge = (h[order] >> np.uint64(32 - bits)).astype("<u4"), ids[at[order]], np.searchsorted(shard[order], np.arange((1 << bits) + 1))
        for s in np.flatnonzero(np.diff(edge)):
            yield int(s), TOKENS, low[edge[s] : edge[s + 1]].tobytes(), _packed(of[edge[s] : edge[s + 1]]), None

    def batch(rows) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["shard", "kind", "a", "b", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, ids, sets, held = shingles(n), [], [], 0
        for docs, texts in _texts(batches):
            for doc, text in zip(docs, texts, strict=True):
                if len(h := make.of(text or "")):
                    ids.append(doc)
                    sets.append(h)
                    held += len(h)
            if held >= CHUNK:
                yield batch(sent(ids, sets))
                ids, sets, held = [], [], 0
        if ids:
            yield batch(sent(ids, sets))

    return nodes.mapInArrow(lean(run), "shard int, kind int, a binary, b binary, c binary")


def _answered(dealt: DataFrame) -> DataFrame:
    """node, token and n for the tokens of two shingles or more, from rows in the order of their shards.

    A row without a token has a node's size as n and in out the number of its hot shingles that are left out.
    """

    def table(node, token, n, out) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(node), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.nulls(len(node[lo : lo + (1 << 17)]), pa.int64()) if x is None else pa.array(x[lo : lo + (1 << 17)]) for x in (node, token, n, out)], ["node", "token", "n", "out"])

    def counted(shard: int, low: list[np.ndarray], of: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        low, of = np.concatenate(low), np.concatenate(of)
        order = np.argsort(low, kind="stable")
        low = low[order]
        edge = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1], [True]]))
        n = np.repeat(np.diff(edge), np.diff(edge))
        more = n > 1
        yield from table(of[order[more]], (shard << 32) + low[more].astype(np.int64), n[more], None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, low, of = None, [], []
        for batch in batches:
            for k in range(batch.num_rows):
                shard, kind, (a, b, c) = batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), (batch.column(i)[k].as_py() for i in (2, 3, 4))
                if kind == NODES:
                    yield from table(np.frombuffer(a, np.int64), None, np.frombuffer(b, np.int64), np.frombuffer(c, np.int64))
                elif kind == HOT:
                    yield from table(np.frombuffer(a, np.int64), np.frombuffer(b, np.int64), np.frombuffer(c, np.int64), None)
                else:
                    if shard != now and low:
                        yield from counted(now, low, of)
                        low, of = [], []
                    now = shard
                    low.append(np.frombuffer(a, "<u4"))
                    of.append(_unpacked(b))
        if low:
            yield from counted(now, low, of)

    return dealt.mapInArrow(lean(run), "node long, token long, n long, out long")


def _prefixes(nodes: DataFrame, n: int, percent: int, total: int, hot) -> DataFrame:
    """node, shingle (its token) and place (set size and position) of the shared shingles in the prefixes of nodes (doc_id, text)."""
    bits = min(MOST_BITS, max(0, total // SHARD).bit_length())
    dealt = _dealt(nodes, n, percent, bits, hot).repartition(max(shuffle_partitions(nodes.sparkSession), 1 << bits), "shard").sortWithinPartitions("shard")
    of_node, by_rarity = Window.partitionBy("node"), Window.partitionBy("node").orderBy(F.col("token").isNull(), "n", "token")
    ranked = _answered(dealt).select(
        "node", "token", F.row_number().over(by_rarity).alias("rank"),
        F.max(F.when(F.col("token").isNull(), F.col("n"))).over(of_node).alias("size"), (F.count("token").over(of_node) + F.max("out").over(of_node)).alias("known"),
    )
    # The shingles that no other set has come first, then the shared ones by their counts.
    ranked = ranked.withColumn("at", F.col("size") - F.col("known") + F.col("rank") - F.lit(1)).filter("token IS NOT NULL")
    within = F.col("at") < F.col("size") - F.floor((F.lit(percent) * F.col("size") + F.lit(99)) / F.lit(100)) + F.lit(1)
    return ranked.filter(within).select("node", F.col("token").alias("shingle"), (F.shiftleft("size", 32) + F.col("at")).alias("place"))


def _per_node(docs: DataFrame, nodes: DataFrame, make_of) -> DataFrame:
    """node and bytes made of its shingles for the documents whose doc_id is among nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([make_of(x or "") for x in batch.column(1).to_pylist()], pa.binary())], ["node", "items"])

    return _read(docs).join(small(nodes, 16), F.col("doc_id") == F.col("node"), "left_semi").mapInArrow(lean(run), "node long, items binary")


def _compared(docs: DataFrame, pairs: DataFrame, make_of, holds) -> DataFrame:
    """The pairs (u, v) for which holds is true of the bytes made of the shingles of both."""
    nodes = saved(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    items = saved(_per_node(docs, nodes, make_of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [holds(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(items.select(F.col("node").alias("u"), F.col("items").alias("x")), "u").join(items.select(F.col("node").alias("v"), F.col("items").alias("y")), "v")
    out = saved(both.select("u", "v", "x", "y").mapInArrow(lean(run), "u long, v long").distinct())
    discard(nodes, items)
    return out


def short_form(h: np.ndarray) -> bytes:
    """The leading bits of sorted hashes: 16 of each for small sets, else 32; the first byte tells."""
    return b"\2" + (h >> np.uint64(48)).astype("<u2").tobytes() if len(h) <= SHORT else b"\4" + (h >> np.uint64(32)).astype("<u4").tobytes()


def may_link(x: pa.Buffer, y: pa.Buffer, percent: int) -> bool:
    """False only if two sets can't reach the threshold, told from their short forms: what is equal stays equal in them.

    Values of short forms can repeat, so suffix_bound, which halves sets of distinct values, has no place here.
    """
    a, b = (np.frombuffer(z, "<u2" if z[0] == 2 else "<u4", offset=1) for z in (x, y))
    if a.dtype != b.dtype:
        a, b = ((z >> 16).astype("<u2") if z.dtype.itemsize == 4 else z for z in (a, b))
    need = least_overlap(len(a), len(b), percent)
    return found_in(a, b) >= need and found_in(b, a) >= need


def _verified(docs: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets reach the threshold: short forms first, whole sets for what these leave."""
    left = _compared(docs, pairs, lambda text: short_form(shingles(n).of(text)), lambda x, y: may_link(x, y, percent))
    if left.isEmpty():
        return left
    out = _compared(docs, left, lambda text: shingles(n).of(text).tobytes(), lambda x, y: linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent))
    discard(left)
    return out


def _linked_pairs(docs: DataFrame, pairs: DataFrame, links: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (u, v) of pairs (u, v, shared) that reach the threshold, enough of them to join what all of them would.

    Each v is first compared with the u it shares most with; then all pairs that lie in different components still.
    """
    whole = (lambda text: shingles(n).of(text).tobytes(), lambda x, y: linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent))
    best = saved(pairs.groupBy("v").agg(F.max_by("u", F.struct("shared", "u")).alias("u")).select("u", "v"))
    found = _compared(docs, best, *whole)
    comp = saved(components(links.unionByName(found)))
    end = lambda c: comp.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    apart = F.coalesce("cu", "u") != F.coalesce("cv", "v")
    rest = saved(pairs.select("u", "v").join(best, ["u", "v"], "left_anti").join(end("u"), "u", "left").join(end("v"), "v", "left").filter(apart).select("u", "v"))
    if not rest.isEmpty():
        found = found.unionByName(_verified(docs, rest, n, percent))
    discard(best, comp, rest)
    return found


def _size(place: str) -> Column:
    return F.shiftrightunsigned(place, 32)


def _near_size(a: str, b: str, percent: int) -> Column:
    """Length filter on the places of two nodes at a shared shingle."""
    return F.lit(100) * F.least(_size(a), _size(b)) >= F.lit(percent) * F.greatest(_size(a), _size(b))


def _in_reach(a: str, b: str, percent: int) -> Column:
    """Positional filter on the places of two nodes at the first shingle that both share."""
    rest = lambda c: _size(c) - F.col(c).bitwiseAND(F.lit((1 << 32) - 1))
    return F.lit(100 + percent) * F.least(rest(a), rest(b)) >= F.lit(percent) * (_size(a) + _size(b))


def _with_marks(open_: DataFrame) -> DataFrame:
    """open_ with, for each node, the count of its rows and their shingles as set bits of MARKS longs."""
    bits = [F.bit_or(F.expr(f"if(pmod(shingle, {MARKS}) = {i}, shiftleft(1L, int(shiftright(shingle, 8) & 63)), 0L)")).alias(f"m{i}") for i in range(MARKS)]
    return open_.join(open_.groupBy("node").agg(F.count(F.lit(1)).alias("held"), *bits), "node")


def _may_share(percent: int) -> tuple[Column, Column]:
    """An upper bound of the prefix shingles that two marked nodes (columns of a and b) share, and whether it is enough.

    A bit that one has and the other has not stands for a shingle that is not shared. Of the two prefixes, one ends no later
    than the other in the common order, so what it shares with the whole other set is shared by both prefixes; only its
    set's suffix can add to that.
    """
    lacks = lambda a, b: F.col(f"{a}.held") - sum(F.bit_count(F.col(f"{a}.m{i}").bitwiseAND(F.bitwise_not(F.col(f"{b}.m{i}")))) for i in range(MARKS))
    shared, sizes = F.least(lacks("a", "b"), lacks("b", "a")), (_size("a.place"), _size("b.place"))
    suffix = F.floor((F.lit(percent) * F.greatest(*sizes) + F.lit(99)) / F.lit(100)) - F.lit(1)
    return shared, F.lit(100 + percent) * (shared + suffix) >= F.lit(percent) * (sizes[0] + sizes[1])


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row of docs."""
    spark = docs.sparkSession
    both = saved(_measured(docs, n))
    measured = both.filter("hash IS NULL").select("doc_id", "n_shingles", "sig")

    # Equal sets are one node, named by their smallest doc_id.
    named = measured.filter("doc_id IS NOT NULL AND sig IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("size"))
    members = saved(measured.join(named.select("sig", "rep"), "sig", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep")))
    nodes = saved(named.select(F.col("rep").alias("node"), "size"))
    n_docs, total = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    hot = spark.sparkContext.broadcast(_hot(both.filter("hash IS NOT NULL").select("hash", "n"), n_docs))
    texts = _read(docs).join(small(nodes.select("node"), 16), F.col("doc_id") == F.col("node"), "left_semi")
    if not members.filter("doc_id = rep AND n_shingles > 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        texts = texts.dropDuplicates(["doc_id"])

    prefixes = saved(_prefixes(texts, n, percent, total, hot))
    shared = prefixes.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("shingle")
    open_ = saved(prefixes.join(shared, "shingle", "left_semi").withColumn("component", F.col("node")))
    discard(prefixes, nodes)
    del shared, texts
    let_go(spark)
    links = spark.range(0).select(F.col("id").alias("u"), F.col("id").alias("v"))  # none; made from a list it would start Python workers of its own
    for k in range(STAR_ROUNDS + 1):
        sizes = open_.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
        rows, all_pairs = sizes.agg(F.sum("n"), F.sum(F.expr("n * (n - 1) / 2"))).first()
        if not rows:
            break
        last = k == STAR_ROUNDS or all_pairs <= FEW_PAIRS * rows
        if last:
            marked = saved(_with_marks(open_))
            shared, enough = _may_share(percent)
            apart = (F.col("a.shingle") == F.col("b.shingle")) & F.expr("a.node < b.node AND a.component <> b.component")
            fits = _near_size("a.place", "b.place", percent) & _in_reach("a.place", "b.place", percent) & enough
            pairs = marked.alias("a").join(marked.alias("b"), apart & fits).select(F.col("a.node").alias("u"), F.col("b.node").alias("v"), shared.alias("shared")).distinct()
        else:
            # First the node with the fewest rarer shingles of its own, as a text has that others were made from; then any.
            first = [F.col("place").bitwiseAND(F.lit((1 << 32) - 1))] if not k else []
            leader = F.min_by(F.struct("node", "place", "component"), F.struct(*first, F.xxhash64(F.col("node") + F.lit(k)), "node"))
            led = open_.groupBy("shingle").agg(leader.alias("l")).select("shingle", F.col("l.node").alias("u"), F.col("l.place").alias("p"), F.col("l.component").alias("c"))
            pairs = open_.join(led, "shingle").filter("component <> c").filter(_near_size("p", "place", percent) & _in_reach("p", "place", percent))
            pairs = pairs.select(F.least("u", "node").alias("u"), F.greatest("u", "node").alias("v")).distinct()
        pairs = saved(pairs)
        found = None if pairs.isEmpty() else _linked_pairs(docs, pairs, links, n, percent) if last else _verified(docs, pairs, n, percent)
        if found is not None:
            links = links.unionByName(found)
        discard(pairs)
        if last:
            break
        # Shingles whose nodes are not yet one component, by their nodes' components.
        done, open_ = open_, open_.drop("component")
        if not links.isEmpty():
            open_ = open_.join(saved(components(links)), "node", "left").withColumn("component", F.coalesce("component", "node"))
        else:
            open_ = open_.withColumn("component", F.col("node"))
        mixed = open_.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("shingle")
        open_ = saved(open_.join(mixed, "shingle", "left_semi"))
        discard(done)
    discard(open_, both)
    comp = components(links)
    return (
        members.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    )


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of its component, once each; rows without a doc_id all stay."""
    found = saved(near_duplicates(docs, n, percent).filter("doc_id = component_id").select("doc_id"))
    name = "_first"
    while name in docs.columns:
        name += "_"
    first = found.distinct().withColumnRenamed("doc_id", name)
    kept = docs.join(small(first, 16), F.col("doc_id").cast("long") == F.col(name), "left_semi")
    if not found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id"])
    return kept.unionByName(docs.filter("doc_id IS NULL"))
