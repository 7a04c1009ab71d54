"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Counts over a text feed rules; a document is kept if none rejects it. Rules run
in order of rejections per cost, both estimated on a bounded sample of rows, as
branches of one CASE, so that a rule's own expressions, counts included, are only evaluated where
no rule before it has rejected. The two base rules stand in that order like all others. The order never changes the verdict.

Defined results: a null or empty text has no words, fails the base rule and is
dropped; repeated rows get equal results; an empty table gives an empty result;
rules that the sample can't tell apart keep their written order; other columns are
not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import discard, saved

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
#: Expected rows of the sample that costs and selectivities are estimated on; each cost is the least of so many timings, less that of no rule.
SAMPLE_ROWS, TIMINGS = 2000, 3
#: Seconds that a rule costs at least, so that noise doesn't tell cheap rules apart.
LEAST_COST = 0.02


def let(value: Column, use) -> Column:
    """use(value) with value evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def matches(text: Column, pattern: str) -> Column:
    """Characters of text that a pattern of single characters matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, the first included: windows are sorted by
    their hash, and those with an equal neighbour mark their three positions."""

    def covered(s: Column) -> Column:
        hit = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        at = lambda p, k: F.transform(p, lambda x: x["i"] + F.lit(k))
        return let(hit, lambda p: F.size(F.array_union(F.array_union(at(p, 0), at(p, 1)), at(p, 2))))

    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.greatest(F.lit(0), F.size(h) - 2)), lambda x, i: F.struct(F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)).alias("h"), i.alias("i")))

    ids = F.transform(words, lambda w: F.xxhash64(w))
    some = let(let(ids, windows), lambda s: let(F.sort_array(s), covered))
    return F.when(F.size(words) >= 3, some).otherwise(F.lit(0)).cast("long")


def split_texts(docs: DataFrame) -> DataFrame:
    """_text, _words and _lines of every row, made once however many expressions use them; _row is the row itself."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"), row.alias("_row"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    # What explode makes is computed once: the optimiser can't copy it into each use, as it would a projection.
    return text.select("_text", "_row", F.explode(F.array(F.struct(words_of(F.col("_text")).alias("_words"), lines.alias("_lines")))).alias("_s")).select("_text", "_row", "_s._words", "_s._lines")


def counts() -> dict[str, Column]:
    """The counts of a split text by name."""
    return {
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": matches(F.col("_text"), SYMBOLS).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("_words")),
    }


@dataclass(frozen=True)
class Rule:
    """rejects makes a rule's column from the counts, by name, of a split text; _text, _words and _lines are at hand too."""

    name: str
    rejects: Callable[[dict[str, Column]], Column]


def base_rules(min_words: int = 50) -> list[Rule]:
    return [Rule("few_words", lambda c: c["n_words"] < min_words), Rule("repeats", lambda c: F.lit(100) * c["n_repeat_words"] > F.lit(50) * c["n_words"])]


def default_rules() -> list[Rule]:
    """Lenient rules: each rejects what prose of no language looks like."""
    text = F.col("_text")
    upper, letters, marks = matches(text, r"\p{Lu}"), F.length(F.regexp_replace(text, r"[^\p{L}]+", "")), matches(text, "[!?]")
    return [
        Rule("symbols", lambda c: F.lit(10) * c["n_symbols"] > F.lit(3) * c["n_words"]),
        Rule("duplicate_lines", lambda c: F.lit(10) * c["n_dup_lines"] > F.lit(6) * F.size("_lines")),
        Rule("word_length", lambda c: (c["word_chars"] > F.lit(20) * c["n_words"]) | (F.lit(2) * c["word_chars"] < F.lit(3) * c["n_words"])),
        Rule("marks", lambda c: F.lit(2) * marks > c["n_words"]),
        Rule("letters", lambda c: F.lit(2) * letters < c["word_chars"]),
        Rule("upper_case", lambda c: F.lit(2) * upper > c["word_chars"]),
    ]


def ordered(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """rules by rejections per second on a sample of docs drawn by a hash of doc_id."""
    total = docs.select("doc_id").count()
    share = int(min(1.0, sample_rows / max(1, total)) * (1 << 30))
    drawn = docs.select("doc_id", "text").filter(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << 30)) < share)
    sample = saved(split_texts(drawn).drop("_row").coalesce(4))
    if sample.isEmpty():
        return rules

    def timed(rejects: Column) -> tuple[float, int]:
        best, found = float("inf"), 0
        for _ in range(TIMINGS):
            began = time.perf_counter()
            # Every column is read, whatever the rule needs, so that reading costs the same for all.
            found = sample.agg(F.count_if(rejects), F.max(F.size("_words") + F.size("_lines") + F.length("_text"))).first()[0]
            best = min(best, time.perf_counter() - began)
        return best, found

    idle, _ = timed(F.lit(False))
    rated = []
    for k, rule in enumerate(rules):
        cost, rejected = timed(rule.rejects(counts()))
        rated.append((-rejected / max(LEAST_COST, cost - idle), k, rule))
    discard(sample)
    return [rule for *_, rule in sorted(rated, key=lambda x: x[:2])]


def cascade(rules: list[Rule], known: dict[str, Column]) -> Column:
    """The first of rules that rejects a row; null if none does."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in rules:
        out = out.when(rule.rejects(known), rule.name)
    return out


def kept_rows(docs: DataFrame, rules: list[Rule] | None = None, min_words: int = 50) -> DataFrame:
    """The rows of docs, with all their columns, that no rule rejects."""
    every = ordered(docs, base_rules(min_words) + (default_rules() if rules is None else rules))
    return split_texts(docs).filter(cascade(every, counts()).isNull()).select("_row.*")


def judged(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The base counts, base_failed, kept and the name of the rule that rejected (null if kept) of every row of docs."""
    every = ordered(docs, base_rules() + (default_rules() if rules is None else rules))
    made = split_texts(docs).select(F.col("_row.doc_id").cast("long").alias("doc_id"), *[c.alias(name) for name, c in counts().items()], "_text", "_words", "_lines")
    base_failed = (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))
    out = made.withColumns({"base_failed": base_failed, "rejected_by": cascade(every, {name: F.col(name) for name in counts()})})
    return out.select("doc_id", *counts(), "base_failed", F.col("rejected_by").isNull().alias("kept"), "rejected_by")
