"""Main text of web pages, by the page's own structure and by differencing with the page of the nearest URL.

Pages of a host stand in the order of their paths; each is paired with the
neighbour whose path has the longer common start. The text lines of the two are
aligned by a longest common subsequence, and lines that both have (menus, notices,
footers of the site) are deleted. Two things differencing cannot know are left to
the page's markup: what scripts, forms, menus, adverts or comments are even where
no other page repeats them, and that lines of a declared article are its own even
where another page carries them too. A neighbour that shares most of a page's text
is a copy of it and tells nothing about the site.

Pages are dealt to tasks by cut points in the order of (host, path, page_id), taken
from a bounded hash-drawn sample of keys, so a host with a third of all pages is
split; a task streams its pages with one neighbour on each side. The pages at a cut
go to the tasks on both sides of it, as guests where they are not judged, so the
result does not depend on the cuts.

Defined results: null or empty html gives an empty text; a null url is a host of its
own; repeated rows are copies of each other and stay; a page without a neighbour on
its host is judged by its markup; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import bisect
import html as entities
import re
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import lean

#: Keys that the cut points between tasks are taken from.
SAMPLE_KEYS = 4096
#: Characters of html that a task compares, about; keys are sampled so many times as often as there are tasks at least.
TASK_CHARS, KEYS_PER_TASK = 24 << 20, 32
#: A neighbour that shares more than this part of a page's characters is a copy.
COPY = 0.8

RAW = frozenset("script style textarea title xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img td th".split())
DROPPED = frozenset("head nav aside footer form button select option datalist iframe object svg canvas audio video noscript template dialog menu map applet".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul tr td th dd dt".split())
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar side aside footer foot masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login search searchbox pagination pager related recommended recommendations share sharing social comment comments commentlist "
    "disqus reply replies respond discussion widget skip legal copyright hidden".split()
)
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
MAIN_WORDS = re.compile(r"(?:^|\s)(?:article|articlebody|article-body|article-content|post-content|entry-content|post-body|main-content|story-body)(?:\s|$)")

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|([^<]+|<)", re.S)
ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(next((x for x in m.groups()[1:] if x is not None), "")) for m in ATTR.finditer(text)} if text.strip(" /") else {}


def is_side(name: str, attrs: dict[str, str], in_main: bool) -> bool:
    """Whether an element is beside the main text."""
    if name in DROPPED or name == "header" and not in_main:
        return True
    if not attrs or name in ("html", "body", "main"):
        return False
    words = set(re.split(r"[^a-z0-9]+", f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()))
    if name == "article":
        return bool(words & {"comment", "comments", "reply", "ad", "advert", "sponsored"})
    hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", "").lower())
    return bool(words & SIDE_WORDS or hidden or attrs.get("role", "").lower() in SIDE_ROLES or not in_main and "header" in words)


def is_main(name: str, attrs: dict[str, str]) -> bool:
    named = f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('itemprop', '')}".lower()
    return name in ("article", "main") or attrs.get("role", "").lower() in ("main", "article") or bool(attrs and MAIN_WORDS.search(named))


def lines_of(page: str) -> list[tuple[str, bool, bool]]:
    """The text lines (blocks) of a page in order: text, whether in a main element, whether beside the main text."""
    out: list[tuple[str, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # element, in main, beside
    text: list[str] = []
    state = (False, False)

    def flush() -> None:
        if text:
            if line := " ".join("".join(text).split()):
                out.append((line, *state))
            text.clear()

    def pop(to: int) -> None:
        nonlocal state
        del stack[to:]
        now = stack[-1][1:] if stack else (False, False)
        if now != state:
            flush()
            state = now

    at = 0
    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        if m[4] is not None:
            text.append(entities.unescape(m[4]))
            continue
        if m[2] is None:
            continue
        name, closing = m[2].lower(), m[1] == "/"
        if name == "br":
            text.append(" ")
            continue
        if name not in INLINE:
            flush()
        elif name in ("td", "th"):
            text.append(" ")
        if closing:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if k is not None:
                pop(k)
            continue
        if name in RAW:
            end = re.compile(f"</{name}[\\s/>]", re.I).search(page, at)
            at = page.find(">", end.start()) + 1 or len(page) if end else len(page)
            continue
        if name in CLOSES_P and stack:
            # An open p ends here, and with it what was left open inside it; so does an item before the next one.
            ends = {"p"} | ({name} if name in ("li", "tr", "td", "th", "dd", "dt", "option") else set())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    pop(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        if name in VOID or m[3].endswith("/") and name in ("svg", "path"):
            continue
        attrs = attributes(m[3])
        beside = state[1] or is_side(name, attrs, state[0])
        main = state[0] or is_main(name, attrs)
        if (main, beside) != state:
            flush()
            state = (main, beside)
        stack.append((name, main, beside))
    flush()
    return out


def common_lines(a: list, b: list) -> set[int]:
    """Places in a of a longest common subsequence with b, by bit-parallel rows (one bit for each line of a)."""
    lo, hi = 0, 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    out = {*range(lo), *range(len(a) - hi, len(a))}
    both = set(a[lo : len(a) - hi]) & set(b[lo : len(b) - hi])
    x = [k for k in range(lo, len(a) - hi) if a[k] in both]
    y = [v for v in b[lo : len(b) - hi] if v in both]
    where: dict = {}
    for bit, k in enumerate(x):
        where[a[k]] = where.get(a[k], 0) | 1 << bit
    full = (1 << len(x)) - 1
    rows, v = [], full
    for item in y:
        u = v & where[item]
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    i, j = len(rows), len(x)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                out.add(x[j])
    return out


def shared_lines(page: dict, around: list[dict]) -> set[int]:
    """Lines that page shares with its nearest neighbour that is no copy of it."""
    near = sorted((n for n in around if n["host"] == page["host"]), key=lambda n: -len(commonprefix([n["path"], page["path"]])))
    whole = sum(page["sizes"])
    for n in near:
        both = common_lines(page["keys"], n["keys"])
        if sum(page["sizes"][k] for k in both) <= COPY * whole:
            return both
    return set()


def keyed(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_replace(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1), r"(?:/|\.html?)$", "").alias("path"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )


def cut_points(keys: DataFrame, tasks: int) -> list[tuple]:
    """At most tasks - 1 keys at equal distances in a sample of about SAMPLE_KEYS (or KEYS_PER_TASK a task, if more), drawn by hash."""
    share = int(min(1.0, max(SAMPLE_KEYS, KEYS_PER_TASK * tasks) / max(1, keys.select("page_id").count())) * (1 << 30))
    rows = keys.select("host", "path", F.coalesce("page_id", F.lit(-1)).alias("page_id")).filter(F.pmod(F.xxhash64("host", "path", "page_id"), F.lit(1 << 30)) < share)
    found = sorted(tuple(r) for r in rows.collect())
    return sorted({found[len(found) * k // tasks] for k in range(1, tasks)}) if found else []


def part_of(cuts: list[tuple], key: tuple) -> int:
    return bisect.bisect_right(cuts, key)


def borders(keys: DataFrame, cuts: list[tuple]) -> dict[tuple, list[int]]:
    """The first and last key of each task, with the tasks beside it that have pages too."""
    if not cuts:
        return {}

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple]] = {}
        for batch in batches:
            for key in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                own = found.setdefault(part_of(cuts, key), [key, key])
                own[:] = min(own[0], key), max(own[1], key)
        rows = [(p, *key) for p, own in found.items() for key in own]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 4, (pa.int32(), pa.string(), pa.string(), pa.int64()), strict=True)], ["part", "host", "path", "page_id"])

    rows = keys.select("host", "path", F.coalesce("page_id", F.lit(-1)).alias("page_id")).mapInArrow(ends, "part int, host string, path string, page_id long")
    key = F.struct("host", "path", "page_id")
    parts = sorted((r[0], tuple(r[1]), tuple(r[2])) for r in rows.groupBy("part").agg(F.min(key), F.max(key)).collect())  # a row a task
    out: dict[tuple, list[int]] = {}
    for (p, _, last), (q, first, _) in zip(parts, parts[1:]):
        out.setdefault(last, []).append(q)
        out.setdefault(first, []).append(p)
    return out


LINES = "page_id long, url string, host string, path string, part int, keys array<long>, sizes array<int>, texts array<string>, places array<int>, declared boolean, guest boolean"


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_lines_shared (lines that the nearest page shares) of every row of pages."""
    source = keyed(pages)
    tasks = max(1, -(-(source.agg(F.sum(F.length("html"))).first()[0] or 0) // TASK_CHARS))
    cuts = cut_points(source, tasks)
    beside_cuts = borders(source, cuts)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                rows = []
                for r in batch.slice(lo, 500).to_pylist():
                    lines = lines_of(r["html"])
                    declared = any(main and not beside for _, main, beside in lines)
                    kept = [k for k, (_, main, beside) in enumerate(lines) if not beside and (main or not declared)]
                    key = (r["host"], r["path"], -1 if r["page_id"] is None else r["page_id"])
                    row = (
                        {x: r[x] for x in ("page_id", "url", "host", "path")}
                        | {"part": part_of(cuts, key), "guest": False}
                        | {"keys": [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t, *_ in lines], "sizes": [len(t) for t, *_ in lines]}
                        | {"texts": [lines[k][0] for k in kept], "places": kept, "declared": declared}
                    )
                    rows += [row, *[row | {"part": p, "guest": True} for p in beside_cuts.get(key, ())]]
                yield pa.RecordBatch.from_pylist(rows, schema=LINE_SCHEMA)

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, page, out = None, None, []

        def made(around: list) -> dict:
            shared = shared_lines(page, [n for n in around if n])
            texts = page["texts"] if page["declared"] else [t for k, t in zip(page["places"], page["texts"], strict=True) if k not in shared]
            return {"page_id": page["page_id"], "url": page["url"], "text": "\n".join(texts), "n_lines_shared": len(shared)}

        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                for after in batch.slice(lo, 500).to_pylist():
                    if page and not page["guest"]:
                        out.append(made([before, after]))
                    before, page = page, after
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=OUT_SCHEMA)
                out = []
        if page and not page["guest"]:
            yield pa.RecordBatch.from_pylist([made([before])], schema=OUT_SCHEMA)

    dealt = source.mapInArrow(lean(split), LINES).repartition(tasks, "part").sortWithinPartitions("part", "host", "path", F.coalesce("page_id", F.lit(-1)))
    return dealt.mapInArrow(lean(differ), "page_id long, url string, text string, n_lines_shared int")


LINE_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("path", pa.string()), ("part", pa.int32()), ("keys", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("texts", pa.list_(pa.string())), ("places", pa.list_(pa.int32())), ("declared", pa.bool_()), ("guest", pa.bool_())]
)
OUT_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_lines_shared", pa.int32())])
