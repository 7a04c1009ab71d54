"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for each operator and stage."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidegrid.llm import audio, bpe_automaton, html_extract, kneser_ney, langid, ngram_join, packing, quality_rules, sharding, token_counts
from tidegrid.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, sig string, part int, node long, _row string, size long, lang_pred string, score double, ambiguous boolean, _text string, _first long, _s string, _words int, c0 string, seen int, token long"
LONG = "the quick brown fox jumps over the lazy dog " * 3000


def docs(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 7, "x", 3, 9, "r", 5, "l", 0.5, True, "t", 6, "s", 2, "c", 8, 4) for r in rows], SCHEMA)


ROWS = [(1, "hello world", "en"), (1, "hello world", "en"), (2, None, "en"), (3, "", None), (None, "bonjour le monde", "fr"), (4, LONG, "en"), (5, LONG, "en"), (6, " \n\t ", "fr"), (7, "123 456 !!!", None), (8, "é" * 50_000, "fr")]
LABELS = [(1, 1, 0), (4, 1, 0), (8, 1, None), (None, 1, 0)]


def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


OPERATORS = {
    "token_counts": lambda s, d: token_counts.token_counts(d, vocabulary("word_bpe_49k.json")),
    "packing": lambda s, d: packing.packed(d, vocabulary("byte_bpe_50k.json")),
    "langid": lambda s, d: langid.predicted(d, langid.fit(d)),
    "quality": lambda s, d: quality_rules.judged(d),
    "audio": lambda s, d: audio.audio_media(d),
    "kneser_ney": lambda s, d: kneser_ney.classified(d, labels(s)),
    "ngram_join": lambda s, d: ngram_join.near_duplicates(d, 4, 85),
    "sharding": lambda s, d: sharding.balanced_shards(d),
    "bpe": lambda s, d: bpe_automaton.encoded(d, vocabulary("word_bpe_49k.json")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(spark, name):
    got = OPERATORS[name](spark, docs(spark, ROWS)).collect()
    if name == "packing":
        got = [x for x in got if x.piece == 0]
    assert sorted(str(x.doc_id) for x in got) == sorted(str(r[0]) for r in ROWS)
    both = [x for x in got if x.doc_id == 1]
    same = [{k: v for k, v in x.asDict().items() if k not in ("offset", "sequence_id", "slot", "shard")} for x in both]
    assert same[0] == same[1]


@pytest.mark.parametrize("name", OPERATORS)
def test_an_empty_table_gives_an_empty_result(spark, name):
    assert OPERATORS[name](spark, docs(spark, [])).collect() == []


def test_defined_values(spark):
    d = docs(spark, ROWS)
    lang = {x.doc_id: x for x in OPERATORS["langid"](spark, d).collect()}
    assert [(lang[k].lang_pred, lang[k].score) for k in (2, 3, 6, 7)] == [("und", 0.0)] * 4 and lang[4].lang_pred == "en"
    comp = {x.doc_id: (x.n_shingles, x.component_id) for x in OPERATORS["ngram_join"](spark, d).collect()}
    assert comp[1] == (1, 1) and comp[2] == (0, 2) and comp[3] == (0, 3) and comp[5] == (9, 4) and comp[6] == (0, 6) and comp[None][1] is None
    kept = {x.doc_id: x.kept for x in OPERATORS["quality"](spark, d).collect()}
    assert not any(kept.values())
    ppl = {x.doc_id: x for x in OPERATORS["kneser_ney"](spark, d).collect()}
    assert ppl[2].perplexity is None and not ppl[2].kept and not ppl[3].kept and ppl[4].kept
    n = {x.doc_id: x.n_tokens for x in OPERATORS["bpe"](spark, d).collect()}
    assert n[2] == n[3] == n[6] == 0


@pytest.mark.parametrize("rows", [ROWS, []])
def test_stages(spark, tmp_path, rows):
    d, ids = docs(spark, rows), {r[0] for r in rows}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, d, "")
        if k < 3:
            assert out.columns == d.columns
        out.write.parquet(f"{tmp_path}/{k}")
        d = spark.read.parquet(f"{tmp_path}/{k}")
        assert {x.doc_id for x in d.select("doc_id").collect()} <= ids


def test_stages_send_small_lots(spark, tmp_path, monkeypatch):
    before = spark.conf.get(corpus_pipeline.LOTS)
    docs(spark, ROWS).repartition(1).write.parquet(f"{tmp_path}/documents.parquet")
    read, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), "n long"

    def lots():  # rows of each batch that Python gets
        return max(r.n for r in read.select("doc_id").mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in batches), seen).collect())

    try:
        assert lots() == len(ROWS)
        monkeypatch.setattr(corpus_pipeline, "LOT", 4)
        for stage in (corpus_pipeline.language_id, corpus_pipeline.jaccard_join, corpus_pipeline.packing):
            spark.conf.set(corpus_pipeline.LOTS, before)
            stage(spark, read, "")
            assert lots() == 4
        spark.conf.set(corpus_pipeline.LOTS, "3")
        stage(spark, read, "")
        assert lots() == 3
        spark.conf.set(corpus_pipeline.LOTS, "9")
        few = corpus_pipeline.run(spark, str(tmp_path)).drop("sequence_id", "offset").collect()
        assert spark.conf.get(corpus_pipeline.LOTS) == "9"
        monkeypatch.setattr(corpus_pipeline, "LOT", 1000)
        assert few and sorted(map(str, few)) == sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).drop("sequence_id", "offset").collect()))
    finally:
        spark.conf.set(corpus_pipeline.LOTS, before)


def test_one_of_each_component_stays(spark):
    d = docs(spark, [(9, LONG, "en"), (4, LONG, "en"), (4, LONG, "en"), (5, "a b c d e f", "en"), (None, LONG, "en")])
    assert sorted(str(x.doc_id) for x in ngram_join.one_of_each(d).collect()) == ["4", "5", "None"]


def test_pages(spark):
    schema = "page_id long, url string, html string, host string, part int"
    menu = "<div>Home</div><div>Contact us</div>"
    rows = [(k, f"http://h/a/{k}", f"{menu}<p>Own text {k}</p><p>More of it, {k * 7}</p>", "x", 1) for k in range(5)]
    rows += [(10, None, None, "x", 1), (11, None, "", "x", 1), (12, "http://one/x", "<p>A &lt; B &amp C", "x", 1), (12, "http://one/x", "<p>A &lt; B &amp C", "x", 1), (None, "nonsense", "<p>t", "x", 1), (13, "http://l/1", "<p>" + "x " * 100_000, "x", 1)]
    got = html_extract.main_text(spark.createDataFrame(rows, schema)).collect()
    text = {x.page_id: x.text for x in got}
    assert len(got) == len(rows) and [text[k] for k in range(5)] == [f"Own text {k}\nMore of it, {k * 7}" for k in range(5)]
    assert text[10] == text[11] == "" and text[12] == "A < B & C" and text[None] == "t" and len(text[13]) == 199_999
    assert html_extract.main_text(spark.createDataFrame([], schema)).collect() == []
