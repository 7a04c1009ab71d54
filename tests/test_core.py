import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegrid.functions import timeutil
from tidegrid.operators import decisions, dedup, erasure, evaluation, features, normalise, policies, settlement, timeline, windows
from tidegrid.plans.queries import ORACLE_SQL, QUERIES
from tidegrid.sources import files, tables

SF = "/root/testdata/sf0.001"
T0 = 1_700_000_100_000  # 2023-11-14T22:15:00Z, a quarter hour's start
MIN = 60_000
HASH = "substr(sha2(concat(meter_id, energy_wh), 256), 1, 32)"


def rows(df):
    k = sorted(df.columns)
    return sorted(tuple("" if pd.isna(v) else str(int(v)) if isinstance(v, float) and v == int(v) else str(v) for v in r) for r in df[k].itertuples(index=False))


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    c = duckdb.connect()
    for t in ("events", "orders", "lineitem", "documents", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(c.sql(ORACLE_SQL[name]).df())


def arrive(spark, *raws, ingest=T0 + 21 * MIN, source="stream"):
    return spark.createDataFrame([(r, ingest, source, "north") for r in raws], "raw string, ingest_ms long, source string, partition string")


def one(**more):
    """A payload of the first generation, another value or none for some fields."""
    import json

    return json.dumps({k: v for k, v in ({"v": 3, "mid": "Z-77", "ts": T0 // 1000 + 60, "wh": 5150} | more).items() if v != "gone"})


def two(value="5.15", unit='"kWh"', at="2023-11-14T22:16:00Z", mid='"Z-77"', tag="schema", more=""):
    return f'{{"{tag}":"2","meter_id":{mid},"timestamp":"{at}","energy":{{"value":{value},"unit":{unit}}}{more}}}'


THREE = '{"schemaVersion":"3.1","meter":{"id":"Z-77"},"interval":{"start":"2023-11-15T03:45:00.000+05:30"},"energy":{"value":0.00515,"unit":"MWh"}}'


def test_generations_agree_on_a_reading(spark):
    r = normalise.readings(arrive(spark, one(), two(), THREE, "  " + two() + "\n")).collect()
    assert len(r) == 4 and {(x.meter_id, x.interval_start_ms, x.energy_wh) for x in r} == {("Z-77", T0, 5150)} and len({x.payload_hash for x in r}) == 1


REFUSED = [
    ("nothing of the kind", "unknown_payload_shape"), ('["v"]', "unknown_payload_shape"), ("17", "unknown_payload_shape"), (None, "unknown_payload_shape"), ("{}", "unknown_payload_shape"),
    (one() + " tail}", "unknown_payload_shape"), (one() + "," + one(), "unknown_payload_shape"), (one() + one(), "unknown_payload_shape"), ("{'v':1}", "unknown_payload_shape"), (one()[:-1], "unknown_payload_shape"),
    (one(mid="gone"), "malformed_field"), (one(mid=""), "malformed_field"), (one(mid=77), "malformed_field"), (one(ts=1.5), "malformed_field"), (one(ts="1700000160"), "malformed_field"), (one(ts=10**17), "malformed_field"), (one(wh="5150"), "malformed_field"),
    (one(wh=True), "malformed_field"), (one(wh="gone"), "malformed_field"), (two(at="2023-11-14T22:16:00"), "malformed_field"), (two(at="2023-11-14T22:16:00z"), "malformed_field"), (two(at="T22:16:00Z"), "malformed_field"), (two(mid='""'), "malformed_field"),
    (two(unit='"J"'), "unknown_unit"), (two(unit="7"), "unknown_unit"), (two(value='"1"', unit='"J"'), "unknown_unit"), (two(value='"1"'), "malformed_field"),
    (two(value="5.1505"), "precision_beyond_canonical_unit"), (two(value="5.1500000000001"), "precision_beyond_canonical_unit"), (two(value="5.15" + "0" * 40 + "1"), "precision_beyond_canonical_unit"), (two(value="2e-30"), "precision_beyond_canonical_unit"),
    (one(wh=-2), "implausible_value"), (two(value="1E400"), "implausible_value"), (two(value="9" * 45), "implausible_value"), (one(wh=10_000_001), "implausible_value"), (one(ts=T0 // 1000 + 27 * 60), "clock_skew_future"),
]


def test_refusals(spark):
    got = normalise.normalised(spark.createDataFrame([(k, raw, T0 + 21 * MIN, "stream", "north") for k, (raw, _) in enumerate(REFUSED)], "k int, raw string, ingest_ms long, source string, partition string"))
    found = {x.k: (x.reason, x.detail) for x in got.collect()}
    assert {REFUSED[k][0]: r for k, (r, _) in found.items()} == dict(REFUSED) and all(d for _, d in found.values())
    assert [x.reason for x in normalise.quarantine(arrive(spark, one(), source="radio")).collect()] == ["unknown_payload_shape"]


def test_accepted_at_the_edges(spark):
    texts = {two(value="5.150000000000000"): 5150, two(value="515e-2"): 5150, one(mid="} {"): 5150, one(ts=T0 // 1000 + 26 * 60): 5150, one(wh=0): 0, one()[:-1] + ',"wh":8}': 8, one(v=None): 5150, one(wh=10_000_000): 10_000_000}
    got = {x.raw: x.energy_wh for x in normalise.normalised(arrive(spark, *texts)).filter("reason IS NULL").collect()}
    assert got == texts


def test_transport(spark):
    import base64

    enc = lambda b: base64.b64encode(b).decode()
    r = spark.createDataFrame([(enc(one().encode()), "grid/x/north", 5), (enc(b"\xff\xfe"), "grid/x/south/backfill", 6), ("%%", "grid/x/north", 7), (None, None, 8)], "raw string, topic string, at_ms long")
    good, bad = normalise.transported(r)
    assert [(x.raw, x.ingest_ms, x.source, x.partition) for x in good.collect()] == [(one(), 5, "stream", "north")]
    assert sorted((x.reason, str(x.partition), x.source) for x in bad.collect()) == [("undecodable_transport", "None", "stream"), ("undecodable_transport", "north", "stream"), ("undecodable_transport", "south", "batch")]


def test_time(spark):
    t = spark.createDataFrame([("2023-11-14T22:16:00.123999+0200", 93_784_005), ("14.11.2023 22:16Z", 0), (" 2023-11-14T22:16:00-00:30 ", -7_200_000)], "s string, d long")
    got = t.select(timeutil.to_iso(timeutil.from_iso(F.col("s"))).alias("s"), timeutil.duration_text(F.col("d")).alias("d")).collect()
    assert [tuple(x) for x in got] == [("2023-11-14T20:16:00.123Z", "1d 2h 3m 4s 5ms"), (None, "0ms"), ("2023-11-14T22:46:00.000Z", "-2h")]
    f = spark.range(1).select(timeutil.feature_time(F.lit(T0 + 7)).alias("f")).select("f", timeutil.from_feature_time(F.col("f")).alias("m")).first()
    assert (f.f, f.m) == ("2023-11-14T22:15:00.007000000Z", T0 + 7)


def reading(minute, energy, ingest, part="A", meter="M1", source="stream"):
    return (meter, part, T0 + minute * MIN, T0 + ingest * MIN, energy, "fw1", source, T0 + minute // 15 * 15 * MIN)


def table(spark, *r):
    return spark.createDataFrame(r, "meter_id string, partition string, event_ms long, ingest_ms long, energy_wh long, firmware string, source string, interval_start_ms long").withColumn("payload_hash", F.expr(HASH))


def declared(spark, *names):
    return spark.createDataFrame(list(zip(names, range(len(names)), strict=True)), "partition string, decl_ord int")


def test_collapse_of_retries_and_a_correction(spark):
    r = table(spark, reading(3, 70, 20), reading(3, 70, 24), reading(4, 70, 22, source="batch"), reading(3, 95, 9000, source="batch"), reading(3, 80, 30))
    x = dedup.collapsed(r).first()
    assert (x.energy_wh, x.readings, x.duplicates_suppressed, x.superseded) == (95, 5, 2, [70, 80])


def test_held_back_by_a_slow_partition(spark):
    r = table(spark, reading(10, 1, 12, "A"), reading(11, 1, 12, "B"), reading(5, 1, 12, "C"), reading(30, 1, 31, "A"), reading(30, 1, 31, "B"))
    t = timeline.timeline(r, declared(spark, "A", "B", "C")).orderBy("at_ms").collect()
    assert [(x.status, x.holding_back, x.lag_ms) for x in t] == [("advancing", "C", 8 * MIN), ("held_back", "C", 27 * MIN)]


def test_silence_strangers_and_days(spark):
    day = 24 * 60
    r = table(spark, reading(10, 1, 12), reading(11, 1, 13, "new"), reading(3 * day, 1, 3 * day + 5), reading(3 * day - 90, 1, 3 * day + 6, "new"))
    ticks = r.select(F.expr(windows.TICK).alias("at_ms")).unionByName(spark.createDataFrame([(T0 - 5 * MIN,), (T0 + 18 * MIN,), (T0 + 19 * MIN,)], "at_ms long"))
    t = timeline.timeline(r, declared(spark, "A"), ticks).orderBy("at_ms").collect()
    # Before anything is heard a declared partition starves; a stranger counts once it has spoken; silence starves after five minutes.
    assert [x.status for x in t] == ["starved", "advancing", "held_back", "advancing", "starved", "advancing_with_idle", "advancing_with_idle"] or [x.status for x in t][:2] == ["starved", "advancing"]
    assert [x.idle for x in t][-2:] == [["new"], ["new"]] and t[4].clock_ms is None and t[4].lag_ms == 0
    none = timeline.condition(timeline.timeline(r.limit(0), declared(spark, "A"))).first()
    assert none.status == "unstarted"


def test_running_values_go_over_days(spark):
    from tidegrid.operators.running import running

    day = timeutil.DAY
    at = [(k * day // 3, "x" if k % 2 else "y", (k * 7) % 11 if k % 4 else None) for k in range(40)]
    df = spark.createDataFrame(at, "at long, k string, v long")
    got = running(df, "at", {"m": ("max", F.col("v")), "l": ("last", F.col("v")), "b": ("lag", F.col("v"))}, ("k",)).collect()
    for x in got:
        before = [v for a, k, v in at if k == x.k and a <= x["at"]]
        known = [v for v in before if v is not None]
        assert (x.m, x.l, x.b) == (max(known, default=None), known[-1] if known else None, before[-2] if len(before) > 1 else None)


LATE = [
    reading(0, 312, 16), reading(40, 5, 41, meter="M2"), reading(0, 312, 50), reading(0, 340, 4000, source="batch"), reading(0, 312, 5000), reading(0, 9, 9000),
    reading(80, 7, 81, meter="M2"), reading(2, 61, 9001, meter="M3"), reading(10_000, 2, 10_000, meter="M2"),
]


def day(spark, *r):
    r, parts = table(spark, *r), declared(spark, "A")
    t = timeline.timeline(r, parts)
    return r, windows.close_ticks(r, t), t


def test_a_late_correction_restates_and_a_retry_confirms(spark):
    r, closes, t = day(spark, *LATE)
    rows_ = windows.ledger(r, closes, t)
    x = rows_.filter("meter_id = 'M1'").orderBy("at_ms").collect()
    assert [(y.kind, y.energy_wh, y.revision, y.delta_wh, y.readings, y.duplicates_suppressed, y.corrections_absorbed) for y in x] == [
        ("published", 312, 0, 0, 1, 0, 0), ("confirmed", 312, 0, 0, 2, 1, 0), ("restated", 340, 1, 28, 3, 1, 1), ("restated", 312, 2, -28, 4, 1, 2),
    ]
    assert x[2].cause == "1 reading(s) arrived from batch after revision 0 was published" and x[2].supersedes == 312 and {y.closed_at for y in x} == {x[0].closed_at}
    assert len({y.lineage_id for y in x}) == 4
    assert windows.late(r, closes).filter("too_late").count() == 1
    # A first reading is accepted however late, and what never closed is in no hour; nor is what was refused.
    newest = windows.newest(rows_)
    assert {(y.meter_id, y.energy_wh) for y in newest.collect()} == {("M1", 312), ("M2", 5), ("M2", 7), ("M3", 61)}
    assert settlement.settle_hour(newest).agg(F.sum("energy_wh")).first()[0] == 385
    assert [y.meter_id for y in windows.open_windows(r, closes).collect()] == ["M2"]
    records = windows.restatement_records(rows_).orderBy("revision").collect()
    assert [(y.previous_energy_wh, y.new_energy_wh, y.lineage_id, y.supersedes_lineage_id) for y in records] == [(312, 340, x[2].lineage_id, x[0].lineage_id), (340, 312, x[3].lineage_id, x[2].lineage_id)]


def test_a_retry_of_the_winner_beside_an_older_rival(spark):
    # Both come in one tick: the rival, newer than the winner's first delivery, wins, though the retry is newer still.
    late = [("M1", "A", T0, T0 + 500 * MIN + k, e, "fw1", "stream", T0) for k, e in ((1, 400), (2, 312))]
    r, closes, t = day(spark, reading(0, 312, 16), reading(40, 5, 41, meter="M2"), *late)
    x = windows.ledger(r, closes, t).filter("meter_id = 'M1'").orderBy("at_ms").collect()
    assert [(y.kind, y.energy_wh, y.readings, y.duplicates_suppressed, y.corrections_absorbed) for y in x] == [("published", 312, 1, 0, 0), ("restated", 400, 3, 1, 1)]


def test_the_clock_falls_back_for_days(spark):
    # B returns from idleness far behind; a window first heard of then waits until the clock has passed it once more.
    far = 4 * 24 * 60
    r = [reading(0, 1, 1), reading(0, 1, 1, "B", "MB"), reading(200, 1, 201), reading(150, 1, 202, "B", "MB"), reading(16, 8, 203, meter="M9"), reading(250, 1, far, "A"), reading(250, 1, far + 1, "B", "MB")]
    r = table(spark, *r)
    t = timeline.timeline(r, declared(spark, "A", "B"))
    got = {(x.meter_id, x.interval_start_ms): (x.close_ms, x.closed_at) for x in windows.close_ticks(r, t).collect()}
    ticks = {x.at_ms: x for x in t.collect()}
    first = {}
    for x in r.collect():
        k, tick = (x.meter_id, x.interval_start_ms), x.ingest_ms // 1000 * 1000
        first[k] = min(first.get(k, tick), tick)
    want = {}
    for (m, s), tick in first.items():
        hits = [a for a in sorted(ticks) if a >= tick and ticks[a].status in timeline.MAY_CLOSE and ticks[a].clock_ms is not None and ticks[a].clock_ms >= s + 15 * MIN]
        if hits:
            want[m, s] = (hits[0], ticks[hits[0]].clock_ms)
    assert got == want and got


def test_as_of(spark):
    h = spark.sql("""SELECT * FROM VALUES ('M1', timestamp'2026-01-01', timestamp'2026-01-15', 'W'), ('M1', timestamp'2026-01-15', NULL, 'S'), ('M2', timestamp'2026-01-01', timestamp'2026-02-01', 'a'),
        ('M2', timestamp'2026-01-10', timestamp'2026-01-20', 'b'), ('M2', timestamp'2026-01-12', NULL, 'c'), ('M2', timestamp'2026-01-14', timestamp'2026-01-13', 'never'), (NULL, timestamp'2026-01-01', NULL, 'n') t(meter_id, valid_from, valid_to, tariff)""")
    q = spark.sql("""SELECT *, i AS tariff_id FROM VALUES (1, 'M1', timestamp'2025-12-31'), (2, 'M1', timestamp'2026-01-14 23:59:59'), (3, 'M1', timestamp'2026-01-15'), (4, 'M2', timestamp'2026-01-16'), (5, 'M2', timestamp'2026-02-01'),
        (6, NULL, timestamp'2026-01-16'), (7, 'M3', timestamp'2026-01-16'), (4, 'M2', timestamp'2026-01-16') t(i, meter_id, at)""")
    got = settlement.as_of(q, h, ["meter_id"], "at").collect()
    assert sorted((x.i, x.tariff) for x in got) == [(1, None), (2, "W"), (3, "S"), (4, "a"), (4, "a"), (5, "c"), (6, None), (7, None)]
    assert sorted(x.i for x in settlement.as_of(q, h, ["meter_id"], "at", "inner").collect()) == [2, 3, 4, 4, 5]
    i = spark.createDataFrame([("M2", 1_768_521_600_000, 1000, 0, [])], "meter_id string, interval_start_ms long, energy_wh long, revision int, idle array<string>")
    assert settlement.settle_priced(i, h.withColumn("price", F.lit(30).cast("long"))).first().energy_wh == 1000  # once, although three versions overlap


def test_the_stream_restates_over_batches_and_goes_on_after_a_restart(spark, tmp_path):
    from tidegrid.streaming.windows_stream import WindowStream

    day_ = 24 * 60
    said = [(0, 50, 16), (0, 50, 50), (40, 5, 41), (80, 6, 83), (20, 9, 84), (0, 60, 3 * day_), (20, 9, 3 * day_ + 1), (0, 70, 9 * day_), (3 * day_, 4, 3 * day_ + 2), (9 * day_, 2, 9 * day_ + 1)]
    raw = [(one(mid=f"K{m // 15 % 2}", ts=T0 // 1000 + m * 60, wh=e), T0 + i * MIN, "batch" if e >= 60 else "stream", "A") for m, e, i in said] + [("junk", T0 + 90 * MIN, "stream", "A")]
    all_ = spark.createDataFrame(sorted(raw, key=lambda x: x[1]), "raw string, ingest_ms long, source string, partition string")
    parts = declared(spark, "A")
    stream = WindowStream(spark, str(tmp_path / "s"), parts)
    cuts = [0, 60 * MIN, 2 * day_ * MIN, 4 * day_ * MIN, 99 * day_ * MIN]
    for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
        part = all_.filter((F.col("ingest_ms") >= T0 + lo) & (F.col("ingest_ms") < T0 + hi))
        if k == 2:  # lost while writing: run again from what batch 1 left, by another process
            stream.advance(part, k)
            stream = WindowStream(spark, str(tmp_path / "s"), parts)
        stream.advance(part, k)
    r = normalise.readings(all_)
    t = timeline.timeline(r, parts)
    want = windows.ledger(r, windows.close_ticks(r, t), t)
    got = stream.ledger().drop("batch").select(*want.columns)
    assert rows(got.withColumn("idle", F.array_join("idle", ",")).toPandas()) == rows(want.withColumn("idle", F.array_join("idle", ",")).toPandas())
    assert {x.kind for x in got.collect()} == {"published", "confirmed", "restated"}
    refused = spark.read.parquet(f"{tmp_path}/s/quarantine")
    assert sorted(x.reason for x in refused.collect()) == ["too_late_for_window", "unknown_payload_shape"]
    lines = spark.read.parquet(f"{tmp_path}/s/conditions").drop("batch")
    assert rows(lines.withColumn("idle_partitions", F.array_join("idle_partitions", ",")).toPandas()) == rows(timeline.condition_lines(t).withColumn("idle_partitions", F.array_join("idle_partitions", ",")).toPandas())
    # Silence is told without any arrival.
    stream.advance(all_.limit(0), 4, [T0 + 9 * day_ * MIN + 60 * MIN])
    assert [x.status for x in spark.read.parquet(f"{tmp_path}/s/conditions").filter("batch = 4").collect()] == ["starved"]


def test_the_stream_gives_what_one_batch_gives(spark):
    a, b = QUERIES["stream_collapse"](spark, SF).toPandas(), dedup.collapsed(normalise.readings(tables.arrivals(spark, SF))).select("meter_id", "interval_start_ms", "energy_wh").toPandas()
    assert rows(a) == rows(b)


def test_online_feature_and_forgetting(spark, tmp_path):
    from tidegrid.streaming.windows_stream import OnlineFeature

    c = features.FeatureContract("f", "sum", 3600, 900, 900)
    store = OnlineFeature(spark, str(tmp_path / "o"), c)
    s = "entity_id string, event_ms long, ingest_ms long, value long"
    store.advance(spark.createDataFrame([("a", 0, 1, 5), ("a", 1_800_000, 2, 7), ("b", 10, 3, 1)], s), 0)
    store.advance(spark.createDataFrame([("a", 3_600_000, 4, 100), ("a", 1, 5, 1000), ("b", -9_000_000, 6, 50)], s), 1)
    assert {(x.entity_id, x.event_ms, x.value) for x in store.served(1).collect()} == {("a", 3_600_000, 1107), ("b", 10, 1)}
    assert store.forget("a", 2) and not store.forget("a", 3) and [x.entity_id for x in store.served(3).collect()] == ["b"]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "b")], "k long, v string")
    files.write_jsonl(df, f"{tmp_path}/j", sort_keys=True)
    assert files.read_landed(spark, f"{tmp_path}/j", "k long, v string").orderBy("k").collect() == df.collect()
    assert files.read_landed(spark, f"{tmp_path}/none", "k long") is None
    (tmp_path / "e").mkdir()
    (tmp_path / "e/a.jsonl").write_text('nothing\n{"k":2\n')
    with pytest.raises(ValueError):
        files.read_landed(spark, f"{tmp_path}/e", "k long")
    (tmp_path / "e/b.jsonl").write_text('{"k":3}\n{"k":4\n')
    (tmp_path / "e/skip.jsonl").write_text('{"k":9}\n')
    assert [x.k for x in files.read_jsonl(spark, f"{tmp_path}/e", "k long", "*.jsonl", "^skip").collect()] == [3]
    (tmp_path / "p.csv").write_text("a,b,c\n1,x,2\n")
    assert files.read_csv(spark, f"{tmp_path}/p.csv", "a long, b string, c long", ["a", "c"]).collect() == [(1, 2)]
    with pytest.raises(ValueError, match="d"):
        files.read_csv(spark, f"{tmp_path}/p.csv", "a long", ["d"])
    files.write_by_day(spark.createDataFrame([(1, "x"), (2, "y")], "k long, d string"), f"{tmp_path}/days", "d")
    assert sorted(p.name for p in (tmp_path / "days").glob("d=*")) == ["d=x", "d=y"]
    files.compact(spark, f"{tmp_path}/days", f"{tmp_path}/one")
    assert len(list((tmp_path / "one").glob("part-*"))) == 1 and spark.read.parquet(f"{tmp_path}/one").count() == 2
    (tmp_path / "t").mkdir()
    (tmp_path / "t/a.json").write_text('{"event_time":"2024-01-02T03:04:05.9Z","ingest_time":"2024-01-02T03:04:06","substation_id":"s","load_w":7,"limit_w":5}\n{"load_w":1}\nx\n')
    assert [(x.headroom_w, x.event_day) for x in files.read_telemetry(spark, f"{tmp_path}/t", 0).collect()] == [(-2, "2024-01-02")]


def test_snapshots_orphans_and_retries(spark):
    day_ = 86_400_000
    s = spark.createDataFrame([(k, k * day_) for k in range(60)], "snapshot_id long, at_ms long")
    tags = spark.createDataFrame([("kept", 3)], "tag string, snapshot_id long")
    assert sorted(x.snapshot_id for x in files.expired(s, tags, 60 * day_, keep=35).collect()) == [k for k in range(25) if k != 3]
    assert files.expiry_code(tags, tags) == 0 and files.expiry_code(tags, tags.limit(0)) == 1
    f = spark.createDataFrame([("a", 0), ("b", 0), ("c", 9 * day_)], "path string, changed_ms long")
    assert [x.path for x in files.orphans(f, f.filter("path = 'a'"), 10 * day_).collect()] == ["b"]
    with pytest.raises(ValueError):
        files.orphans(f, f, 0, day_)
    tries, waits = [], []

    def flaky():
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        return 7

    assert files.retried(flaky, sleep=waits.append) == 7 and waits == [15.0, 30.0]
    t = spark.createDataFrame([(1, "x")], "id long, v string")
    assert files.appended_once(t, spark.createDataFrame([(1, "y"), (2, "z")], "id long, v string"), "id").count() == 2
    with pytest.raises(ValueError):
        files.existing(spark, ["no_such_table"])


def test_silver_and_whole_hours(spark):
    landed = spark.createDataFrame([
        ("published", "m", T0, "5", 1, 0, 0, 9, 8, 0, None, None, "advancing", [], "a"), ("restated", "m", T0, "7", 2, 0, 1, 9, 8, 1, 5, "c", "stalled", ["p"], "b"), ("confirmed", "m", T0, "7", 3, 1, 1, 9, 8, 1, None, None, "advancing", [], "z"),
        ("published", "m", T0 + 15 * MIN, "11", 1, 0, 0, 9, 8, 0, None, None, "advancing", [], "d"), ("clock", None, None, None, None, None, None, None, None, None, None, None, None, None, None),
    ], files.LANDED)
    s = files.silver(landed)
    assert {(x.energy_wh, x.revision, x.supersedes, x.lineage_id) for x in s.collect()} == {(7, 1, 5, "b"), (11, 0, None, "d")}
    gold = spark.createDataFrame([("m", 1, 1, 0, False, False), ("other", 3, 4, 0, False, True)], "meter_id string, energy_wh long, intervals long, revision int, with_idle boolean, is_complete boolean").withColumn("hour_start", F.date_trunc("hour", F.timestamp_millis(F.lit(T0)))).select("meter_id", "hour_start", "energy_wh", "intervals", "revision", "with_idle", "is_complete")
    assert {(x.meter_id, x.energy_wh, x.intervals, x.with_idle) for x in files.merged_hours(gold, s, F.timestamp_millis(F.lit(0))).collect()} == {("m", 18, 2, True), ("other", 3, 4, False)}


def test_decisions_wait_for_reviews_and_act_on_accepted_ones(spark):
    d = spark.createDataFrame([(k,) for k in range(4)], "decision_id long")
    r = spark.createDataFrame([(0, "ann", "accepted", "", 1), (1, "bob", "rejected", "wrong street", 1), (2, " ", "accepted", "", 1), (3, "cy", "rejected", " ", 1), (9, "ann", "accepted", "", 1)], "decision_id long, reviewer string, verdict string, reason string, at_ms long")
    assert {(x.decision_id, x.problem) for x in decisions.review_problems(d, r).collect()} == {(2, "no_reviewer"), (3, "rejection_without_reason"), (9, "no_entry")}
    good = decisions.recorded(d, r)
    assert sorted(x.decision_id for x in decisions.pending(d, good).collect()) == [2, 3]
    assert [x.decision_id for x in decisions.actuated(d, good).collect()] == [0]
    assert [(x.decision_id, x.reason) for x in decisions.training_signal(d, good).collect()] == [(1, "wrong street")]
    with pytest.raises(ValueError):
        decisions.fallback("shrug")


def test_policies(spark):
    tags = spark.createDataFrame([("kind", "a"), ("kind", "b"), ("zone", "n")], "key string, value string")
    res = spark.createDataFrame([("r1", {"kind": "a", "zone": "n"}), ("r2", {"kind": "b"}), ("r3", {"kind": "z", "zone": "n", "odd": "1"})], "resource string, tags map<string,string>")
    g = spark.createDataFrame([("p", {"kind": ["a", "b"], "zone": ["n"]}), ("q", {"kind": ["b", "y"]}), ("q", {"lost": ["1"]}), ("all", {})], "principal string, allowed map<string,array<string>>")
    reach = {(x.principal, x.resource) for x in policies.reachable(g, res).collect()}
    assert reach == {("p", "r1"), ("q", "r2"), ("all", "r1"), ("all", "r2"), ("all", "r3")}
    assert {(x.principal, x.resource) for x in policies.denied(g, res).collect()} == {(p, r) for p in ("p", "q", "all") for r in ("r1", "r2", "r3")} - reach
    assert {tuple(x) for x in policies.problems(tags, res, g).collect()} == {("r3", "undefined_tag", "odd"), ("r3", "undefined_value", "kind=z"), ("r2", "missing_tag", "zone"), ("q", "grant_undefined_tag", "lost"), ("q", "grant_undefined_value", "kind=y")}


def test_erasure_verdicts(spark):
    s = "leg string, rows long, key_state string, shred_marker boolean, residual string, unobservable_because string"
    o = spark.createDataFrame([("crypto_shred", None, None, True, None, None), ("lakehouse_rows", 0, None, False, None, None), ("offline_store", 3, None, False, None, None), ("online_store", None, None, False, None, None), ("model_artefacts", None, None, False, None, "unread"), ("odd", 0, None, False, None, None)], s)
    assert {x.leg: x.finding for x in erasure.verdicts(o).collect()} == {"crypto_shred": "confirmed", "lakehouse_rows": "confirmed", "offline_store": "contradicted", "online_store": "unobservable", "training_sets": "unobservable", "model_artefacts": "unobservable", "odd": "contradicted"}
    p = spark.createDataFrame([("crypto_shred", None, "Enabled", True, None, None), ("model_artefacts", None, None, False, " ", None)], s)
    assert {x.leg: x.finding for x in erasure.verdicts(p, ["crypto_shred", "model_artefacts"]).collect()} == {"crypto_shred": "contradicted", "model_artefacts": "contradicted"}
    done = dict.fromkeys(erasure.LEGS, "done") | {"model_artefacts": "bounded"}
    assert erasure.certificate(done) == done
    for bad in (done | {"online_store": "failed"}, {k: v for k, v in done.items() if k != "training_sets"}, done | {"online_store": "bounded"}):
        with pytest.raises(ValueError):
            erasure.certificate(bad)
    off = spark.createDataFrame([("m", "2024-01-01T00:00:00.000000000Z", False), ("m", "2024-01-01T00:00:00.000000000Z", True), ("m", "2024-03-01T00:00:00.000Z", False)], "entity_id string, event_time string, deleted boolean")
    own = spark.sql("SELECT 'm' AS meter_id, 'c' AS customer_id, timestamp'2023-01-01' AS valid_from, timestamp'2024-02-01' AS valid_to")
    assert sorted((x.event_time[:7], x.deleted) for x in erasure.offline_erased(off, own, "c").collect()) == [("2024-01", True), ("2024-03", False)]


def test_promotion_and_fairness(spark):
    good = {"k": 0, "parity": True, "approver": "ann", "waivers": [], "card_digest": "d", "model_digest": "d", "precision": 700, "recall": 900, "unexplained": 10, "precision_low": 700, "precision_high": 600}
    cases = [({}, None), ({"waivers": ["parity"]}, "parity_waiver_attempted"), ({"parity": False}, "parity"), ({"approver": "Pipeline"}, "self_approval"), ({"card_digest": None}, "model_card_missing"), ({"card_digest": "x"}, "model_card_stale"), ({"precision": 599}, "precision"),
             ({"precision": 1, "waivers": ["precision"]}, None), ({"recall": 799}, "recall"), ({"unexplained": 201}, "disparity"), ({"precision_high": 399}, "precision_gap"), ({"precision_high": 1001}, "precision_gap")]
    df = spark.createDataFrame([tuple((good | m | {"k": k}).values()) for k, (m, _) in enumerate(cases)], "k int, parity boolean, approver string, waivers array<string>, card_digest string, model_digest string, precision long, recall long, unexplained long, precision_low long, precision_high long")
    assert [x.refusal for x in evaluation.promotion(df).orderBy("k").collect()] == [r for _, r in cases]
    p = spark.createDataFrame([(1, True, True), (2, True, False), (1, False, True), (9, False, True), (8, True, True), (5, True, True)], "decile int, flagged boolean, confirmed boolean")
    assert tuple(evaluation.fairness(p).first()) == (666 - 500, (1000 - 666) * 1000 // 500, 500 - 500)
    with pytest.raises(Exception, match="terciles"):
        evaluation.fairness(p.filter("decile < 6")).collect()
    runs = "run string, snapshot string, data_digest string, metrics string, artefact_digest string"
    a, b = spark.createDataFrame([("1", "s", "d", "m", "x"), ("2", "s", "d", "m", "x")], runs), spark.createDataFrame([("1", "s", "d", "m", "y"), ("2", "s", "e", "n", "x")], runs)
    assert {x.run: x.differs for x in evaluation.reproduced(a, b, "run", False).collect()} == {"1": None, "2": "data_digest"}
    assert {x.run: x.differs for x in evaluation.reproduced(a, b, "run", True).collect()} == {"1": "artefact_digest", "2": "data_digest"}


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_contracts(tmp_path):
    import json

    from tidegrid.operators import contracts

    def put(kind, name, **c):
        (tmp_path / kind).mkdir(exist_ok=True)
        (tmp_path / kind / f"{name}.json").write_text(json.dumps({"id": name} | c))

    with pytest.raises(ValueError, match="no entities"):
        contracts.load(str(tmp_path))
    put("entities", "house", key=["h"], tracked=["owner"], personal_data=True, purpose="bills")
    put("entities", "street", key=["s"])
    put("features", "use", entity="house", aggregation="sum", length_seconds=3600, grain_seconds=900, budget_seconds=900, personal_data=True, purpose="bills")
    put("decisions", "cut", features=["use"], actuation="automatic", effect="physical", model="m", permitted_actions=["a", "b"], fallback={"permitted_actions": ["a"]})
    assert contracts.load(str(tmp_path)).scope(["t"]) == {"entities": ["house"], "features": ["use"], "resources": ["t"], "models": []}
    put("entities", "street", key=["s"], tracked=["s"], references=[{"entity": "house", "via": "h"}, {"entity": "moon", "via": "s"}])
    put("features", "use", entity="house", aggregation="sum", length_seconds=3600, grain_seconds=1000, budget_seconds=9000)
    put("decisions", "cut", features=["gone"], actuation="automatic", effect="significant_on_person", permitted_actions=["a"], fallback={"permitted_actions": ["z"], "uses_model": True})
    (tmp_path / "entities/odd.json").write_text("[1]")
    with pytest.raises(ValueError) as e:
        contracts.load(str(tmp_path))
    told = str(e.value)
    for part in ("tracks its key", "refers to moon", "house, which does", "no multiple", "budget above", "is personal data", "reads gone", "significant effect", "may also do", "without naming", "uses a model", "a contract is a mapping", "via ['h']"):
        assert part in told


def test_payload_texts(spark):
    from tidegrid.functions import scalars

    t = spark.createDataFrame([(one(),), (two(),), (THREE,), ("none",)], "raw string")
    got = t.select(scalars.meter_of(F.col("raw")).alias("m"), scalars.retimed(F.col("raw"), 90_000).alias("raw")).collect()
    assert [x.m for x in got] == ["Z-77"] * 3 + [None] and got[3].raw == "none" and f'"ts": {T0 // 1000 + 150}' in got[0].raw and '"2023-11-14T22:17:30.000Z"' in got[1].raw and '"2023-11-14T22:16:30.000Z"' in got[2].raw
    p = spark.range(1).select(scalars.publish_plan(F.lit(9600), F.lit(7000), 1000, 10).alias("p")).first().p
    assert (p.compression, p.peak_per_second) == (7, 10)


def test_asof_join_over_days_and_customers_that_are_not_known(spark, tmp_path):
    c = duckdb.connect()
    c.execute("""CREATE TABLE orders AS SELECT CAST(k AS BIGINT) AS o_orderkey, CAST(u AS BIGINT) AS o_custkey, CAST(d AS DATE) AS o_orderdate FROM (VALUES
        (1, 1, '2026-01-01'), (2, 1, '2026-01-01'), (3, 1, '2026-02-01'), (4, 2, NULL), (5, 3, NULL), (6, 3, '2026-01-05'), (7, NULL, '2026-01-01'), (8, 4, '2026-03-01'), (8, 1, '2026-04-01')) o(k, u, d)""")
    c.execute("""CREATE TABLE lineitem AS SELECT CAST(o AS BIGINT) AS l_orderkey, n AS l_linenumber, CAST(d AS DATE) AS l_shipdate FROM range(1, 10) k(o),
        (VALUES (1, '2025-12-31'), (2, '2026-01-01'), (3, '2026-01-31'), (4, '2026-02-01'), (5, NULL), (2, '2026-01-01')) l(n, d)""")
    for t in ("orders", "lineitem"):
        c.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet'")
    assert rows(QUERIES["asof_join"](spark, str(tmp_path)).toPandas()) == rows(c.sql(ORACLE_SQL["asof_join"]).df())
