"""Windows that close, stay published and restate over the batches of a stream, as one batch over all of it would have them.

Nothing here is left to the framework's own notion of lateness: a batch's ticks go on from the last tick of the batch before.
Each batch writes under its own number, so one that is run again after a loss overwrites what it had written, and reads what
was there before it. Files hold whole seconds of ingestion, in order.

Under the folder: ledger, quarantine, conditions (what came of a batch), published (the last outcome of each window a batch
touched; only windows of a batch's own time span are read back), open (readings of windows not yet published), heard and last
(what the event clock carries on).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegrid.functions.timeutil import INTERVAL
from tidegrid.operators import features, normalise, timeline, windows
from tidegrid.operators.dedup import KEY
from tidegrid.sources.files import exists
from tidegrid.sources.staging import staged

READING = "meter_id string, interval_start_ms long, event_ms long, ingest_ms long, energy_wh long, firmware string, payload_hash string, partition string, source string"
PUBLISHED = f"meter_id string, interval_start_ms long, o {windows.OUTCOME}"


class WindowStream:
    """The stream's windows under folder, for the declared partitions (partition, decl_ord)."""

    def __init__(self, spark: SparkSession, folder: str, partitions: DataFrame):
        self.spark, self.folder, self.partitions = spark, folder, partitions

    def _before(self, part: str, schema: str, batch: int, every: bool = False) -> DataFrame:
        """What earlier batches wrote to a part: of the last one, or of every one."""
        found = [k for k in range(batch - 1, -1, -1) if exists(self.spark, f"{self.folder}/{part}/batch={k}/_SUCCESS")]
        paths = [f"{self.folder}/{part}/batch={k}" for k in (found if every else found[:1])]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, part: str, batch: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{part}/batch={batch}")

    def advance(self, arrivals: DataFrame, batch: int, silent_at: list[int] | None = None) -> None:
        """Takes a batch of arrivals; silent_at names ticks (ms) without any, at which starvation is told too."""
        fields = [f.name for f in StructType.fromDDL(READING)]
        norm = staged(normalise.normalised(arrivals))
        good = norm.filter("reason IS NULL").select(*fields)
        heard, last = self._before("heard", timeline.HEARD, batch), self._before("last", timeline.LAST, batch)
        at = good.select(F.expr(windows.TICK).alias("at_ms"))
        if silent_at:
            at = at.unionByName(self.spark.createDataFrame([(t,) for t in silent_at], "at_ms long"))
        t = timeline.clocked(good, self.partitions, at.distinct(), None if heard.isEmpty() else heard, None if last.isEmpty() else last)
        line = t.drop("moved_at", "arrived_at", "leader", "p")

        # Windows that batches before this one published, of the time that this batch's readings are of.
        span = good.agg(F.min("interval_start_ms").alias("lo"), F.max("interval_start_ms").alias("hi")).first()
        log = self._before("published", PUBLISHED, batch, every=True)
        log = log.filter(F.col("interval_start_ms").between(span["lo"], span["hi"])) if span["lo"] is not None else log.limit(0)
        known = staged(log.join(good.select(*KEY).distinct(), KEY, "left_semi").groupBy(*KEY).agg(F.max_by("o", "o.at_ms").alias("remembered")))
        to_old = good.join(known, KEY).withColumn("step_ms", F.expr(windows.TICK))
        pool = staged(good.join(known, KEY, "left_anti").unionByName(self._before("open", READING, batch)))
        closes = windows.close_ticks(pool, line)
        to_new = pool.join(closes.select(*KEY, "close_ms", "closed_at"), KEY).withColumn("step_ms", F.greatest(F.expr(windows.TICK), F.col("close_ms")))
        overdue = F.col("ingest_ms") - (F.col("interval_start_ms") + INTERVAL) > windows.ALLOWED_LATENESS
        after = F.col("step_ms") > F.col("close_ms")
        admitted = to_new.filter(~(after & overdue)).select(*fields, "step_ms").unionByName(to_old.filter(~overdue).select(*fields, "step_ms"))
        refused = to_new.filter(after & overdue).select(*fields).unionByName(to_old.filter(overdue).select(*fields))
        steps = windows.steps(admitted).join(closes.select(*KEY, "closed_at"), KEY, "left").join(known, KEY, "left")
        outcomes = staged(windows.folded(steps))

        self._write("ledger", batch, windows.ledger_rows(outcomes, line))
        bad = norm.filter("reason IS NOT NULL").select("reason", "detail", F.col("raw").alias("payload"))
        too_late = refused.select(F.lit("too_late_for_window").alias("reason"), F.lit("its window was published and the allowed lateness is over").alias("detail"), F.col("payload_hash").alias("payload"))
        self._write("quarantine", batch, bad.unionByName(too_late))
        self._write("conditions", batch, timeline.condition_lines(line, None if last.isEmpty() else last))
        self._write("published", batch, outcomes.groupBy(*KEY).agg(F.max_by("o", "o.at_ms").alias("o")))
        self._write("open", batch, pool.join(closes.select(*KEY), KEY, "left_anti"))
        # The clock's state: the last tick's, or what it was before if this batch had no tick.
        end = t.agg(F.max_by(F.struct("p", "at_ms", "leader", "clock_ms", "moved_at", "arrived_at", "status", "holding_back"), "at_ms").alias("x")).filter("x IS NOT NULL")
        new_heard = end.select(F.explode("x.p").alias("p")).select("p.partition", "p.decl_ord", "p.h")
        new_last = end.select("x.at_ms", "x.leader", "x.clock_ms", "x.moved_at", "x.arrived_at", "x.status", "x.holding_back")
        some = not end.isEmpty()
        self._write("heard", batch, new_heard if some else heard)
        self._write("last", batch, new_last if some else last)

    def start(self, stream: DataFrame, **trigger):
        """A started query that advances by each batch of stream; run again, it goes on where it stopped."""
        writer = stream.writeStream.foreachBatch(lambda rows, batch: self.advance(rows, batch)).option("checkpointLocation", f"{self.folder}/checkpoint")
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def ledger(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/ledger")


class OnlineFeature:
    """What an online store holds of a feature: each entity's rows of the last length of event time, by batch under folder.

    Rows leave by the greatest event time of their entity, so a very old row that comes late changes nothing.
    """

    ROWS = "entity_id string, event_ms long, ingest_ms long, value long"

    def __init__(self, spark: SparkSession, folder: str, contract: features.FeatureContract):
        self.spark, self.folder, self.contract = spark, folder, contract

    def _at(self, version: int) -> DataFrame:
        return self.spark.read.schema(self.ROWS).parquet(f"{self.folder}/rows/version={version}") if version >= 0 else self.spark.createDataFrame([], self.ROWS)

    def advance(self, rows: DataFrame, version: int) -> None:
        """Takes the rows of version, which follows version - 1; taken again it gives the same."""
        both = self._at(version - 1).unionByName(rows.select("entity_id", "event_ms", "ingest_ms", "value"))
        last = both.groupBy("entity_id").agg(F.max("event_ms").alias("_last"))
        both.join(last, "entity_id").filter(F.col("event_ms") > F.col("_last") - self.contract.length_s * 1000).drop("_last").write.mode("overwrite").parquet(f"{self.folder}/rows/version={version}")

    def served(self, version: int) -> DataFrame:
        """entity_id, event_ms and value of every entity."""
        made = features.AGGREGATIONS[self.contract.aggregation](F.col("value")).cast("long").alias("value")
        return self._at(version).groupBy("entity_id").agg(F.max("event_ms").alias("event_ms"), made)

    def forget(self, entity: str, version: int) -> bool:
        """Writes version without an entity; whether version - 1 had it."""
        rows = self._at(version - 1)
        rows.filter(F.col("entity_id") != entity).write.mode("overwrite").parquet(f"{self.folder}/rows/version={version}")
        return not rows.filter(F.col("entity_id") == entity).isEmpty()
