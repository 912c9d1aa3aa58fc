"""Today's ledger kept current from a stream of document lines.

Lines are kept in a log-structured way, one part per input day: a *base* with the newest version of every line folded
so far, and *deltas*, the lines of one micro-batch each. A batch adds its deltas to the list of versions under its own number, so
a batch that runs again replaces its own and nothing is counted twice. Folding a day merges its base and deltas into a new base;
the list then names that base alone, and readers of the older list keep the folders they know. A refresh of a day reads one base
and the deltas that are still open.

Of several versions of a line the latest input time wins, wherever it stands, so replays, late and corrected lines and any
order of folding leave the sums right. A corrected line keeps its input day; the day is its part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from hangtally.sources.versions import Versions

LINE_COLUMNS = ["line_id", "store_id", "sku", "move_date", "stat", "qty", "input_ts"]
LINES = "line_id bigint, store_id bigint, sku bigint, move_date date, stat string, qty double, input_ts timestamp_ntz, batch bigint"
BASE, DELTA = "base", "delta"
#: Batches a base remembers as folded into it; a batch that runs again is one of the last.
REMEMBERED = 100


def stream_lines(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000,
                 glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def newest(lines: DataFrame) -> DataFrame:
    """The newest version of every line: the latest input time, then the latest batch."""
    rest = [c for c in [*LINE_COLUMNS, "input_day"] if c not in ("line_id", "input_ts")]
    version = F.max(F.struct("input_ts", "batch", *rest)).alias("_l")
    return lines.groupBy("line_id").agg(version).select("line_id", "_l.*")


class DayLog:
    """The lines under ``root``. ``fold_at``: deltas of a day from which the batch that adds the last folds the day."""

    def __init__(self, spark: SparkSession, root: str, fold_at: int = 30):
        self.table = Versions(spark, root, LINES, "input_day")
        self.fold_at = fold_at

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        number, entries = self.table.current()
        if any(e["kind"] == BASE and str(batch_id) in e["tag"].split() for e in entries):
            # the batch was folded before it ran again: its lines stand in the bases of the days it had
            held = {e["part"] for e in entries if e["kind"] == BASE and str(batch_id) in e["tag"].split()}
            batch = batch.where(~F.to_date("input_ts").cast("string").isin(list(held)))
        rows = batch.select(*LINE_COLUMNS, F.lit(batch_id).cast("bigint").alias("batch"), F.to_date("input_ts").alias("input_day"))
        new = self.table.write(rows, kind=DELTA, tag=str(batch_id))
        kept = [e for e in entries if not (e["kind"] == DELTA and e["tag"] == str(batch_id))]
        self.table.commit(number, [*kept, *new])
        waiting = {}
        for e in [*kept, *new]:
            if e["kind"] == DELTA:
                waiting[e["part"]] = waiting.get(e["part"], 0) + 1
        if full := [d for d in {e["part"] for e in new} if waiting[d] >= self.fold_at]:
            self.fold(full)

    def fold(self, days: list[str] | None = None) -> list[str]:
        """Merges base and deltas of some days, or of all that have deltas; the days folded."""
        number, entries = self.table.current()
        open_ = {e["part"] for e in entries if e["kind"] == DELTA and (days is None or e["part"] in days)}
        if not open_:
            return []
        mine = [e for e in entries if e["part"] in open_]
        new = self.table.write(self._newest(mine), kind=BASE)
        tags = {d: " ".join(sorted({t for e in mine if e["part"] == d for t in e["tag"].split()}, key=int)[-REMEMBERED:]) for d in open_}
        new = [Row(**{**e.asDict(), "tag": tags[e["part"]]}) for e in new]
        self.table.commit(number, [*(e for e in entries if e["part"] not in open_), *new])
        return sorted(open_)

    def _newest(self, entries: list[Row]) -> DataFrame:
        lines = self.table.read(entries, with_part=True).withColumn("input_day", F.to_date("input_day"))
        return newest(lines)

    def current_lines(self, day: str | None = None) -> DataFrame:
        """The newest version of every line, optionally of one input day; other days' folders are not opened."""
        entries = [e for e in self.table.current()[1] if day is None or e["part"] == day]
        return self._newest(entries).drop("batch")


def start(lines: DataFrame, log: DayLog, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Run the stream every two minutes, or once over what is there."""
    writer = lines.writeStream.foreachBatch(log.write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="2 minutes")
    return writer.start()


def day_ledger(lines: DataFrame) -> DataFrame:
    """Sum by store, SKU, date and kind for every input day."""
    return (lines.groupBy("input_day", "store_id", "sku", "move_date", "stat")
            .agg(F.sum("qty").alias("qty"), F.count("*").alias("lines")))
