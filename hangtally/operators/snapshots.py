"""Month snapshots of stock, kept as versioned month files.

A snapshot holds the stock per store and SKU at a month's end. The next one is the last one plus the month's ledger, but
a store that counted (or first opened) meanwhile starts again from its count. So a month reads the last snapshot and one month of the
ledger, however long the history is. A ledger line that comes late changes the snapshots of those months in which its store had not
yet started again, and only their files are written anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangtally.functions import day
from hangtally.operators import stock as ST
from hangtally.operators.ledger import union_rows
from hangtally.sources.readers import within_months
from hangtally.sources.versions import Versions, written

ROWS = "store_id bigint, sku bigint, qty double"
STARTS = "store_id bigint, start_date date, origin string, counted boolean"
KEYS = ["store_id", "sku"]


@dataclass(frozen=True)
class Sources:
    """counts, openings, stores as in ``operators.stock``; the ledger has store_id, sku, move_date, qty and is partitioned by ``month``."""
    counts: DataFrame
    openings: DataFrame
    ledger: DataFrame
    stores: DataFrame


class MonthSnapshots:
    """Snapshot files under ``root``, one part per month end, and each store's start for every month end."""

    def __init__(self, spark, root: str, drop_zero_stores: Sequence[int] = ()):
        self.months = Versions(spark, f"{root}/months", ROWS, "end_date")
        self.starts = Versions(spark, f"{root}/starts", STARTS, "end_date")
        self.drop_zero_stores = list(drop_zero_stores)

    def ends(self) -> list[str]:
        return sorted(e["part"] for e in self.months.current()[1])

    def read(self, ends: Sequence[str] | None = None) -> DataFrame:
        """store_id, sku, qty, end_date of some or all months. Months without a snapshot are skipped."""
        entries = [e for e in self.months.current()[1] if ends is None or e["part"] in ends]
        return self.months.read(entries, with_part=True).withColumn("end_date", F.to_date("end_date"))

    def build(self, src: Sources, today: str, ends: Sequence[str]) -> None:
        """Snapshots from all history, for all ends in one pass over the ledger."""
        self._closed(today, ends)
        starts = self._starts(src, today, ends)
        rows = ST.stock_at(src.counts, src.openings, src.ledger, src.stores, today, ends, [], starts)
        self._keep(rows.select(*KEYS, "qty", "end_date"), starts)

    def advance(self, src: Sources, today: str, end: str) -> None:
        """The snapshot of ``end`` from the last one and the ledger since then."""
        self._closed(today, [end])
        last = self.ends()[-1]
        if end <= last:
            raise ValueError(f"{end} does not follow {last}")
        starts = self._starts(src, today, [end])
        then = self.starts.read([e for e in self.starts.current()[1] if e["part"] == last]).drop("counted")
        going = starts.join(then, ["store_id", "start_date", "origin"], "left_semi")
        again = starts.join(going, "store_id", "left_anti")
        since = within_months(src.ledger, "move_date", last, end).where(F.col("move_date") > day(last))
        injected = src.openings.where((F.col("inject_date") > day(last)) & (F.col("inject_date") <= day(end)))
        kept = union_rows([
            self.read([last]).select(*KEYS, "qty"), since.select(*KEYS, "qty"),
            # opening balances count for stores whose count came to nothing
            injected.join(going.where("not counted"), "store_id", "left_semi").select(*KEYS, "qty"),
        ]).join(going, "store_id", "left_semi")
        opened = ST.opening_stock(src.counts, src.openings, again)
        rows = union_rows([kept, opened.select(*KEYS, "qty"), ST.ledger_at_ends(src.ledger, again, [end]).select(*KEYS, "qty")])
        self._keep(rows.groupBy(*KEYS).agg(F.sum("qty").alias("qty")).withColumn("end_date", day(end)), starts)

    def late(self, lines: DataFrame) -> list[str]:
        """Adds ledger lines (store_id, sku, move_date, qty) that came after their months were closed; the month ends written anew."""
        ends = self.ends()
        starts = self.starts.read(self.starts.current()[1], with_part=True).withColumn("end_date", F.to_date("end_date"))
        changes = Versions(lines.sparkSession, f"{self.months.root}-late", ROWS, "end_date")
        entries = changes.write(ST.ledger_at_ends(lines, starts, ends))
        hit = sorted(e["part"] for e in entries)
        if hit:
            delta = changes.read(entries, with_part=True).withColumn("end_date", F.to_date("end_date"))
            rows = union_rows([self.read(hit).select(*KEYS, "end_date", "qty"), delta.select(*KEYS, "end_date", "qty")])
            self._keep(rows.groupBy(*KEYS, "end_date").agg(F.sum("qty").alias("qty")))
        return hit

    @staticmethod
    def _closed(today: str, ends: Sequence[str]) -> None:
        if any(e > today for e in ends):
            raise ValueError("a month that is not over has no snapshot; use stock_at")

    def _starts(self, src: Sources, today: str, ends: Sequence[str]) -> DataFrame:
        starts = ST.last_count_dates(src.counts, src.openings, src.stores, today, ends)
        total = (src.counts.select("store_id", "count_date", "qty").join(starts, "store_id").where("count_date between start_date and end_date")
                 .groupBy("store_id", "end_date").agg((F.sum("qty") != 0).alias("counted")))
        starts = starts.join(total, ["store_id", "end_date"], "left").withColumn("counted", F.coalesce("counted", F.lit(False)))
        return written(starts, "snapshot-starts")   # one row per store and month end

    def _keep(self, rows: DataFrame, starts: DataFrame | None = None) -> None:
        """New files for the months of ``rows``; the starts first, so that a month never stands without them."""
        if starts is not None:
            self._swap(self.starts, starts)
        dropped = F.col("store_id").isin(self.drop_zero_stores) & (F.col("qty") == 0)
        self._swap(self.months, rows.where(~dropped))

    @staticmethod
    def _swap(table: Versions, rows: DataFrame) -> None:
        number, entries = table.current()
        new = table.write(rows)
        parts = {e["part"] for e in new}
        table.commit(number, [*(e for e in entries if e["part"] not in parts), *new])
