"""Streams."""

from __future__ import annotations

from hangtally.catalog.registry import query
from hangtally.session import scratch_path
from hangtally.sources.standins import Standins
from hangtally.streaming import intraday as I


@query("intraday_ledger_stream", """
    SELECT CAST(input_ts AS DATE) AS input_day, store_id, sku, move_date, stat, SUM(qty) AS qty, COUNT(*) AS lines
    FROM intraday GROUP BY ALL""", dates=["input_day", "move_date"])
def _(s):
    stream = I.stream_lines(s.spark, s.folder, s.raw("events").schema, glob="events.parquet")
    base = scratch_path(s.spark, "intraday")
    log = I.DayLog(s.spark, f"{base}/lines")
    I.start(Standins.intraday_of(stream), log, f"{base}/checkpoint", once=True).awaitTermination()
    log.fold()
    return I.day_ledger(log.current_lines())
