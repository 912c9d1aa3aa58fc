"""The signed movement ledger, built from header / line documents.

Each document family is joined once and a line can give up to two ledger rows (the
movement and its cancellation), instead of one scan and join per kind of row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangtally import constants as K


@dataclass(frozen=True)
class Family:
    """Headers (doc_id, doc_no, store_id, doc_date, input_date, status, cancel_date) and
    lines (doc_id, sku, qty, stock_qty, line_status, line_cancel_date, cancelled_by, kind)."""
    headers: DataFrame
    lines: DataFrame

    def joined(self, header_filter: Column | None = None, line_filter: Column | None = None) -> DataFrame:
        headers = self.headers if header_filter is None else self.headers.where(header_filter)
        lines = self.lines if line_filter is None else self.lines.where(line_filter)
        return lines.join(headers, "doc_id")


@dataclass(frozen=True)
class Documents:
    receiving: Family
    adjustment: Family
    sale: Family
    returned: Family
    transfer: Family


def _signed(tag: str, keep: Column, qty: Column) -> Column:
    return F.when(keep, F.struct(F.lit(tag).alias("stat"), qty.cast("double").alias("qty")))


def _emit(joined: DataFrame, rows: Sequence[Column]) -> DataFrame:
    kept = F.filter(F.array(*rows), lambda r: r.isNotNull())
    return (joined.withColumn("_row", F.explode(kept))
            .select("store_id", "sku", F.col("doc_date").alias("move_date"), "doc_no",
                    F.col("_row.stat").alias("stat"), F.col("_row.qty").alias("qty")))


def movement_rows(docs: Documents, date_filter: Column | None = None) -> DataFrame:
    """Nine kinds of ledger rows dated by their document; ``date_filter`` is on doc_date.

    A cancelled line shows as a movement and as its cancellation.
    """
    qty, void = F.col("qty"), F.col("line_status") == K.VOID
    final = (F.col("status") == K.FINAL) & F.col("cancelled_by").isNull()
    parts = [
        _emit(docs.receiving.joined(date_filter),
              [_signed(K.RECEIVE, F.col("status") != K.VOID, qty)]),
        _emit(docs.adjustment.joined(date_filter),
              [_signed(K.ADJUST_IN, final & (F.col("kind") == "I"), qty),
               _signed(K.ADJUST_OUT, final & (F.col("kind") == "O"), -qty)]),
        _emit(docs.sale.joined(date_filter),
              [_signed(K.SALE_VOID, void, qty),
               _signed(K.SALE, F.col("doc_no").startswith("PJ"), -qty)]),
        _emit(docs.returned.joined(date_filter),
              [_signed(K.RETURN_VOID, void, qty),
               _signed(K.RETURN, F.col("doc_no").startswith("RT"), -qty)]),
        _emit(docs.transfer.joined(date_filter),
              [_signed(K.TRANSFER_VOID, void, qty),
               _signed(K.TRANSFER, F.col("doc_no").startswith("MT"), -qty)]),
    ]
    return union_rows(parts)


def day_rows(docs: Documents, asof: str) -> DataFrame:
    """Eleven kinds of ledger rows that were entered or cancelled on one day.

    Entered rows filter the header's input date, cancelled rows the line's cancel date
    (whole-transfer cancels the header's), each before its join.  Partial cancels give
    back stock - sent.  Unlike the dated ledger, cancelled sales are left out of sales.
    """
    d = F.lit(asof).cast("date")
    entered, cancelled = F.col("input_date") == d, F.col("line_cancel_date") == d
    qty, back = F.col("qty"), F.col("stock_qty") - F.col("qty")
    final, live = F.col("status") == K.FINAL, F.col("cancelled_by").isNull()
    void, partly = F.col("line_status") == K.VOID, F.col("cancelled_by").isNotNull()
    always = F.lit(True)
    parts = [
        _emit(docs.receiving.joined(entered & (F.col("status") != K.VOID)),
              [_signed(K.RECEIVE, always, qty)]),
        _emit(docs.adjustment.joined(entered & final, live),
              [_signed(K.ADJUST_IN, F.col("kind") == "I", qty),
               _signed(K.ADJUST_OUT, F.col("kind") == "O", -qty)]),
        _emit(docs.sale.joined(None, cancelled & void), [_signed(K.SALE_VOID, always, qty)]),
        _emit(docs.sale.joined(entered & F.col("doc_no").startswith("PJ"),
                               F.col("line_cancel_date").isNull()), [_signed(K.SALE, always, -qty)]),
        _emit(docs.returned.joined(None, cancelled),
              [_signed(K.RETURN_VOID, void, qty), _signed(K.RETURN_PART, partly, back)]),
        _emit(docs.returned.joined(entered & F.col("doc_no").startswith("RT")),
              [_signed(K.RETURN, always, -qty)]),
        _emit(docs.transfer.joined(F.col("cancel_date") == d, void),
              [_signed(K.TRANSFER_VOID, always, qty)]),
        _emit(docs.transfer.joined(None, cancelled & partly), [_signed(K.TRANSFER_PART, always, back)]),
        _emit(docs.transfer.joined(entered & F.col("doc_no").startswith("MT")),
              [_signed(K.TRANSFER, always, -qty)]),
    ]
    return union_rows(parts)


def union_rows(parts: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=allow_missing)
    return out


def net(rows: DataFrame, keys: Sequence[str] = ("store_id", "sku", "move_date", "stat"),
        out: str = "qty") -> DataFrame:
    """Signed sum; the kind of movement stays part of the key."""
    return rows.groupBy(*keys).agg(F.coalesce(F.sum("qty"), F.lit(0.0)).alias(out))


#: Parts a month of the ledger is dealt to.
MONTH_CELLS = 8


def net_by_month(rows: DataFrame, date: str, keys: Sequence[str] = ("store_id", "sku", "move_date", "stat")) -> DataFrame:
    """The signed sum with the ``month`` of its date: rows are dealt once, by month and a hash of store and SKU, and this serves
    both the sum and the writing by month."""
    dealt = rows.withColumns({"month": F.date_format(date, "yyyy-MM"),
                              "_cell": F.pmod(F.xxhash64("store_id", "sku"), F.lit(MONTH_CELLS))}).repartition("month", "_cell")
    return net(dealt, (*keys, "month", "_cell")).select(*keys, "qty", "month")


def returns_ledger(docs: Documents, start: str, end: str) -> DataFrame:
    """Return rows (-) and cancelled returns (+) between two dates, one join."""
    window = F.col("doc_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    qty = F.col("qty")
    return _emit(docs.returned.joined(window),
                 [_signed(K.RETURN_VOID, F.col("line_status") == K.VOID, qty),
                  _signed(K.RETURN, F.col("doc_no").startswith("RT"), -qty)])
