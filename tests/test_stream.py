import datetime as dt

from pyspark.sql import functions as F

from hangtally.streaming import intraday as I

COLS = "line_id long, store_id long, sku long, move_date date, input_ts timestamp_ntz, stat string, qty double"


def line(i, day, qty=1.0, hour=9):
    t = dt.datetime(2024, 5, day, hour, i % 60)
    return (i, i % 3, i % 5, t.date(), t, "penjualan", qty)


def run(spark, src, base, fold_at=30):
    lines = I.stream_lines(spark, src, spark.read.schema(COLS).parquet(src).schema, files_per_batch=1)
    log = I.DayLog(spark, f"{base}/lines", fold_at)
    I.start(lines, log, f"{base}/check", once=True).awaitTermination()
    return log.current_lines()


def test_stream_equals_batch_in_any_file_order(spark, rows, tmp_path):
    data = [line(i, 1 + i % 2) for i in range(40)]
    results = []
    for name, chunks in (("a", [data[:20], data[20:]]), ("b", [data[20:], data[:20]])):
        src = str(tmp_path / f"src_{name}")
        for c in chunks:
            spark.createDataFrame(c, COLS).coalesce(1).write.mode("append").parquet(src)
        results.append(rows(I.day_ledger(run(spark, src, str(tmp_path / name)))))
    batch = spark.createDataFrame(data, COLS).withColumn("input_day", F.to_date("input_ts"))
    assert results[0] == results[1] == rows(I.day_ledger(batch))


def test_repeated_and_corrected_lines(spark, rows, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([line(1, 1), line(2, 1)], COLS).coalesce(1).write.parquet(src)
    run(spark, src, base)
    # the same lines again, one with another quantity, and a new line of a day long closed
    spark.createDataFrame([line(1, 1), line(2, 1, qty=5.0), line(3, 1)], COLS).coalesce(1).write.mode("append").parquet(src)
    now = run(spark, src, base)
    assert rows(now, "line_id", "qty") == [(1, 1.0), (2, 5.0), (3, 1.0)]
    assert rows(I.DayLog(spark, f"{base}/lines").current_lines("2024-05-02")) == []


def kinds(log):
    return sorted((e["part"], e["kind"], e["rows"]) for e in log.table.current()[1])


def test_replayed_batch_replaces_itself(spark, rows, tmp_path):
    log = I.DayLog(spark, str(tmp_path / "lines"))
    df = spark.createDataFrame([line(1, 1), line(2, 2)], COLS)
    log.write_batch(df, 0)
    log.write_batch(df, 0)
    assert rows(log.current_lines(), "line_id") == [(1,), (2,)]
    assert kinds(log) == [("2024-05-01", "delta", 1), ("2024-05-02", "delta", 1)]
    log.fold()
    log.write_batch(df, 0)   # folded already
    assert kinds(log) == [("2024-05-01", "base", 1), ("2024-05-02", "base", 1)]


def test_refresh_reads_one_base_and_open_deltas_of_its_day(spark, rows, tmp_path):
    log = I.DayLog(spark, str(tmp_path / "lines"), fold_at=3)
    for k in range(7):
        log.write_batch(spark.createDataFrame([line(10 * k, 1, qty=k + 1.0), line(5, 1, qty=k + 1.0, hour=9 + k), line(10 * k + 1, 2 + k)], COLS), k)
    assert [e["kind"] for e in log.table.current()[1] if e["part"] == "2024-05-01"] == ["base", "delta"]
    day = log.current_lines("2024-05-01")
    assert rows(day, "line_id", "qty") == sorted([(10 * k, k + 1.0) for k in range(7)] + [(5, 7.0)], key=str)
    assert len(day.inputFiles()) == 2 and all("2024-05-01" in f for f in day.inputFiles())
    # a line that comes late, older than the one that stands
    log.write_batch(spark.createDataFrame([line(5, 1, qty=99.0, hour=8)], COLS), 7)
    assert (5, 7.0) in rows(log.current_lines("2024-05-01"), "line_id", "qty")
    assert log.fold() and {e["kind"] for e in log.table.current()[1]} == {"base"}
    assert (5, 7.0) in rows(log.current_lines("2024-05-01"), "line_id", "qty") and log.fold() == []


def test_crash_while_folding_changes_nothing(spark, rows, tmp_path, monkeypatch):
    log = I.DayLog(spark, str(tmp_path / "lines"))
    for k in range(3):
        log.write_batch(spark.createDataFrame([line(k, 1), line(9, 1, qty=k + 1.0, hour=9 + k)], COLS), k)
    before = rows(log.current_lines())
    older = log.current_lines()   # a reader of the list before
    monkeypatch.setattr(log.table, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    try:
        log.fold()
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert rows(log.current_lines()) == before and len(kinds(log)) == 3
    log.fold()
    assert rows(log.current_lines()) == before == rows(older) and len(kinds(log)) == 1


def test_newest_input_wins_in_any_batch(spark, rows, tmp_path):
    old, new = line(9, 1, hour=8), line(9, 1, hour=9)
    old, new = (old[0], 9, *old[2:]), (new[0], 2, *new[2:])
    for name, chunks in (("one", [[old, new]]), ("two", [[old], [new]]), ("late", [[new], [old]])):
        src = str(tmp_path / f"src_{name}")
        for c in chunks:
            spark.createDataFrame(c, COLS).coalesce(1).write.mode("append").parquet(src)
        assert rows(run(spark, src, str(tmp_path / name)), "line_id", "store_id") == [(9, 2)]
