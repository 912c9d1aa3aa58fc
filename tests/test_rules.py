import pytest
from pyspark.sql import functions as F

from hangtally import constants as K
from hangtally import functions as X
from hangtally.operators import sizerun as G


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("value,digits,want", [(2.5, 0, 2.0), (3.5, 0, 4.0), (2.675, 2, 2.68), (0.125, 2, 0.12), (-2.5, 0, -2.0)])
def test_round_even_scales_first(spark, value, digits, want):
    assert one(spark, X.round_even(F.lit(value), digits)) == pytest.approx(want)


def test_zero_division_and_nulls(spark):
    assert one(spark, X.ratio(F.lit(1.0), F.lit(0.0))) == 0.0
    assert one(spark, X.ratio(F.lit(None).cast("double"), F.lit(2.0))) == 0.0
    assert one(spark, X.percent(F.lit(1.0), F.lit(3.0))) == 33.33


def test_sku_is_trimmed_upper_cased_and_repaired(spark):
    assert one(spark, X.clean_sku(F.lit(" abc1 "))) == "ABC1"
    assert one(spark, X.clean_sku(F.lit("bbrd103v042333-"))) == "BBRD103V042333"


def test_surrogate_key_null_part(spark):
    assert one(spark, X.surrogate_key(F.lit(3), F.lit("240101"), F.lit(7))) == "3/240101/7"
    assert one(spark, X.surrogate_key(F.lit(3), F.lit(None))) is None


@pytest.mark.parametrize("days,want", [(0, "BAIK"), (3, "BAIK"), (4, "SEDANG"), (10, "SEDANG"), (11, "BURUK")])
def test_delay_score(spark, days, want):
    assert one(spark, X.delay_score(F.lit(days))) == want


@pytest.mark.parametrize("group,flag,want", [(2, "T", "MDS"), (3, "F", "RMY"), (4, "F", "Other"), (9, "T", "Consi"), (1, "T", None), (None, "T", None)])
def test_store_class(spark, group, flag, want):
    assert one(spark, X.store_detail_class(F.lit(group).cast("int"), F.lit(flag))) == want


def test_price_class_of_every_category(spark):
    assert len(K.CATEGORY_PRICE_FLOOR) == 29
    data = [(c, float(p + delta)) for c, p in K.CATEGORY_PRICE_FLOOR.items() for delta in (-1, 0)]
    df = spark.createDataFrame(data, "c string, p double").withColumn("e", F.lit("SP"))
    got = {(r.c, r.p): r.x for r in df.withColumn("x", X.price_class("e", "c", "p")).collect()}
    assert all(got[(c, float(p))] == "Normal" and got[(c, float(p - 1))] == "Obral" for c, p in K.CATEGORY_PRICE_FLOOR.items())
    assert one(spark, X.price_class(F.lit("DISC 70%"), F.lit("none"), F.lit(1))) == "Obral"
    assert one(spark, X.price_class(F.lit("NORMAL"), F.lit("SWEAT SHIRT"), F.lit(1))) == "Normal"
    assert one(spark, X.price_class(F.lit(None).cast("string"), F.lit("unknown"), F.lit(1))) is None


@pytest.mark.parametrize("event,bonus,price,disc", [
    ("SP 299", "F", 9.0, 0), ("DISC 50%+20%", "F", 100.0, 60), ("DISC 50%", "F", 100.0, 50), ("POTONGAN", "F", 80.0, 5),
    ("DISC 70%", "F", 100.0, 70), ("NORMAL", "F", 100.0, 0), (None, "F", 100.0, 5), ("NORMAL", "T", 9.0, 5)])
def test_event_price(spark, event, bonus, price, disc):
    df = spark.createDataFrame([(event, bonus, 9.0, 100.0, 80.0, 5.0)], "e string, b string, m double, l double, p double, d double")
    p, q = X.event_price_and_discount("e", "b", "m", "l", "p", "d")
    assert tuple(df.select(p, q).first()) == (price, disc)


@pytest.mark.parametrize("k,s,b,want", [(1, 1, 1, "ksb"), (2, 2, 1, "ks"), (2, 1, 2, "kb"), (1, 2, 2, "sb"), (3, 1, 2, "k"), (1, 3, 2, "s"), (0, 0, 1, "b")])
def test_dominant_bucket(spark, k, s, b, want):
    df = spark.createDataFrame([(k, s, b)], "size_small int, size_medium int, size_large int")
    assert df.select(G.dominant_bucket()).first()[0] == want


def stock(spark, rows):
    return spark.createDataFrame(rows, "store int, article string, size string, qty double, size_class string")


def test_run_status_thresholds(spark):
    tops = [(1, "two", z, 1.0, "TOP") for z in ("S", "M")] + [(1, "three", z, 1.0, "TOP") for z in ("S", "M", "XXXL")]
    free = [(1, "free", z, 1.0, "TOP") for z in ("FS", "SS", "M")]            # FS and SS do not count
    pants = [(1, "four", str(z), 1.0, "BOTTOM") for z in (25, 30, 42, 44)] + [(1, "five", str(z), 1.0, "BOTTOM") for z in (25, 26, 30, 42, 44)]
    odd = [(1, "odd", "99", 5.0, "TOP"), (1, "odd", None, 1.0, "TOP"), (1, "minus", "S", -1.0, "TOP"), (None, "lost", "S", 1.0, "TOP")]
    other = [(1, "other", "S", 1.0, None)]
    wide = G.run_status(G.size_pivot(stock(spark, tops + free + pants + odd + other), ["store", "article"], "qty"))
    got = {r.article: (r.status, r.sum_qty) for r in wide.collect()}
    assert got == {"two": ("BROKEN", 2), "three": ("SEHAT", 3), "free": ("BROKEN", 3), "four": ("BROKEN", 4), "five": ("SEHAT", 5),
                   "odd": ("BROKEN", 0), "minus": ("BROKEN", -1), "other": ("SEHAT", 1)}
    v2 = G.run_status(G.size_pivot(stock(spark, tops + free), ["store", "article"], "qty"), top=K.TOP_RUN_WITH_FREE, top_min=2)
    assert {r.article: r.status for r in v2.collect()} == {"two": "SEHAT", "three": "SEHAT", "free": "SEHAT"}


def test_pivot_never_grows_rows(spark):
    df = stock(spark, [(1, "a", "S", 1.0, "TOP"), (1, "a", "30", 1.0, "BOTTOM")])
    assert [(r.size_class, r.sum_qty) for r in G.size_pivot(df, ["store", "article"], "qty").collect()] == [("TOP", 2)]


def test_top_half_sizes(spark):
    df = spark.createDataFrame([(1, "S", 5.0), (1, "M", 3.0), (1, "L", 2.0), (2, "S", 0.0), (3, "S", 1.0), (3, "M", 1.0), (4, "S", 2.0), (4, "M", 3.0),
                                (4, "L", 3.0)], "k int, size string, q double")
    got = {r.k: r.dominant_sizes for r in G.top_half_sizes(df, ["k"], "q").collect()}
    assert got == {1: "S", 2: "", 3: "M", 4: "L, M"}


def test_text_rules(spark):
    assert one(spark, X.letters_title(F.lit(" 1. aNNA b*OB  "))) == "Anna Bob"
    assert one(spark, X.fix_mojibake(F.lit("bobâ€™s â"))) == "bob’s "
    assert one(spark, X.to_number(F.lit("x1"))) == 0.0
    assert one(spark, X.key_from_suffix(F.lit("RC/A/17"))) == "17"
