"""Column expressions.  All of them stay inside the JVM; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hangtally import constants as K


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- text and keys ---------------------------------------------------------

def recode(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace whole values by a small fixed mapping; other values stay."""
    c = col(c)
    out = c
    for old, new in mapping.items():
        out = F.when(c == old, F.lit(new)).otherwise(out)
    return out


def clean_sku(c: Column | str) -> Column:
    return recode(F.upper(F.trim(col(c))), K.SKU_REPAIRS)


def remove_spaces(c: Column | str) -> Column:
    return F.replace(col(c), F.lit(" "), F.lit(""))


def letters_title(c: Column | str) -> Column:
    """Letters and white space only, trimmed, each word capitalised."""
    return F.initcap(F.trim(F.regexp_replace(col(c), r"[^A-Za-z\s]", "")))


def drop_commas(c: Column | str) -> Column:
    return F.replace(col(c), F.lit(","), F.lit(""))


def fix_mojibake(c: Column | str) -> Column:
    """Undo a right single quote that was decoded with the wrong code page."""
    c = F.replace(col(c), F.lit("â€™"), F.lit("’"))
    return F.replace(c, F.lit("â"), F.lit(""))


def surrogate_key(*parts: Column | str) -> Column:
    """Join the parts with '/'.  A null part gives a null key, so a key check can see it."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("/"))
        pieces.append(col(part).cast("string"))
    return F.concat(*pieces)


def code_label(code: Column | str, name: Column | str) -> Column:
    return F.concat(col(code), F.lit(" - "), col(name))


def key_from_suffix(doc_no: Column | str) -> Column:
    """The last '/' separated part of a document number."""
    return F.substring_index(col(doc_no), "/", -1)


# ---- numbers ---------------------------------------------------------------

def to_number(c: Column | str) -> Column:
    return F.coalesce(col(c).try_cast("double"), F.lit(0.0))


def zero(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0))


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, and 0 where b is 0 or a side is null."""
    return F.coalesce(F.try_divide(col(a), col(b)), F.lit(0.0))


def round_even(c: Column | str, digits: int = 0) -> Column:
    """Half-even rounding of a double: scale, round to the nearest integer, scale back."""
    scale = float(10 ** digits)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def percent(a: Column | str, b: Column | str, digits: int = 2) -> Column:
    return round_even(ratio(a, b) * F.lit(100.0), digits)


def money(c: Column | str) -> Column:
    """Exact decimal for sums of amounts, whatever the order of addition."""
    return col(c).cast("decimal(18,2)")


def money_sum(c: Column | str) -> Column:
    return F.sum(money(c)).cast("double")


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_where(condition: Column, value: Column | str) -> Column:
    return F.coalesce(F.sum(F.when(condition, col(value))), F.lit(0.0))


# ---- dates -----------------------------------------------------------------

def us_date(c: Column | str) -> Column:
    return F.to_date(col(c), "MM-dd-yyyy")


def month_start(c: Column | str) -> Column:
    return F.trunc(col(c), "MM")


def months_between_labels(late: Column | str, early: Column | str) -> Column:
    """Calendar months from ``early`` to ``late``, days ignored."""
    late, early = col(late), col(early)
    return (F.year(late) - F.year(early)) * 12 + (F.month(late) - F.month(early))


def in_year(c: Column | str, year: int) -> Column:
    """A range test, so that it reaches the file scan."""
    c = col(c)
    return (c >= F.lit(f"{year}-01-01").cast("date")) & (c < F.lit(f"{year + 1}-01-01").cast("date"))


def day(value: str) -> Column:
    return F.lit(value).cast("date")


# ---- business rules --------------------------------------------------------

def net_amount(gross, second_disc, margin) -> Column:
    return (col(gross) - col(second_disc)) * (1 - col(margin) / 100)


def simulated_amount(status, gross, net) -> Column:
    return F.when(col(status) == K.NO_MARGIN, col(gross)).otherwise(col(net))


def before_tax(amount) -> Column:
    return col(amount) / F.lit(K.TAX_DIVISOR)


def store_detail_class(group_id, net_flag) -> Column:
    group_id, net_flag = col(group_id), col(net_flag)
    return (F.when(group_id == 2, "MDS")
            .when(group_id == 3, "RMY")
            .when((group_id > 3) & (net_flag == "F"), "Other")
            .when((group_id > 3) & (net_flag == "T"), "Consi"))


def price_class(event, category, amount) -> Column:
    """Class by event text, else by the price floor of the category, else null."""
    floors = F.create_map(*[F.lit(x) for kv in K.CATEGORY_PRICE_FLOOR.items() for x in kv])
    floor = F.try_element_at(floors, col(category))
    return (F.when(col(event).isin(K.MARKDOWN_EVENTS), K.CLASS_MARKDOWN)
            .when(col(event).isin(K.NORMAL_EVENTS), K.CLASS_NORMAL)
            .when(floor.isNull(), F.lit(None).cast("string"))
            .when(col(amount) >= floor, K.CLASS_NORMAL)
            .otherwise(K.CLASS_MARKDOWN))


def delay_score(days) -> Column:
    days = col(days)
    return F.when(days <= 3, "BAIK").when(days.between(4, 10), "SEDANG").otherwise("BURUK")


def first_true(branches: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """Value of the first branch whose condition holds."""
    head, *rest = branches
    out = reduce(lambda acc, b: acc.when(*b), rest, F.when(*head))
    return out.otherwise(default)


def event_price_and_discount(event, bonus, mark_amount, list_price, price, disc) -> tuple[Column, Column]:
    """Selling price and unit discount by event text, repaired first; the first matching rule wins."""
    event, bonus = recode(event, K.EVENT_REPAIRS), col(bonus)
    mark_amount, list_price = col(mark_amount), col(list_price)
    price, disc = col(price), col(disc)
    rules = [
        (bonus.contains("T"), mark_amount, disc),
        (event.rlike("SP|NP"), mark_amount, disc * 0),
        (event.contains("DISC 50%+20%"), list_price, list_price * 0.6),
        (event.contains("DISC 50%"), list_price, list_price * 0.5),
        (event.contains("POTONGAN"), price, disc),
        (event.contains("DISC 70%"), list_price, list_price * 0.7),
        (event.contains("NORMAL"), list_price, disc * 0),
    ]
    new_price = first_true([(cond, p) for cond, p, _ in rules], list_price)
    new_disc = first_true([(cond, d) for cond, _, d in rules], disc)
    return new_price, F.coalesce(F.rint(new_disc).cast("int"), F.lit(0))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
