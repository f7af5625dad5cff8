"""The cleansing rules R01-R08 as column expressions.

Every flag is a non-null boolean, so that a row always lands on exactly one side of a split.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchlake import schemas as S


def parse_time(text: Column) -> Column:
    """R03: the first of the three accepted formats that parses, else NULL.

    A slash occurs in the second format only and a ``T`` in the third only, so looking for
    them first gives the same answer as trying all three, with one parse per row.
    """
    return (
        F.when(text.contains("/"), F.try_to_timestamp(text, F.lit(S.TIME_FORMAT_SLASH)))
        .when(text.contains("T"), F.try_to_timestamp(text, F.lit(S.TIME_FORMAT_T)))
        .otherwise(F.try_to_timestamp(text, F.lit(S.TIME_FORMAT_DASH)))
    )


def parse_quantity(text: Column) -> Column:
    return text.try_cast("int")


def bad_quantity(qty: Column) -> Column:
    """R04: unparsable, not positive, or above the allowed maximum."""
    return qty.isNull() | (qty <= 0) | (qty > S.MAX_QUANTITY)


def parse_price(text: Column) -> Column:
    return text.try_cast(S.PRICE)


def bad_price(price: Column) -> Column:
    """R05: unparsable or not positive."""
    return price.isNull() | (price <= 0)


def parse_discount(text: Column) -> Column:
    """An absent or unparsable discount counts as none."""
    return F.coalesce(text.try_cast(S.PRICE), F.lit(0).cast(S.PRICE))


def expected_pay(qty: Column, price: Column, discount: Column) -> Column:
    """quantity x unit price - discount, in cents. NULL where it does not fit the column."""
    gross = qty.cast("decimal(20,4)") * price
    return F.round(gross - discount.cast("decimal(20,4)"), 2).try_cast(S.PAY)


def bad_amount(
    is_bad_qty: Column, is_bad_price: Column, pay: Column, expected: Column, copies: Column | None = None
) -> Column:
    """R06: paid amount absent or off by more than a cent, or the expected one too large for its
    column, which leaves the row without an amount. Also counts R04 and R05 rows. ``copies``, never 0,
    ties the flag to the de-duplicated row, as in ``reject_rule``."""
    off = F.abs(pay - expected) > F.lit(S.AMOUNT_TOLERANCE).cast("decimal(3,2)")
    bad = is_bad_qty | is_bad_price | pay.isNull() | expected.isNull() | F.coalesce(off, F.lit(False))
    return bad if copies is None else F.when(copies > 0, bad).otherwise(F.lit(False))


def bad_status(status: Column) -> Column:
    """R07: not one of the six legal values."""
    return status.isNull() | ~status.isin(S.LEGAL_STATUSES)


def standard_status(status: Column) -> Column:
    return F.when(status.isin(S.LEGAL_STATUSES), status).otherwise(F.lit(S.STATUS_OTHER))


def valid_order_flag(status: Column) -> Column:
    return F.when(status.isin(S.VALID_STATUSES), F.lit(1)).otherwise(F.lit(0))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def fill_blank(text: Column, filler: str = S.UNKNOWN) -> Column:
    """R01 and R08: trimmed text, or the filler where nothing is left."""
    return F.coalesce(blank_to_null(text), F.lit(filler))


def reject_rule(time_bad: Column, qty_bad: Column, price_bad: Column, copies: Column) -> Column:
    """The first rule that discards the row, NULL for rows that stay.

    The copy count, never 0, ties the result to the de-duplicated row. A filter on it then stays
    above that aggregate; pushed below, it would parse every copy once more before the exchange.
    """
    rule = F.when(time_bad, F.lit("R03")).when(qty_bad, F.lit("R04")).when(price_bad, F.lit("R05"))
    return F.when(copies > 0, rule)


def reject_text(rule: Column) -> Column:
    text = F.lit(None).cast("string")
    for code, words in S.RULE_TEXT.items():
        text = F.when(rule == code, F.lit(words)).otherwise(text)
    return text


def raw_trace() -> Column:
    """A trace of the raw record, whole. NULL fields are skipped, as ``concat_ws`` does."""
    fields = ("order_id", "order_time", "quantity", "unit_price", "pay_amount")
    return F.concat_ws("|", *fields)


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def week_key(ts: Column) -> Column:
    """Calendar year with ISO week number. The days around New Year can pair a year with
    its neighbour's week; published data carries the key that way."""
    return F.concat(F.year(ts), F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))
