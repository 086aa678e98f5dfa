"""Column expressions shared by the operators. All of them stay inside code generation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text columns that are trimmed, and the shape of an ordinary product code.
STRING_COLUMNS = ("invoice", "stock_code", "description", "country")
CODE_PATTERN = r"^\d{5}\w*$"
# Every character with the Unicode White_Space property.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def named(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def timestamp(value: datetime) -> Column:
    """Zone-free literal, so results do not depend on the session or Python time zone."""
    return F.expr(f"TIMESTAMP_NTZ '{value:%Y-%m-%d %H:%M:%S.%f}'")


def stripped(column: str | Column) -> Column:
    """Strip every kind of whitespace; plain ``trim`` removes only spaces.

    A set of characters costs a fraction of an anchored regular expression.
    """
    return F.trim(named(column), F.lit(WHITESPACE))


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed time truncated to whole days, not a difference of calendar dates.

    Zone-free times are subtracted as such; ``timestamp_diff`` would read them in the session's
    zone and lose an hour where clocks change.
    """
    return F.extract(F.lit("DAY"), end - start).cast("bigint")


def micros_since_epoch(time: Column) -> Column:
    """A zone-free time as one long."""
    elapsed = (time - F.expr("TIMESTAMP_NTZ '1970-01-01'")).cast("interval second")
    return (elapsed.cast("decimal(18,6)") * 1_000_000).cast("bigint")


def line_value() -> Column:
    return F.col("quantity") * F.col("price")


def gross_value() -> Column:
    return F.abs(line_value())


def is_cancelled_invoice() -> Column:
    return F.col("invoice").startswith("C")


def invoice_kind() -> Column:
    # Names of the kinds.
    return (
        F.when(F.col("invoice").rlike(r"^\d+$"), "numeric")
        .when(is_cancelled_invoice(), "C prefix")
        .otherwise("UNCLASSIFIED")
    )


def is_standard_code() -> Column:
    return F.col("stock_code").rlike(CODE_PATTERN)
