"""Regional number formats, guarded ratios and exact sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Decimals that sums and parsed numbers keep unless the caller names another number of them.
SCALE = 10
# Decimals of sums of money: as many as a 64-bit float of a common amount shows.
MONEY_SCALE = 18
_PLAIN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def _ptbr(c: Column) -> Column:
    return F.translate(F.trim(c), ",.", ".")


def _thousands(c: Column) -> Column:
    return F.translate(F.trim(c), ",", "")


def _us_money(c: Column) -> Column:
    return F.translate(F.trim(c), "$,", "")


def _number(text: Column, scale: int) -> Column:
    """The value of a plain number with ``scale`` decimals, half-up; NULL if it is none.

    A number that is too large for 38 digits is an error: what is there never becomes NULL.
    """
    value = text.try_cast(f"decimal(38,{scale})")
    too_large = F.raise_error(F.concat(F.lit("number of more than 38 digits: "), text))
    return F.when(value.isNull() & text.rlike(_PLAIN), too_large.cast(f"decimal(38,{scale})")).otherwise(value)


def _double(text: Column) -> Column:
    """The nearest 64-bit float; NULL for what is no plain number, such as ``NaN`` or ``1f``."""
    return F.when(text.rlike(_PLAIN) | text.try_cast("decimal(38,10)").isNotNull(), text.try_cast("double"))


def more_decimals(text: Column, mark: str = ",", scale: int = SCALE) -> Column:
    """Whether a number, with the decimal mark ``mark``, has more decimals than ``scale``: the parsers round it."""
    shown = F.trim(text)
    decimals = F.length(F.rtrim(F.substring_index(shown, mark, -1), F.lit("0")))
    return F.coalesce(F.contains(shown, F.lit(mark)) & (decimals > scale), F.lit(False))


def parse_ptbr(c: Column, scale: int = SCALE) -> Column:
    """``13.007,12`` as a decimal; NULL where it is not a number. See ``more_decimals`` for what is rounded."""
    return _number(_ptbr(c), scale)


def parse_thousands(c: Column, scale: int = SCALE) -> Column:
    """``1,234.5`` as a decimal; NULL where it is not a number. See ``more_decimals`` for what is rounded."""
    return _number(_thousands(c), scale)


def parse_us_money(c: Column, scale: int = SCALE) -> Column:
    """``$3,655.82`` as a decimal; NULL where it is not an amount. See ``more_decimals`` for what is rounded."""
    return _number(_us_money(c), scale)


def ptbr_double(c: Column) -> Column:
    """``13.007,12`` as the nearest 64-bit float, whatever its decimals."""
    return _double(_ptbr(c))


def thousands_double(c: Column) -> Column:
    """``1,234.5`` as the nearest 64-bit float, whatever its decimals."""
    return _double(_thousands(c))


def format_ptbr(c: Column, places: int = 2) -> Column:
    """``1234.5`` as ``1.234,50``."""
    return F.translate(F.format_number(c, places), ",.", ".,")


def format_brl(c: Column) -> Column:
    """Amount in reais: ``R$ 1.234,50`` with a no-break space."""
    sign = F.when(c < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.lit("R$\u00a0"), format_ptbr(F.abs(c)))


def format_thousands(c: Column) -> Column:
    """``1234567`` as ``1.234.567``."""
    return F.translate(F.format_number(c, 0), ",", ".")


def plain_decimal(c: Column) -> Column:
    """All digits of a double without an exponent (``1.0E7`` is ``10000000.0``)."""
    text = c.cast("string")
    wide = F.regexp_replace(text.try_cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(F.contains(text, F.lit("E")), F.coalesce(wide, text)).otherwise(text)


def decimal_comma(c: Column) -> Column:
    return F.translate(plain_decimal(c), ".", ",")


def ratio(num: Column, den: Column, places: int = 2) -> Column:
    """Rounded ``num / den``; 0 where the denominator is not positive."""
    return F.round(F.when(den > 0, num / den).otherwise(F.lit(0.0)), places)


def percent(num: Column, den: Column, places: int | None = None) -> Column:
    """``num`` as a share of ``den`` in percent; 0 where ``den`` is not positive."""
    share = F.when(den > 0, num / den * 100).otherwise(F.lit(0.0))
    return share if places is None else F.round(share, places)


def exact(c: Column, scale: int = SCALE) -> Column:
    """A value as a decimal with ``scale`` decimals, so that sums do not depend on row order.

    A value of more than 38 digits in all raises an error; none is cut.
    """
    return c.cast(f"decimal(38,{scale})")


def exact_sum(c: Column, scale: int = SCALE) -> Column:
    """Sum, 0 for no rows. Values are summed with ``scale`` decimals."""
    return F.coalesce(F.sum(exact(c, scale)).cast("double"), F.lit(0.0))


def money(c: Column) -> Column:
    """An amount as an exact decimal, so that sums do not depend on row order; nothing is rounded to cents."""
    return exact(c, MONEY_SCALE)


def money_sum(c: Column) -> Column:
    """Sum of the amounts as they are, 0 for no rows."""
    return exact_sum(c, MONEY_SCALE)


def difference(a: Column, b: Column) -> Column:
    """``a - b`` of amounts as their decimals show them, so that 0.3 - 0.1 is 0.2."""
    return (money(a) - money(b)).cast("double")


def exact_avg(c: Column, places: int = 2, scale: int = SCALE) -> Column:
    """Rounded mean that does not depend on row order; ``scale`` decimals are summed."""
    total = F.sum(exact(c, scale)).cast("double")
    return F.round(total / F.nullif(F.count(c), F.lit(0)), places)
