"""Text and number parsing as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitbars.schemas import EXACT

# Every character Unicode counts as white space, plus the four
# ASCII separators U+001C to U+001F.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


# Sign, digits before and after the point, exponent; one digit at least is asked for apart.
DECIMAL_TEXT = r"^([+-]?)(\d*)(?:\.(\d*))?(?:(?<=[\d.])[eE]([+-]?\d+))?$"


def stripped(text: Column) -> Column:
    """Remove Unicode blanks at both ends; plain ``trim`` removes U+0020 only.

    Text that starts and ends with a visible ASCII character, as nearly all
    does, is recognised by comparing those two and passed through.
    """
    # The last byte, since finding the last character means counting all of them.
    last = F.substring(text.cast("binary"), -1, 1)
    clean = text.between("!", "~\x7f") & last.between(F.lit(bytearray(b"!")), F.lit(bytearray(b"~")))
    return F.when(clean, text).otherwise(F.btrim(text, F.lit(BLANKS)))


def is_blank(text: Column) -> Column:
    """True for NULL and for text that is empty once stripped."""
    return text.isNull() | (F.length(text) == 0)


def exact_number(text: Column) -> Column:
    """Unrounded decimal, NULL where the stripped text is not a number."""
    return text.try_cast(EXACT)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def whole_number(text: Column) -> Column:
    """Integral value of the stripped text; ``5.0`` and ``1e3`` count, ``12.5`` does not.

    Plain digits take the first branch. Other spellings are judged as text, digit by digit, before any
    cast, so no digit however small is rounded away; their parts are found once.
    """
    spelled_out = text.contains(".") | text.contains("e") | text.contains("E")
    groups = [F.regexp_extract(text, DECIMAL_TEXT, n).alias(name) for n, name in ((1, "sign"), (2, "whole"), (3, "part"), (4, "power"))]

    def shifted(parts: Column) -> Column:
        digits = F.concat(parts["whole"], parts["part"])
        exponent = F.when(parts["power"] == "", F.lit(0)).otherwise(parts["power"].try_cast("int"))
        scale = F.length(parts["part"]).cast("bigint") - exponent
        return F.struct(
            parts["sign"].alias("sign"), digits.alias("digits"), scale.alias("scale"), F.length(F.rtrim(digits, F.lit("0"))).alias("core")
        )

    def valued(number: Column) -> Column:
        digits, scale = number["digits"], number["scale"]
        kept = (F.length(digits) - F.greatest(scale, F.lit(0))).cast("int")
        # Nineteen digits are more than any bigint has.
        zeros = F.repeat(F.lit("0"), F.least(F.greatest(-scale, F.lit(0)), F.lit(19)).cast("int"))
        value = F.concat(number["sign"], F.left(digits, kept), zeros).try_cast("bigint")
        exact = F.length(digits) - number["core"] >= scale
        return F.when(number["core"] == 0, F.lit(0).cast("bigint")).when(exact, value)

    spelled = let(let(F.struct(*groups), shifted), valued)
    return F.coalesce(F.when(~spelled_out, text.try_cast("bigint")), F.when(text.rlike(DECIMAL_TEXT) & text.rlike("[0-9]"), spelled))
