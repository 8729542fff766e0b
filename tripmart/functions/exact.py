"""Averages of doubles that do not depend on the order of the sum.

A double is known by its shortest decimal text, digits times a power of ten.
Values below 10^15 are decimals of two places; greater ones are whole numbers of
at most 22 digits times the power of ten of their bin, five powers to a bin.
Sums within a bin are exact decimals and merge in any order; the bins, at most
sixty, are added in one fixed order at the end.  Nothing is left out: infinity has
a bin of its own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PART_TYPE = "decimal(28,2)"
PLAIN_BELOW = 1e15
BIN_WIDTH = 5
DIGITS = 16  # decimal places of a mantissa of 17 digits
PLAIN_BIN, INFINITE_BIN = 0, 1000


def _mantissa(text: Column) -> Column:
    return F.regexp_extract(text, r"^(-?[0-9.]+)E", 1)


def _exponent(text: Column) -> Column:
    return F.regexp_extract(text, r"E([0-9]+)$", 1).cast("int")


def bin_of(x: Column) -> Column:
    """The bin of a double; NULL and what is below 10^15 share one."""
    exponent = _exponent(x.cast("string"))
    return (F.when(x.isNull() | (F.abs(x) < PLAIN_BELOW), F.lit(PLAIN_BIN))
            .when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(INFINITE_BIN))
            .otherwise(exponent - exponent % BIN_WIDTH))


def part_of(x: Column) -> Column:
    """What a double adds to the sum of its bin."""
    text = x.cast("string")
    digits = (F.regexp_replace(F.rpad(_mantissa(text), DIGITS + 2, "0"), r"\.", ""),
              F.regexp_replace(F.rpad(_mantissa(text), DIGITS + 3, "0"), r"\.", ""))
    whole = F.when(x < 0, digits[1]).otherwise(digits[0])
    shifted = F.concat(whole, F.repeat(F.lit("0"), _exponent(text) % BIN_WIDTH))
    return (F.when(x.isNull() | (F.abs(x) < PLAIN_BELOW), x.cast(PART_TYPE))
            .when(F.isnan(x), F.lit(0).cast(PART_TYPE))
            .when(F.abs(x) == float("inf"), F.signum(x).cast(PART_TYPE))
            .otherwise(shifted.cast(PART_TYPE)))


def rounded_average(bins: Column, places: int = 2) -> Column:
    """round(sum / count, places) as a double from an array of
    (bin, part: sum of parts, n: values); NULL without values.

    The usual case, one plain bin, is a decimal division.  Else the bins are added
    from the greatest down; an infinity decides alone, two unlike ones or a NaN give
    NaN."""
    ordered = F.sort_array(bins, asc=False)
    count = F.aggregate(bins, F.lit(0).cast("bigint"), lambda a, b: a + b["n"])
    plain = F.round(F.element_at(ordered, 1)["part"] / F.nullif(count, F.lit(0)), places).cast("double")
    scaled = lambda b: F.when(  # noqa: E731  parsed, so rounded once
        b["bin"] == PLAIN_BIN, b["part"].cast("double")).otherwise(
        F.concat(b["part"].cast("string"), F.lit("E"), (b["bin"] - DIGITS).cast("string")).cast("double"))
    total = F.aggregate(ordered, F.lit(0.0), lambda a, b: a + F.coalesce(scaled(b), F.lit(0.0)))
    first = F.element_at(ordered, 1)
    infinite = (F.when(F.abs(first["part"]) == first["n"], F.signum(first["part"].cast("double")) * F.lit(float("inf")))
                .otherwise(F.lit(float("nan"))))
    return (F.when(F.size(bins) == 0, F.lit(None).cast("double")).when(first["bin"] == INFINITE_BIN, infinite)
            .when((F.size(bins) == 1) & (first["bin"] == PLAIN_BIN), plain)
            .otherwise(F.round(total / count, places)))
