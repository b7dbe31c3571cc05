"""Search and range maxima in sorted arrays, for use inside higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bit_length(n: Column) -> Column:
    """Binary digits of a positive integer."""
    return F.length(F.bin(n.cast("bigint")))


def _power(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), k)


def count_before(values: Column, x: Column, inclusive: bool) -> Column:
    """How many elements of the sorted array stand before ``x`` (with those equal to it if ``inclusive``), by bisection."""
    n = F.size(values)

    def halve(range_: Column, _: Column) -> Column:
        low, high = range_["low"], range_["high"]
        middle = F.call_function("shiftright", low + high, F.lit(1))
        value = F.get(values, middle)
        right = (low < high) & ((value <= x) if inclusive else (value < x))
        return F.struct(F.when(right, middle + 1).otherwise(low).alias("low"),
                        F.when(right | (low >= high), high).otherwise(middle).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), bit_length(n)), F.struct(F.lit(0).alias("low"), n.alias("high")),
                       halve, lambda range_: range_["low"])


def max_table(values: Column) -> Column:
    """Sparse table of an array: level k holds the greatest of each 2**k neighbours (nulls count as nothing)."""
    n = F.size(values)

    def level(table: Column, k: Column) -> Column:
        below, half = F.get(table, k - 1), _power(k - 1)
        return F.concat(table, F.array(F.transform(
            F.sequence(F.lit(0), n - _power(k)), lambda i: F.greatest(F.get(below, i), F.get(below, i + half)))))

    return F.when(n < 2, F.array(values)).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.greatest(bit_length(n) - 1, F.lit(1))), F.array(values), level))


def range_max(table: Column, first: Column, last: Column) -> Column:
    """Greatest value at the places ``first`` to ``last``, counted from 0; null if there is none."""
    k = bit_length(last - first + 1) - 1
    row = F.get(table, k)
    return F.when(first <= last, F.greatest(F.get(row, first), F.get(row, last - _power(k) + 1)))
