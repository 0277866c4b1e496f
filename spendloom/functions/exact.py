"""Sums of doubles that do not depend on the order of the rows.

A sum of doubles rounds after every addition, so its last digits depend on how
the rows meet. Here every amount is cut, without error, into signed digits of
24 bits; each digit is summed as a long, which is exact and cheap in partial
aggregation, and the digits' sums are put together with one rounding at the
end. The result is the double nearest to the exact sum of the doubles (what
``math.fsum`` returns), whatever the partitions.

Range: amounts below 1e24 in absolute value; bits below 2**-88 (3e-27) of an
amount are rounded. Some 5 * 10**11 rows of a group can be summed before a
digit's sum could pass a long, which would fail the job under ANSI rules
instead of returning a wrong total. Totals from 2**85 (4e25) on are rounded twice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Amounts from here on count as missing, as do NaN and infinities.
TOO_LARGE = 1e24
_BITS = 24
#: Exponents of the digits' units, the highest first.
_UNITS = tuple(range(56, -89, -_BITS))
_MASK = (1 << _BITS) - 1


def amount_digits(amount: Column) -> list[Column]:
    """The digits of an amount as longs, NULL where it is missing or too large.

    A digit is the difference of the amount rounded to its unit and rounded
    to the unit above; both are doubles and so is the difference, without error.
    """
    x = F.when(F.abs(amount) < TOO_LARGE, amount)
    rounded = [F.rint(x * 2.0**-unit) for unit in _UNITS]
    digits = rounded[:1] + [low - high * 2.0**_BITS for high, low in zip(rounded, rounded[1:])]
    return [d.cast("long") for d in digits]


def digits_total(sums: list[Column]) -> Column:
    """The double nearest to the number that summed digits stand for; NULL if they are NULL."""
    fields = [s.alias(f"s{k}") for k, s in enumerate(sums)]
    return F.transform(F.array(F.struct(*fields)), lambda s: _rounded([s[f"s{k}"] for k in range(len(sums))]))[0]


def _carried(sums: list[Column]) -> Column:
    """An array of digits between 0 and the base, but for the first, which has the sign."""
    out: list[Column] = []
    carry: Column | None = None
    for s in reversed(sums[1:]):
        s = s if carry is None else s + carry
        out.append(s.bitwiseAND(F.lit(_MASK).cast("long")))
        carry = F.shiftright(s, _BITS)
    return F.array(sums[0] + carry, *reversed(out))


def _rounded(sums: list[Column]) -> Column:
    def of(digits: Column, sign: float) -> Column:
        d = [digits[k] for k in range(len(sums))]
        cases = None
        # the four digits from the first one that is not zero hold more bits than a double; the rest only breaks ties
        for first in range(len(sums) - 3):
            high, low = (F.shiftleft(d[k], _BITS).bitwiseOR(d[k + 1]) for k in (first, first + 2))
            rest = F.lit(0).cast("long")
            for k in range(first + 4, len(sums)):
                rest = rest.bitwiseOR(d[k])
            low = low.bitwiseOR(F.when(rest != 0, 1).otherwise(0).cast("long"))
            value = (high.cast("double") * 2.0 ** (2 * _BITS) + low.cast("double")) * (sign * 2.0 ** _UNITS[first + 3])
            here = (d[first] != 0) if first < len(sums) - 4 else F.lit(True)
            cases = F.when(here, value) if cases is None else cases.when(here, value)
        return cases

    def signed(digits: Column) -> Column:
        negated = F.transform(F.array(_carried([-s for s in sums])), lambda d: of(d, -1.0))[0]
        return F.when(digits[0] < 0, negated).otherwise(of(digits, 1.0))

    return F.when(sums[0].isNotNull(), F.transform(F.array(_carried(sums)), signed)[0])


def exact_sum(amount) -> Column:
    """Aggregate: the exact total of a double column, rounded once; NULL if all amounts are missing."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return digits_total([F.sum(d) for d in amount_digits(amount.try_cast("double"))])
