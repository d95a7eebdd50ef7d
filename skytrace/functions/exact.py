"""Sums of doubles that do not depend on the order in which they are taken.

A number is taken apart into whole multiples of a few fixed powers of two, each exact; those are added
as whole numbers, so any partitioning gives the same sums, and put together again at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of a bin; 2 ** 39 numbers can be added before a bin of 63 bits is full.
WIDTH = 24
#: Exponents of the bins: numbers below 2 ** 99 are held to 2 ** -117 (dropped is what lies below).
EXPONENTS = tuple(range(76, -117, -WIDTH))
_LIMIT = 2.0 ** (EXPONENTS[0] + WIDTH - 1)


class ExactSum:
    """Aggregates of one sum, named after ``name``, and the sum that they make."""

    def __init__(self, name: str, value: Column) -> None:
        self.name, self.value = name, value
        self._bins = [f"_{name}_{i}" for i in range(len(EXPONENTS))]

    def aggregates(self) -> list[Column]:
        held = F.abs(self.value) < _LIMIT  # false for NaN and infinities
        inside = F.when(held, self.value)
        scaled = [F.rint(inside * (2.0**-e)) for e in EXPONENTS]
        # The bits that the bin above has not taken; the difference of two close doubles is exact.
        digits = [scaled[0]] + [
            low - high * (2.0**WIDTH) for high, low in zip(scaled, scaled[1:], strict=False)
        ]
        bins = [F.sum(d.cast("long")).alias(b) for d, b in zip(digits, self._bins, strict=True)]
        return [*bins, F.sum(F.when(~held, self.value)).alias(f"_{self.name}_rest")]

    def total(self) -> Column:
        """The sum as a double, from the aggregates; NULL where nothing was added."""

        def carried(sign: int) -> list[Column]:
            """Bins from the highest on, all but it from 0 to 2 ** WIDTH - 1."""
            carry, out = F.lit(0).cast("long"), []
            for name in reversed(self._bins[1:]):
                own = F.col(name) * sign + carry
                out.append(own.bitwiseAND((1 << WIDTH) - 1))
                carry = F.shiftright(own, WIDTH)
            return [F.col(self._bins[0]) * sign + carry, *reversed(out)]

        def joined(bins: list[Column]) -> Column:
            parts = [b.cast("double") * (2.0**e) for b, e in zip(bins, EXPONENTS, strict=True)]
            return reduce(lambda a, b: a + b, reversed(parts))  # the least first: one rounding counts

        up, down = carried(1), carried(-1)
        exact = F.when(up[0] >= 0, joined(up)).otherwise(-joined(down))
        rest = F.col(f"_{self.name}_rest")
        return F.when(rest.isNull(), exact).when(F.col(self._bins[0]).isNull(), rest).otherwise(rest + exact)
