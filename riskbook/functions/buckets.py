"""Numbering of values by exponent and leading bits: an order-keeping histogram that needs no look at the data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PER_OCTAVE = 32


def bucket(value: Column, per_octave: int = PER_OCTAVE) -> Column:
    """Number of the value's bucket: rising with the value, null for null and NaN.

    Each power of two holds ``per_octave`` (a power of two itself) buckets of equal width. All steps
    but the logarithm are exact, so every engine and every task numbers a value alike.
    """
    v = value.cast("double")
    size = F.abs(v)
    # The logarithm may be off by one at powers of two; comparing with the power itself settles it.
    guess = F.floor(F.log2(size))
    power = lambda e: F.pow(F.lit(2.0), e.cast("double"))
    guess = F.when(power(guess) > size, guess - 1).otherwise(guess)
    guess = F.when(power(guess + 1) <= size, guess + 1).otherwise(guess)
    within = F.floor((size / power(guess) - 1) * per_octave)
    number = (guess + 1100) * per_octave + within + 1
    number = F.when(size == float("inf"), F.lit(per_octave * 3000)).otherwise(number)
    return F.when(v.isNull() | F.isnan(v), F.lit(None)).when(v == 0, F.lit(0)).when(v > 0, number).otherwise(-number).cast("long")
