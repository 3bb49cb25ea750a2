"""Signal measures on sample arrays, as array expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def rms(x: Column) -> Column:
    """D1."""
    return F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v) / F.size(x))


def peak(x: Column) -> Column:
    return F.array_max(F.transform(x, lambda v: F.abs(v)))


def peak_dbfs(x: Column) -> Column:
    """Minus infinity for silence."""
    return F.when(peak(x) > 0, 20 * F.log10(peak(x))).otherwise(F.lit(float("-inf")))


def limited(x: Column, ceiling: float) -> Column:
    """D3: never scales up."""
    gain = F.least(F.lit(1.0), F.try_divide(F.lit(ceiling), peak(x)))
    return F.transform(x, lambda v: v * gain)


def to_peak(x: Column, dbfs: float) -> Column:
    """One gain; near silence stays."""
    return F.when(peak(x) < 1e-4, x).otherwise(F.transform(x, lambda v: v * (F.lit(10 ** (dbfs / 20)) / peak(x))))


def padded(x: Column, n: int) -> Column:
    """D8."""
    quiet = F.array_repeat(F.lit(0.0), n)
    return F.concat(quiet, x, quiet)


def tiled(x: Column, n: int) -> Column:
    """Repeated or cut to n samples."""
    return F.slice(F.flatten(F.array_repeat(x, F.ceil(F.lit(n) / F.size(x)).cast("int"))), 1, n)


def faded(x: Column, n: int) -> Column:
    """From 0 to 1 over n samples at the start and back at the end, over half of shorter signals; of a fade of one sample the start is silent and the end isn't."""
    k = F.least(F.lit(n), F.floor(F.size(x) / 2)).cast("int")
    ramp = lambda i, alone: F.when(i >= k, 1.0).otherwise(F.coalesce(F.try_divide(i.cast("double"), (k - 1).cast("double")), F.lit(alone)))
    return F.transform(x, lambda v, i: v * ramp(i, 0.0) * ramp(F.size(x) - 1 - i, 1.0))
