"""Column functions over dense vectors."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalized(a: Column) -> Column:
    """Of length 1; as it is where it has none."""
    return F.when(norm(a) > 1e-12, F.transform(a, lambda x: x.cast("double") / norm(a))).otherwise(F.transform(a, lambda x: x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Of vectors of any length, within 0 and 1; 0 for empty ones and unlike sizes."""
    raw = dot(a, b) / (norm(a) * norm(b))
    fits = (F.size(a) == F.size(b)) & (F.size(a) > 0) & (norm(a) > 0) & (norm(b) > 0)
    return F.when(fits, F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))).otherwise(0.0)


def usable(a: Column, dim: int) -> Column:
    """``dim`` values, none null, not all zero."""
    return F.coalesce((F.size(a) == dim) & F.forall(a, lambda x: x.isNotNull()) & F.exists(a, lambda x: x != 0), F.lit(False))
