"""Number and vector functions: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import bound


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b; null if b is (nearly) 0 or the result isn't finite."""
    r = F.try_divide(a.cast("double"), b.cast("double"))
    return F.when((F.abs(b) >= 1e-12) & ~F.isnan(r) & (F.abs(r) != float("inf")), r)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Null if a norm is 0 or a side is null."""
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(n > 0, F.try_divide(dot(a, b), n))


def cosine_eps(a: Column, b: Column, eps: float = 1e-9) -> Column:
    """With a small constant in the denominator, so never null for non-null sides."""
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + eps)


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Sum of smaller values over sum of larger ones."""
    low = F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0.0), lambda s, x: s + x)
    high = F.aggregate(F.zip_with(a, b, lambda x, y: F.greatest(x, y)), F.lit(0.0), lambda s, x: s + x)
    return safe_ratio(low, high)


def pearson(x: Column, y: Column) -> Column:
    """Aggregate: null with under 3 pairs or a (nearly) constant side."""
    ok = x.isNotNull() & y.isNotNull()
    x, y = F.when(ok, x), F.when(ok, y)
    sx, sy = F.stddev_pop(x), F.stddev_pop(y)
    return F.when((F.count(x) >= 3) & (sx >= 1e-8) & (sy >= 1e-8), F.try_divide(F.covar_pop(x, y), sx * sy))


def array_pearson(a: Column, b: Column) -> Column:
    """Correlation of two arrays over the places where both are finite; null with under 3 of them or a (nearly) constant side."""
    both = F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda z: F.abs(z["a"]) < float("inf"))
    both = F.filter(both, lambda z: F.abs(z["b"]) < float("inf"))

    def of(both: Column) -> Column:
        def mean(f) -> Column:
            return F.aggregate(both, F.lit(0.0), lambda s, z: s + f(z)) / F.size(both)

        def spread(ma: Column, mb: Column) -> Column:
            moments = mean(lambda z: (z["a"] - ma) * (z["a"] - ma)), mean(lambda z: (z["b"] - mb) * (z["b"] - mb)), mean(lambda z: (z["a"] - ma) * (z["b"] - mb))
            return bound(lambda va, vb, c: F.when((F.sqrt(va) >= 1e-8) & (F.sqrt(vb) >= 1e-8), c / F.sqrt(va * vb)), *moments)

        return F.when(F.size(both) >= 3, bound(spread, mean(lambda z: z["a"]), mean(lambda z: z["b"])))

    return bound(of, both)  # each value once: a mean named within a lambda would be computed for every element


def speed_direction(ratio: Column, tag: Column, rules: dict[str, tuple[str, float]]) -> Column:
    """1 if the duration ratio meets the tag's rule, 0 if not, null without a rule or ratio."""
    out = F.lit(None).cast("int")
    for name, (side, bound) in rules.items():
        met = ratio <= bound if side == "max" else ratio >= bound
        out = F.when((tag == name) & ratio.isNotNull(), met.cast("int")).otherwise(out)
    return out


def neutral_probability(p: Column, label: Column) -> Column:
    """The probability, else 1 or 0 by the label, else null."""
    return F.coalesce(p, F.when(label.isNotNull(), (F.lower(F.trim(label)) == "neutral").cast("double")))
