"""Functions over arrays that keep order: runs, repeats, windows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import bound


def max_run(tokens: Column) -> Column:
    """Length of the longest run of equal tokens; 0 without tokens."""
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s, x):
        run = F.when(x.eqNullSafe(s["last"]) & (s["run"] > 0), s["run"] + 1).otherwise(1)
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(tokens, start, step, lambda s: s["best"])


def _repeat_of(tokens: Column, n: int) -> Column:
    """Most repeats in a row of an n-gram. Tokens equal to the one n before form runs; r of them mean r div n + 1 repeats."""
    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))
    same = F.transform(tokens, lambda x, i: (i >= n) & (x == F.get(tokens, i - n)))

    def step(s, x):
        run = F.when(x, s["run"] + 1).otherwise(0)
        return F.struct(run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(F.transform(same, lambda x: F.coalesce(x, F.lit(False))), start, step, lambda s: (s["best"] / n).cast("int") + 1)


def max_ngram_repeat(tokens: Column, most: int = 4) -> Column:
    """Most repeats in a row of an n-gram for n = 2 to min(most, max(2, size div 2)); 1 with under 4 tokens. tokens is computed once, not for every token."""

    def of(tokens: Column) -> Column:
        size = F.size(tokens)
        parts = [F.when(F.least(F.lit(most), F.greatest(F.lit(2), F.floor(size / 2))) >= n, _repeat_of(tokens, n)).otherwise(1) for n in range(2, most + 1)]
        return F.when(size < 4, 1).otherwise(F.greatest(*parts))

    return bound(of, tokens)


def frames(samples: Column, size: int, hop: int) -> Column:
    """Root mean squares of frames; the last is padded with zeros."""
    n = F.size(samples)
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(hop))
    return F.transform(starts, lambda i: F.sqrt(F.aggregate(F.slice(samples, i + 1, F.lit(size)), F.lit(0.0), lambda s, x: s + x * x) / size))
