"""Scalar expressions used across operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_state(c: Column | str) -> Column:
    """Trimmed state name; NULL stays NULL -- F1."""
    return F.trim(F.col(c) if isinstance(c, str) else c)


def month_of(c: Column | str, parse: bool = False) -> Column:
    """Month 1..12 of a date; with ``parse`` a date-like string is parsed first and an
    unparseable one gives NULL (its month share is then 0) -- F3."""
    col = F.col(c) if isinstance(c, str) else c
    return F.month(F.try_to_date(col.cast("string"))) if parse else F.month(col)


def safe_div(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den, ``default`` when den is 0 or NULL -- F4."""
    return F.coalesce(F.try_divide(num, F.nullif(den, F.lit(0))), F.lit(default))


def set_sum(arr: Column) -> Column:
    """Sum of a numeric array (0 for empty) -- F7."""
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))


def set_mean(arr: Column) -> Column:
    """Mean of a numeric array (0 for empty) -- F7."""
    return F.when(F.size(arr) > 0, set_sum(arr) / F.size(arr)).otherwise(F.lit(0.0))


def set_std_pop(arr: Column) -> Column:
    """Population standard deviation of an array, 0 when it has <= 1 element -- F7."""
    n = F.size(arr)
    mean = set_mean(arr)
    sq = F.aggregate(arr, F.lit(0.0).cast("double"),
                     lambda acc, x: acc + (x.cast("double") - mean) * (x.cast("double") - mean))
    return F.when(n > 1, F.sqrt(sq / n)).otherwise(F.lit(0.0))


def cosine(common: Column, n_a: Column, n_b: Column) -> Column:
    """Cosine similarity of two binary vectors from set sizes and overlap -- F9."""
    return common / F.sqrt(n_a.cast("double") * n_b.cast("double"))


def jaccard(common: Column, n_a: Column, n_b: Column) -> Column:
    """Jaccard similarity of two sets from their sizes and overlap -- F9."""
    return common / (n_a + n_b - common).cast("double")


def predicted_k(pred_count: Column, n_species: Column | int) -> Column:
    """Per-row K = clamp(round-half-even(count), 1, S) -- W7."""
    s = n_species if isinstance(n_species, Column) else F.lit(n_species)
    return F.least(F.greatest(F.bround(pred_count, 0), F.lit(1.0)), s.cast("double")).cast("int")


def activity_band(n: Column) -> Column:
    """Right-closed activity bands; 0 (or less) -> NULL (no band) -- A24.

    Fixed values: bins (0,5], (5,10], (10,20], (20,50], (50, inf) with labels
    '1-5', '6-10', '11-20', '21-50', '50+'.
    """
    return (F.when(n <= 0, F.lit(None).cast("string"))
             .when(n <= 5, "1-5").when(n <= 10, "6-10").when(n <= 20, "11-20")
             .when(n <= 50, "21-50").otherwise("50+"))
