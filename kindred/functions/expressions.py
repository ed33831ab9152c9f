"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Similarities are rounded before they are ranked or stored, so that plans which add up in a
# different order rank alike.
SIM_DIGITS = 9


def clean_text(text: Column, newline_as_space: bool = False) -> Column:
    """Lower case; letters and blanks only. Line breaks vanish unless ``newline_as_space``."""
    lowered = F.lower(text)
    if newline_as_space:
        lowered = F.regexp_replace(lowered, r"[\r\n\t]", " ")
    return F.regexp_replace(lowered, r"[^\p{L} ]", "")


def words(text: Column, newline_as_space: bool = False) -> Column:
    """Array of the non-empty words of a text."""
    return F.filter(F.split(clean_text(text, newline_as_space), " "), lambda w: w != "")


def linear_hash(value: Column, a: Column, b: Column, prime: int, buckets: Column | None = None) -> Column:
    """((a * value + b) mod prime) mod buckets; the last step is left out without buckets.

    With a, b and value below 2^31 the product stays within a long; a larger value is reduced by the prime before.
    """
    hashed = (a * value + b) % F.lit(prime).cast("long")
    return hashed if buckets is None else hashed % buckets


def jaccard(overlap: Column, size_a: Column, size_b: Column) -> Column:
    return overlap / (size_a + size_b - overlap)


def set_cosine(overlap: Column, size_a: Column, size_b: Column) -> Column:
    """overlap / (sqrt(size_a) * sqrt(size_b)), and 0 where a set is missing or empty."""
    both = (F.coalesce(size_a, F.lit(0)) > 0) & (F.coalesce(size_b, F.lit(0)) > 0)
    return F.when(both, overlap / (F.sqrt(size_a) * F.sqrt(size_b))).otherwise(F.lit(0.0))


def pearson(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    """Pearson correlation from the moments of the common entries; 0 unless it is positive.

    The moment form is exact for whole and half stars, so a numerator of 0 is exactly 0. The
    guard stands before the division, which raises under ANSI mode.
    """
    top = n * sxy - sx * sy
    vx = n * sxx - sx * sx
    vy = n * syy - sy * sy
    positive = (top > 0) & (vx > 0) & (vy > 0)
    sim = F.try_divide(top, F.sqrt(F.greatest(vx, F.lit(0.0))) * F.sqrt(F.greatest(vy, F.lit(0.0))))
    return F.when(positive, F.round(sim, SIM_DIGITS)).otherwise(F.lit(0.0))
