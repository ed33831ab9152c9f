"""Similar businesses: pairs whose reviewer sets overlap enough."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from kindred.operators.minhash import similar_pairs_lsh
from kindred.operators.pairs import similar_pairs
from kindred.operators.ratings import entity_members


def similar_businesses(
    reviews: DataFrame,
    threshold: float = 0.05,
    method: str = "exact",
    family: Sequence[tuple[int, int]] | None = None,
    rows_per_band: int = 1,
) -> DataFrame:
    """(b1 < b2, sim). "lsh" keeps the pairs a MinHash run would find, "exact" keeps all."""
    members = entity_members(reviews, "business_id", "user_id")
    if method == "exact":
        return similar_pairs(members, threshold=threshold, raw=reviews)
    if method == "lsh":
        return similar_pairs_lsh(members, threshold=threshold, family=family, rows_per_band=rows_per_band, raw=reviews)
    raise ValueError(f"method must be 'lsh' or 'exact', not {method!r}")
