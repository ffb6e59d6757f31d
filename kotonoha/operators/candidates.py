"""Pairs of similar vectors above a threshold, written out for every pair of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kotonoha.operators.nearest import PIVOTS, similar_classes


def similar_pairs(
    vectors: DataFrame,
    threshold: float,
    *,
    centres: int = PIVOTS,
    id_col: str = "id",
    vector_col: str = "vector",
) -> DataFrame:
    """``[a, b, score]`` with a < b of all pairs with a cosine of at least ``threshold``.

    ``similar_classes`` finds them between different vectors; here every pair of
    ids is a row, so n copies of a vector give n (n - 1) / 2 rows. Take the
    classes where there may be many.
    """
    found = similar_classes(vectors, threshold, pivots=centres, id_col=id_col, vector_col=vector_col)
    inside = found.members.select("class").distinct().select(
        F.col("class").alias("a"), F.col("class").alias("b"), F.lit(1.0).alias("score")
    )
    pairs = found.pairs.unionByName(inside) if threshold <= 1.0 else found.pairs
    left = found.members.select(F.col("class").alias("a"), F.col("id").alias("_x"))
    right = found.members.select(F.col("class").alias("b"), F.col("id").alias("_y"))
    joined = pairs.join(left, "a").join(right, "b").where((F.col("a") != F.col("b")) | (F.col("_x") < F.col("_y")))
    return joined.select(
        F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), "score"
    )
