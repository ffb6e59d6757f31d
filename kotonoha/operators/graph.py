"""Co-occurrence edges and node degrees from ranked n-grams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kotonoha.plans.layout import cut_lineage

# Drawn width of an edge is count / max * 4 + 1.
WIDTH_SCALE = 4
WIDTH_BASE = 1


def edges(ngrams: DataFrame, *, head: int = 50, strict: bool = True) -> DataFrame:
    """``[rank, source, target, count]`` of the first ``head`` n-grams.

    The n-gram is cut at its first space, so a trigram's target is its last two
    words. The ranking window sees at most ``head`` rows.
    """
    missing = {"ngram", "count"} - set(ngrams.columns)
    if missing:
        raise ValueError(f"edges: missing column(s) {sorted(missing)}")
    order = [F.desc("count"), F.asc("ngram")]
    top = ngrams.orderBy(*order).limit(head)
    parts = F.split("ngram", " ", 2)
    out = top.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        parts[0].alias("source"),
        F.get(parts, F.lit(1)).alias("target"),
        "count",
    )
    if strict:
        out = cut_lineage(out)  # at most ``head`` rows, counted once
        if out.where(F.col("target").isNotNull()).isEmpty():
            raise ValueError("edges: no n-gram has a second part")
    return out


def merge_edges(edge_list: DataFrame, *, merge: str = "last") -> DataFrame:
    """Undirected edges ``[source, target, count]``; self-loops stay.

    (a, b) and (b, a) are one edge. With "last" the lower-ranked row's count
    wins; "sum" adds both.
    """
    if merge not in {"last", "sum"}:
        raise ValueError("merge must be 'last' or 'sum'")
    count = F.sum("count") if merge == "sum" else F.max_by("count", "rank")
    return (
        edge_list.where(F.col("target").isNotNull())
        .groupBy(
            F.least("source", "target").alias("source"),
            F.greatest("source", "target").alias("target"),
        )
        .agg(count.alias("count"))
    )


def edge_widths(merged: DataFrame) -> DataFrame:
    """Add ``width``; the window runs over the head-bounded edge list."""
    largest = F.max("count").over(Window.partitionBy())
    return merged.withColumn("width", F.col("count") / largest * WIDTH_SCALE + WIDTH_BASE)


def node_degrees(merged: DataFrame) -> DataFrame:
    """``[word, degree]``; a self-loop counts twice."""
    ends = merged.select(F.explode(F.array("source", "target")).alias("word"))
    return ends.groupBy("word").agg(F.count(F.lit(1)).alias("degree"))


def cooccurrence_graph(
    ngrams: DataFrame, *, head: int = 50, merge: str = "last", strict: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Edges with widths, and nodes with degrees."""
    merged = merge_edges(edges(ngrams, head=head, strict=strict), merge=merge)
    return edge_widths(merged), node_degrees(merged)
