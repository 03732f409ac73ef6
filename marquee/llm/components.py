"""Connected components of an edge table, by alternating stars.

Large star: every node links its larger neighbours to the smallest of its
neighbours and itself. Small star: every node links its smaller neighbours
and itself to the smallest of them. Repeated until only stars are left, every
node points at the smallest node of its component. Both are one grouped
minimum (combined before the shuffle) and one join that may be split; no
component is gathered anywhere, and rounds grow with the logarithm of the
longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import materialize


def _star(edges: DataFrame, large: bool, pack) -> DataFrame:
    low = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    met = edges.join(low, "u")
    out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else \
        pack(met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))))
    return out.where("u != v").distinct()


def _only_stars(edges: DataFrame, pack) -> bool:
    """Whether every node has one link up at most, and none of those that
    others point at has one. One count per node, combined before the shuffle."""
    ends = pack(edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
        "up + down > 1 AND up > 0").isEmpty()


# up to this many links (a few MB) one task does a round faster than a shuffle
FEW_LINKS = 200_000


def connected(links: DataFrame) -> DataFrame:
    """(u, v) links -> (node, component): every linked node, with the
    smallest node it can reach. Tables of at most ``FEW_LINKS`` links are
    held in one partition, where Spark needs no shuffle; larger ones are
    spread, and may be split on skew."""
    def oriented(e):
        return e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()

    edges = materialize(oriented(links), "edges")
    few = edges.count() <= FEW_LINKS
    pack = (lambda e: e.coalesce(1)) if few else (lambda e: e)
    edges = materialize(pack(edges), "edges") if few else edges
    while not _only_stars(edges, pack):
        both = pack(pack(edges).union(pack(edges).select("v", "u")))
        mid = _star(both, large=True, pack=pack)
        edges = materialize(_star(oriented(mid), large=False, pack=pack), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
