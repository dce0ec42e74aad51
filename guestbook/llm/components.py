"""Connected components of links, found with joins and aggregates alone."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.shared import drop_tables, settled

ROUNDS = 60


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label``, the smallest position that each position reaches, after links between positions ``a`` and ``b``:
    components take their smallest partner's label, round by round over the links whose ends still differ."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        low, high = np.minimum(x[apart], y[apart]), np.maximum(x[apart], y[apart])
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``; the root is the component's smallest node.

    Large-star and small-star rounds by turns: every node hooks its larger neighbours, then its smaller ones,
    to its smallest neighbour, until the links form stars. A round is two aggregates and two joins on the
    links that are left, written to the shared folder; a node with very many links is split by adaptive
    execution. The number of rounds grows with the logarithm of a component's size.
    """
    links = settled(edges.filter("u <> v").selectExpr("greatest(u, v) as u", "least(u, v) as v").distinct(), "links")
    for _ in range(ROUNDS):
        both = links.unionByName(links.selectExpr("v as u", "u as v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m")
        large = both.join(least, "u").filter("v > u").selectExpr("v as u", "m as v")
        large = settled(large.filter("u <> v").distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").selectExpr("explode(array(struct(v as u, m as v), struct(u as u, m as v))) as e")
        small = settled(small.select("e.*").filter("u <> v").distinct(), "links")
        same = _changed(links, small)
        drop_tables(links, large)
        links = small
        if same:
            break
    else:
        raise RuntimeError("links did not settle")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _changed(before: DataFrame, after: DataFrame) -> bool:
    """Whether a round left the links as they were, by a count and an order-free sum of hashes."""
    of = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    return before.agg(of).first()[0] == after.agg(of).first()[0]
