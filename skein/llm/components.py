"""Connected components: distributed union-find by alternating stars, and a local form.

The distributed form runs on DataFrames only. A round lets every node point
its larger neighbours (large star), then its smaller ones (small star), to the
least node it knows; trees flatten in a logarithmic number of rounds. A node
with very many neighbours needs no group in one task: minima are aggregated
before the shuffle and met by joins. Every round is written to the shared
folder, so that no round is computed again when executors are lost.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.workspace import Workspace


def connected_components(edges: DataFrame, work: Workspace, name: str = "cc") -> DataFrame:
    """(node, root): the least node reachable from each node of edges (a, b).

    Loops, repeated edges and edges with a null end add nothing; nodes with no
    other edge are not returned. No edges give no rows.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = work.table(edges.where("a <> b").select(high, low).distinct(), f"{name}0")
    state = _state(now)
    for i in range(1, 200):
        if not state[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = work.table(large, f"{name}{i}_large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        now = work.table(small, f"{name}{i}")
        before, state = state, _state(now)
        work.drop(f"{name}{i - 1}", f"{name}{i}_large")
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return ends.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Number and order-free digest of the edges, which are distinct: exclusive ors of two hashes, which no number of rows overflows."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64(F.lit(1), "a", "b"))).first()
    return tuple(row)


def local_components(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """The least place reachable from each of n places by links a - b, joined to labels found before."""
    labels = np.arange(n) if labels is None else labels
    while True:
        la, lb = labels[a], labels[b]
        open_ = la != lb
        if not open_.any():
            return labels
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        least = np.minimum(la, lb)
        np.minimum.at(labels, la, least)
        np.minimum.at(labels, lb, least)
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further
