"""Connected components: few links by one task's union of sets, more by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import swept
from .common import stored

#: Links that one task settles, which holds them (16 bytes each). A round of stars costs some ten stages of all shuffle partitions, however few the links.
ALONE = 1 << 18


def _least(edges: DataFrame) -> DataFrame:
    """Each node u and the least of its neighbours v and itself."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))


def _state(edges: DataFrame) -> tuple:
    with swept(edges.sparkSession):
        return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def united(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links u, v, and the smallest node that each reaches."""
    nodes, places = np.unique(np.concatenate((u, v)), return_inverse=True)
    label, a, b = np.arange(len(nodes)), places[: len(u)], places[len(u) :]
    while True:
        high, low = np.maximum(label[a], label[b]), np.minimum(label[a], label[b])
        apart = high != low
        if not apart.any():
            return nodes, nodes[label]
        a, b = a[apart], b[apart]
        np.minimum.at(label, high[apart], low[apart])
        while (label != (further := label[label])).any():
            label = further


def _united(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = list(batches)
    if not held:
        return
    u, v = (np.concatenate([x.column(i).to_numpy() for x in held]) for i in (0, 1))
    yield pa.RecordBatch.from_arrays([pa.array(x, held[0].schema.types[0]) for x in united(u, v)], names=["node", "component"])


def components(links: DataFrame, a: str = "a", b: str = "b", alone: int = ALONE) -> DataFrame:
    """node, component: for each node with a link to another, the smallest node that it reaches. links: pairs of integers.

    Up to `alone` links go to one task. With more, each round is two grouped minima and two equi-joins, whose hot nodes adaptive
    execution can split; the rounds are logarithmic in the number of links. Nulls
    and links of a node with itself are ignored. Each round is written to the
    checkpoint folder, and its shuffles go.
    """
    edges = stored(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    seen = _state(edges)
    if seen[0] <= alone:
        kind = edges.schema["u"].dataType.simpleString()
        return stored(edges.coalesce(1).mapInArrow(_united, f"node {kind}, component {kind}"))
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        joined = large.join(_least(large), F.col("u") == F.col("k"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = stored(small)
        now = _state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
