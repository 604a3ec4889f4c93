"""Exact top-k inner products over norm-sorted, rotated vectors.

Vectors are integers, floor(scale * x). Their second moments give a rotation (the
right singular vectors) that moves most of every product into the first
coordinates. Candidates are dealt into bands of descending length, and bands into
blocks of bounded size. Queries meet the longest band first, which gives each a
k-th best score; the other bands are then met only by the queries for which
|q| * |longest of the band| can still reach it. In a block, candidates are read
by descending length in tiles: a tile starts with the partial products over the
first rotated coordinates, and by Cauchy-Schwarz the rest is at most the product
of the residual lengths. Only what that bound leaves is scored, in whole integers.

Defined results: vectors that are null, empty or hold a null or a component that
isn't finite take no part, nor do null ids; vectors of another length than the
query's aren't its candidates. Ties go to the smaller id. A query has fewer than
k rows if it has fewer candidates, and none without any. Rows that share an id each count, as
queries and as candidates, but not as candidates of one another. Products of lengths beyond 64
bits raise an error. Further columns, whatever their names, take no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import settled, stored

#: Products below this are exact in doubles.
EXACT = 2.0**53
TILE = 1024


def quantised(vectors: DataFrame, scale: float, id_column: str, vector_column: str) -> DataFrame:
    """row (a number of its own, once it is stored), id, v (array of long), norm: the vectors that take part."""
    x = vectors[vector_column]
    kept = vectors.where(vectors[id_column].isNotNull() & (F.size(x) > 0)).select(vectors[id_column].cast("long").alias("id"), F.transform(x, lambda e: e.cast("double")).alias("x"))
    finite = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    whole = kept.where(finite).select("id", F.transform("x", lambda e: F.floor(e * F.lit(float(scale)))).alias("v"))
    return whole.select(F.monotonically_increasing_id().alias("row"), "id", "v", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))).alias("norm"))


def rotations(vectors: DataFrame, lengths: list[int]) -> dict[int, np.ndarray]:
    """By length of the vectors, of those asked for: the eigenvectors of their summed outer products, by descending eigenvalue. The driver gets length * length numbers each."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            column = batch.column(0)
            sizes = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            for d in np.unique(sizes).tolist():
                rows = flat[(ends[:-1][sizes == d][:, None] + np.arange(d)).ravel()].reshape(-1, d)
                sums[d] = sums.get(d, 0) + rows.T @ rows
        for d, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d * d, d, np.int32)), pa.array(np.arange(d * d, dtype=np.int64)), pa.array(s.ravel())], names=["d", "cell", "s"])

    some = vectors.where(F.size("v").isin(lengths)).select("v")
    got = some.mapInArrow(partial, "d int, cell long, s double").groupBy("d", "cell").agg(F.sum("s").alias("s")).toArrow()
    of, cell, value = (got[c].to_numpy() for c in ("d", "cell", "s"))
    out = {}
    for d in np.unique(of).tolist():
        moments = np.empty(d * d)
        moments[cell[of == d]] = value[of == d]
        out[d] = np.linalg.eigh(moments.reshape(d, d))[1][:, ::-1]
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def search_block(q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, c_ids: np.ndarray, c: np.ndarray, rotation: np.ndarray, k: int, head: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (id, integers, a score that is already reached by k others or -inf): its k best of the block's candidates, as (scores, ids)."""
    cn, qn = np.sqrt((c.astype(float) ** 2).sum(1)), np.sqrt((q.astype(float) ** 2).sum(1))
    order = np.lexsort((c_ids, -cn))
    c_ids, c, cn = c_ids[order], c[order], cn[order]
    cr, qr = c @ rotation, q @ rotation
    c_rest = np.sqrt(np.maximum(0, (cr[:, head:] ** 2).sum(1)))
    q_rest = np.sqrt(np.maximum(0, (qr[:, head:] ** 2).sum(1)))
    most = float(qn.max(initial=0) * cn.max(initial=0))
    if most >= 2.0**63:
        raise ValueError("products of these vectors can be beyond 64 bits; take a smaller scale")
    small = most < EXACT / 4
    best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in q_ids]
    limit = floor.copy()
    for at in range(0, len(c_ids), TILE):
        end = min(at + TILE, len(c_ids))
        live = np.flatnonzero(qn * cn[at] * (1 + 1e-9) + 1e-6 >= limit)
        if not len(live):
            break
        partial = qr[live, :head] @ cr[at:end, :head].T
        slack = 1e-9 * qn[live, None] * cn[None, at:end] + 1e-6
        keep = partial + q_rest[live, None] * c_rest[None, at:end] + slack >= limit[live, None]
        keep &= c_ids[None, at:end] != q_ids[live, None]
        for row, i in enumerate(live.tolist()):
            left = np.flatnonzero(keep[row])
            if not len(left):
                continue
            part = c[at + left]
            scores = (part.astype(float) @ q[i].astype(float)).astype(np.int64) if small else (part * q[i]).sum(1)
            best[i] = _best(np.concatenate((best[i][0], scores)), np.concatenate((best[i][1], c_ids[at + left])), k)
            if len(best[i][0]) == k:
                limit[i] = max(limit[i], float(best[i][0][-1]) if abs(best[i][0][-1]) < EXACT else np.nextafter(float(best[i][0][-1]), -np.inf))
    return best


def _block_search(rotation: dict[int, np.ndarray], k: int, head_share: float):
    def run(queries, candidates):
        import pandas as pd

        rows = []
        if len(queries) and len(candidates):
            lengths, of = queries.v.map(len), candidates.c_v.map(len)
            for d in sorted(set(lengths) & set(of)):
                qs, cs = queries[lengths == d], candidates[of == d]
                found = search_block(qs.id.to_numpy(), np.stack(qs.v.to_numpy()).astype(np.int64), qs.floor.to_numpy(float, na_value=-np.inf), cs.c_id.to_numpy(), np.stack(cs.c_v.to_numpy()).astype(np.int64), rotation[d], k, max(1, round(d * head_share)))
                for row, query, (scores, ids) in zip(qs.row.to_numpy(), qs.id.to_numpy(), found):
                    rows.append(pd.DataFrame({"row": row, "query_id": query, "vec_id": ids, "score": scores}))
        return pd.concat(rows) if rows else pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0, bands: int = 16, block: int = 8192, query_block: int = 4096, head_share: float = 0.25, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score. is_query: a condition on the column `id`.

    bands bounds what the driver learns of the lengths; block and query_block bound the vectors that a task holds. The driver also
    gets, for each band, the parts of the queries that still reach it: bands * queries / query_block numbers.
    """
    rows = stored(quantised(vectors, scale, id_column, vector_column))
    edges = sorted(set(rows.approxQuantile("norm", [i / bands for i in range(1, bands)], 0.01)), reverse=True)
    band = F.coalesce(*[F.when(F.col("norm") >= e, i) for i, e in enumerate(edges)], F.lit(len(edges)))
    dealt = rows.withColumn("band", band)
    sizes = {r.band: (r.n, r.longest) for r in dealt.groupBy("band").agg(F.count("*").alias("n"), F.max("norm").alias("longest")).collect()}
    by_length = {r.d: r.n for r in rows.where(is_query).groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}
    if not by_length:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    subs = {b: -(-n // block) for b, (n, _) in sizes.items()}
    parts = -(-sum(by_length.values()) // query_block)
    search = _block_search(rotations(rows, list(by_length)), k, head_share)

    def of_band(column: str, values: dict[int, object], kind: str) -> Column:
        return F.coalesce(*[F.when(F.col(column) == b, F.lit(v).cast(kind)) for b, v in values.items()], F.lit(None).cast(kind))

    def meet(queries: DataFrame, which: list[int]) -> DataFrame:
        """The k best of each query (row, id, v, norm, floor) in each block of these bands that can still hold one. Candidates go only to the parts of the queries that reach their band."""
        reach = [F.when(F.col("floor").isNull() | (F.col("norm") * F.lit(sizes[b][1] * (1 + 1e-9)) + 1e-6 >= F.col("floor")), F.lit(b)) for b in which]
        q = settled(queries.select("row", "id", "v", "floor", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part"), F.explode(F.filter(F.array(*reach), lambda b: b.isNotNull())).alias("band")))
        live = {r.band: sorted(r.parts) for r in q.groupBy("band").agg(F.collect_set("part").alias("parts")).collect()}
        if not live:
            return q.sparkSession.createDataFrame([], "row long, query_id long, vec_id long, score long")
        q = q.select("row", "id", "v", "floor", "part", "band", F.explode(F.sequence(F.lit(0), of_band("band", subs, "int") - 1)).alias("sub"))
        c = dealt.where(F.col("band").isin(list(live))).select(F.col("id").alias("c_id"), F.col("v").alias("c_v"), F.col("band").alias("c_band"), F.pmod(F.xxhash64("row"), of_band("band", subs, "int")).cast("int").alias("c_sub"))
        c = c.withColumn("c_part", F.explode(of_band("c_band", live, "array<int>")))
        return q.groupBy("band", "sub", "part").cogroup(c.groupBy("c_band", "c_sub", "c_part")).applyInPandas(search, "row long, query_id long, vec_id long, score long")

    ranked = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)

    queries = rows.where(is_query)
    first, rest = min(sizes), sorted(set(sizes) - {min(sizes)})
    found = settled(best(meet(queries.withColumn("floor", F.lit(None).cast("double")), [first])).drop("rank"))
    if rest:
        floors = found.groupBy(F.col("row").alias("of")).agg(F.count("*").alias("n"), F.min("score").cast("double").alias("low")).where(F.col("n") >= k)
        again = queries.join(floors, F.col("row") == F.col("of"), "left").select("row", "id", "v", "norm", F.col("low").alias("floor"))
        found = found.unionByName(meet(again, rest))
    return best(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
