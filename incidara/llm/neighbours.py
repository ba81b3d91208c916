"""Nearest neighbours by a block matrix join of int8 tiles.

Queries and candidates are dealt into hash blocks. Every (query block, candidate
block) pair is a tile: its int8 product gives each inner product up to a proven
error, the pairs that can still be among the k best are recomputed in double
precision, and heaps merge the k best of all tiles.
"""

from __future__ import annotations

import heapq
from itertools import groupby, islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_rows, small_batches

#: Rows of a block; a tile holds two blocks, whatever the table's size.
BLOCK_ROWS = 4096
#: Queries whose products with a block are in memory together.
STRIP = 256


def usable(vector: Column) -> Column:
    """True for a vector without null or non-finite components that isn't zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` candidates of largest inner product for each query row.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller id.
    The result is exact: a pair is only left out when its upper bound is below
    the k-th lower bound of its query. Candidates are all rows but the query's
    own. Rows whose id is null, or whose vector is null, empty, zero, or holds
    a null or non-finite component, take no part; rows that share an id all
    count, as queries too, and a query row repeated has its result repeated;
    vectors of different length have no product. Fewer than k candidates are
    all returned; an empty table gives no rows. Other columns are ignored.

    Equal rows fold to one with their number; no query has room for more than
    k of them beside itself, so k + 1 copies at most become candidates.
    """
    small_batches(vectors.sparkSession)
    clean = (
        vectors.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(vector_col).cast("array<double>").alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
        )
        .filter(F.col("id").isNotNull() & usable(F.col("v")))
        .groupBy("id", "v")
        .agg(F.count("*").alias("n"), F.count_if("is_query").alias("asked"))
        # names a row's content where an id is shared: two hashes of 64 bits
        .withColumn("row", F.concat_ws(":", F.xxhash64(F.lit(1), "id", "v"), F.xxhash64(F.lit(2), "id", "v")))
    )
    copies = F.least("n", F.lit(k + 1)).cast("int")
    n, n_queries = clean.agg(F.coalesce(F.sum(copies), F.lit(0)), F.count_if(F.col("asked") > 0)).first()
    cuts = -(-n // block_rows) or 1
    query_cuts = -(-n_queries // block_rows) or 1

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        return df.select(
            "id",
            "row",
            "copy",
            "asked",
            "v",
            F.size("v").alias("dim"),
            F.pmod(F.xxhash64("row", "copy"), F.lit(blocks)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other),
        )

    tile = ["dim", "query_block", "block"]
    asked = clean.filter("asked > 0").withColumn("copy", F.lit(1))
    queries = dealt(asked, "query_block", query_cuts, "block", cuts)
    all_rows = clean.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    candidates = dealt(all_rows, "block", cuts, "query_block", query_cuts)

    def best_of_tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(left) and len(right):
            content, _ = pd.factorize(pd.concat([left["row"], right["row"]], ignore_index=True))
            # a query's own row is the first copy of its content
            own = np.where(right["copy"] == 1, content[len(left) :], -1)
            found = _tile(
                content[: len(left)], np.stack(left["v"]), own, right["id"].to_numpy(), np.stack(right["v"]), k
            )
            rows = [(left["id"][i], left["row"][i], left["asked"][i], ids, scores) for i, ids, scores in found]
        return pd.DataFrame(rows, columns=["query_id", "row", "asked", "ids", "scores"])

    lists = (
        queries.groupBy(*tile)
        .cogroup(candidates.groupBy(*tile))
        .applyInPandas(
            best_of_tile, "query_id long, row string, asked long, ids array<long>, scores array<double>"
        )
    )

    def merge(rows):
        for (query, _, asked), group in groupby(rows, key=lambda r: r[:3]):
            ranked = heapq.merge(*(zip((-s for s in r[4]), r[3]) for r in group))
            best = list(islice(ranked, k))
            for _ in range(asked):
                for rank, (score, found) in enumerate(best, 1):
                    yield query, rank, found, -score

    by_query = lists.repartition("query_id", "row").sortWithinPartitions("query_id", "row")
    return map_rows(by_query, "query_id long, rank int, vec_id long, score double", merge)


def _int8(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, and the norms of the rows as coded and of what coding lost."""
    scale = np.abs(m).max(axis=1) / 127
    # a subnormal row's scale may be zero; it then codes to zeros and loses all of itself
    safe = np.where(scale > 0, scale, 1)
    codes = np.clip(np.rint(m / safe[:, None]), -127, 127).astype(np.int8)
    coded = codes * safe[:, None]
    return codes, safe, np.linalg.norm(coded, axis=1), np.linalg.norm(m - coded, axis=1)


def _tile(query_rows, queries, own_of, ids, vectors, k: int) -> list[tuple]:
    """For each query that has any, its place and its k best of the tile, best first; a candidate whose
    ``own_of`` is the query's number is the query itself."""
    q_codes, q_scale, q_norm, q_lost = _int8(queries)
    codes, scale, _, lost = _int8(vectors)
    norm = np.linalg.norm(vectors, axis=1)
    # sums of products of codes are whole numbers, exact in float32 below 2**24
    wide = np.float32 if queries.shape[1] * 127 * 127 < 2**24 else np.float64
    columns = codes.astype(wide).T
    out = []
    for at in range(0, len(query_rows), STRIP):
        part = slice(at, at + STRIP)
        near = (q_codes[part].astype(wide) @ columns).astype(np.float64)
        near *= q_scale[part, None] * scale
        # |q.c - q'.c'| <= |q - q'| |c| + |q'| |c - c'|, and rounding
        error = q_lost[part, None] * norm + q_norm[part, None] * lost
        error += 1e-9 * (q_norm[part, None] + q_lost[part, None]) * norm
        own = query_rows[part, None] == own_of
        low = np.where(own, -np.inf, near - error)
        if low.shape[1] > k:
            floor = np.partition(low, low.shape[1] - k, axis=1)[:, -k]
        else:
            floor = np.full(len(low), -np.inf)
        row, col = np.nonzero((near + error >= floor[:, None]) & ~own)
        exact = np.zeros(len(row))
        for d in range(queries.shape[1]):
            exact += queries[at + row, d] * vectors[col, d]
        ends = np.searchsorted(row, np.arange(len(low) + 1))
        for i, (a, b) in enumerate(zip(ends, ends[1:])):
            best = heapq.nsmallest(k, zip((-exact[a:b]).tolist(), ids[col[a:b]].tolist()))
            if best:
                out.append((at + i, [c for _, c in best], [-s + 0.0 for s, _ in best]))
    return out
