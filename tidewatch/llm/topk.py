"""Exact top-k search by inner product: tiles of queries and shards, and a tree of merged lists."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1024  # queries of a tile, on average
SHARD_ROWS = 8192  # candidates of a tile, on average
SCORE_ROWS = 256  # queries whose scores a tile holds at once
FAN_IN = 32  # lists merged at once

LISTS = "query_id long, node long, top array<struct<below: long, vec_id: long>>"


def tile_lists(query_ids, queries, vec_ids, vectors, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query_id, scores, vec_ids): the k best of every query, best first, ties to smaller ids.

    ``vec_ids`` ascend. Scores are exact: in doubles while no sum can pass 2**53, else in 64-bit
    integers (which wrap beyond 64 bits).
    """
    if not len(query_ids) or not len(vec_ids):
        return
    bound = np.abs(queries).max(initial=0).astype(float) * np.abs(vectors).max(initial=0) * queries.shape[1]
    kind = np.float64 if bound < 2**53 else np.int64
    shard = vectors.astype(kind).T
    own = np.searchsorted(vec_ids, query_ids, "right") - np.searchsorted(vec_ids, query_ids, "left")
    for start in range(0, len(query_ids), SCORE_ROWS):
        ids = query_ids[start : start + SCORE_ROWS]
        scores = queries[start : start + SCORE_ROWS].astype(kind) @ shard
        most = min(len(vec_ids), k + int(own[start : start + SCORE_ROWS].max()))
        least = np.partition(scores, len(vec_ids) - most, axis=1)[:, len(vec_ids) - most]
        rows, columns = np.nonzero(scores >= least[:, None])
        other = vec_ids[columns] != ids[rows]
        rows, columns = rows[other], columns[other]
        found = scores[rows, columns].astype(np.int64)
        order = np.lexsort((columns, ~found, rows))
        rows, columns, found = rows[order], columns[order], found[order]
        ends = np.searchsorted(rows, np.arange(len(ids)), "right")
        begins = np.searchsorted(rows, np.arange(len(ids)), "left")
        for i, (begin, end) in enumerate(zip(begins.tolist(), ends.tolist())):
            if end > begin:
                part = slice(begin, min(end, begin + k))
                yield int(ids[i]), found[part], vec_ids[columns[part]]


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id and score of every query's ``k`` highest scores, ties to smaller ids.

    Components become ``floor(scale * x)``; the score is their integer inner product. Every row but
    the query's own (the same ``vec_id``) is a candidate. A row takes no part if its id is null or
    its vector is null or holds a null or non-finite component. Rows that repeat id and vector count
    once; of different vectors under one query id the smallest is the query. Vectors of another
    length have no score. Other columns are ignored; an empty table gives no row.

    Queries are dealt into blocks and rows into shards by a hash, and every (shard, block) is one
    task's tile: memory is bounded by a tile and what moves is rows x blocks + queries x shards.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    raw = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite
    )
    n_rows, n_queries = raw.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    n_blocks, n_shards = max(1, ceil(n_queries / BLOCK_ROWS)), max(1, ceil(n_rows / SHARD_ROWS))

    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    rows = raw.select("vec_id", whole.alias("vector")).distinct()
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    place = F.xxhash64("vec_id", "vector")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    candidates = rows.select(
        "vec_id", "vector", F.pmod(place, F.lit(n_shards)).alias("shard"), every(n_blocks).alias("block"),
        F.lit(False).alias("asks"),
    )
    queries = asked.select(
        "vec_id", "vector", every(n_shards).alias("shard"), F.pmod(place, F.lit(n_blocks)).alias("block"),
        F.lit(True).alias("asks"),
    )

    def tile(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        asks = group["asks"].to_numpy()
        ids = group["vec_id"].to_numpy()
        column = group["vector"].chunk(0)
        bounds = column.offsets.to_numpy()
        values, lengths = column.values.to_numpy(), np.diff(bounds)
        out: list[tuple] = []
        for length in np.unique(lengths[asks]):
            alike = np.flatnonzero(lengths == length)
            alike = alike[np.argsort(ids[alike], kind="stable")]
            matrix = values[(bounds[alike][:, None] + np.arange(length)).ravel()].reshape(len(alike), length)
            of = asks[alike]
            out += tile_lists(ids[alike][of], matrix[of], ids[alike][~of], matrix[~of], k)
        top = pa.ListArray.from_arrays(
            np.cumsum([0, *(len(found) for _, found, _ in out)]).astype(np.int32),
            pa.StructArray.from_arrays(
                [np.concatenate([~s for _, s, _ in out] or [np.zeros(0, np.int64)]),
                 np.concatenate([v for _, _, v in out] or [np.zeros(0, np.int64)])], ["below", "vec_id"],
            ),
        )
        node = group["shard"][0].as_py()
        asked_ids = pa.array([q for q, _, _ in out], pa.int64())
        return pa.table({"query_id": asked_ids, "node": pa.array([node] * len(out), pa.int64()), "top": top})

    lists = candidates.unionByName(queries).groupBy("shard", "block").applyInArrow(tile, LISTS)
    nodes = n_shards
    while nodes > 1:
        merged = F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k)
        lists = lists.groupBy("query_id", F.expr(f"node div {FAN_IN}").alias("node")).agg(merged.alias("top"))
        nodes = ceil(nodes / FAN_IN)
    return lists.select("query_id", F.posexplode("top")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), "col.vec_id", F.bitwise_not("col.below").alias("score")
    )
