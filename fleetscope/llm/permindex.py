"""Approximate nearest neighbours by a permutation index.

A bounded sample of vectors serves as pivots. A vector is represented by its nearest pivots, in order of nearness; each index
block holds, for every pivot, the posting list of the block's vectors that have it among theirs, with its place in their order.
A query walks the lists of its own pivots and sums, per vector, what the footrule distance of the two orders saves against
disjoint ones; the vectors with the smallest footrule distance are reranked by their exact inner product in double precision.

Every vector is in exactly one index block and every query visits every block. Blocks of queries and blocks of the index meet by
a join on the pair of block numbers, so that neither side passes through the driver or one task; per pair at most ``k`` rows a
query go on to the final ranking.

``share`` of a block's vectors (``least`` at least), and every further one with the same footrule distance as the last of
these, are reranked: copies of a vector are never torn apart. Recall against brute force is in the tests and the README.

Defined cases: a vector that is null, all zero, of another length than the pivots, or holds null or non-finite components takes
no part, as query or candidate; neither does a row without vec_id; rows that share a vec_id are separate candidates and one
query for each row; a query with fewer candidates returns them all; an empty table gives no rows; only vec_id and embedding are
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import durable, rows_of, table

INDEX_COLUMNS = "ib long, ids binary, vectors binary, lists binary, members binary, places binary"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return rows.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(finite & F.exists("embedding", lambda v: v != 0))


def pivots_of(vectors: DataFrame, n: int, sample: int = 2048) -> np.ndarray:
    """Up to n distinct vectors, the first by a hash of vec_id and the vector among a sample of ``sample`` distinct ones."""
    few = (vectors.withColumn("h", F.xxhash64("embedding")).groupBy("h").agg(F.min_by("embedding", "vec_id").alias("embedding"))
           .orderBy("h").limit(sample).collect())
    if not few:
        return np.zeros((0, 0))
    lens = [len(r["embedding"]) for r in few]
    usual = max(set(lens), key=lambda d: (lens.count(d), d))
    return np.array([r["embedding"] for r in few if len(r["embedding"]) == usual][:n])


def _orders(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The numbers of each vector's nearest pivots, nearest first."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :length].astype(np.int64)


def build_index(vectors: DataFrame, pivots: np.ndarray, length: int = 64, block: int = 4096) -> DataFrame:
    """One row per block of about ``block`` vectors: their ids and values, and the pivots' posting lists. ``vectors`` as by ``usable``."""
    dim, blocks = pivots.shape[1], max(1, -(-vectors.count() // block))

    def build(t: pa.Table) -> pa.Table:
        x = np.array(t.column("embedding").to_pylist(), dtype="<f8").reshape(t.num_rows, dim)
        order = _orders(x, pivots, length)
        by = np.argsort(order.ravel(), kind="stable")
        return pa.table({
            "ib": [t.column("ib")[0].as_py()], "ids": [np.array(t.column("vec_id").to_pylist(), "<i8").tobytes()],
            "vectors": [x.tobytes()], "lists": [np.searchsorted(order.ravel()[by], np.arange(len(pivots) + 1)).astype("<u4").tobytes()],
            "members": [(by // order.shape[1]).astype("<u4").tobytes()], "places": [(by % order.shape[1]).astype("<u2").tobytes()],
        }, schema=pa.schema([("ib", pa.int64()), *((n, pa.binary()) for n in ("ids", "vectors", "lists", "members", "places"))]))

    whole = vectors.filter(F.size("embedding") == dim)
    return whole.withColumn("ib", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).groupBy("ib").applyInArrow(build, INDEX_COLUMNS)


def _search_block(row: dict, pivots: np.ndarray, length: int, k: int, share: float, least: int) -> Iterator[tuple]:
    """(query_id, query row, vec_id, score) of the k nearest reranked vectors of one pair of blocks."""
    ids, qids = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["qids"], "<i8")
    x, q = (np.frombuffer(row[c], "<f8").reshape(-1, pivots.shape[1]) for c in ("vectors", "queries"))
    lists, members = np.frombuffer(row["lists"], "<u4"), np.frombuffer(row["members"], "<u4")
    # What a place in a vector's order can save at most; 0 for vectors outside a pivot's list.
    worth = np.zeros((len(pivots), ids.size), np.int16)
    for p in range(len(pivots)):
        a, b = lists[p], lists[p + 1]
        worth[p, members[a:b]] = length - np.frombuffer(row["places"], "<u2")[a:b].astype(np.int16)
    want = max(least, int(np.ceil(share * ids.size)))
    for n, order in enumerate(_orders(q, pivots, length)):
        # of two places of a pivot the worse one counts: (length - larger place) is what sharing the pivot saves
        saved = np.minimum(worth[order], np.arange(length, 0, -1, dtype=np.int16)[:order.size, None]).sum(axis=0, dtype=np.int32)
        if want < ids.size:
            near = np.flatnonzero(saved >= np.partition(saved, ids.size - want)[ids.size - want])
        else:
            near = np.arange(ids.size)
        near = near[ids[near] != qids[n]]
        score = (x[near] * q[n]).sum(axis=1)  # one order of summation for every row, so that copies tie
        best = np.lexsort((ids[near], -score))[:k]
        for j in best.tolist():
            yield int(qids[n]), row["qb"], n, int(ids[near[j]]), float(score[j])


def search(index: DataFrame, queries: DataFrame, pivots: np.ndarray, k: int, length: int = 64, block: int = 2048,
           share: float = 0.2, least: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query (rows as by ``usable``), never the query's own id."""
    dim, small = pivots.shape[1], max(1, -(-queries.count() // block))
    blocks = index.agg(F.max("ib")).first()[0]
    blocks = 1 if blocks is None else blocks + 1

    def bundle(t: pa.Table) -> pa.Table:
        x = np.array(t.column("embedding").to_pylist(), dtype="<f8").reshape(t.num_rows, dim)
        return pa.table({"qb": [t.column("qb")[0].as_py()], "qids": [np.array(t.column("vec_id").to_pylist(), "<i8").tobytes()], "queries": [x.tobytes()]},
                        schema=pa.schema([("qb", pa.int64()), ("qids", pa.binary()), ("queries", pa.binary())]))

    def each(name: str, n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)

    whole = queries.filter(F.size("embedding") == dim).withColumn("qb", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(small)))
    bundles = durable(whole.groupBy("qb").applyInArrow(bundle, "qb long, qids binary, queries binary"))
    schema = pa.schema([("query_id", pa.int64()), ("qb", pa.int64()), ("n", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            for row in rows_of(b):
                found = list(_search_block(row, pivots, length, k, share, least))
                if found:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found, strict=True), schema.types, strict=True)], schema=schema)

    # Both sides carry the pair of block numbers, so the join is an equality on an evenly spread key.
    parts = min(100_000, blocks * small)
    left = index.select("*", each("qb", small)).repartition(parts, "ib", "qb")
    right = bundles.select("*", each("ib", blocks)).repartition(parts, "ib", "qb")
    pairs = left.join(right.hint("shuffle_hash"), ["ib", "qb"])
    found = pairs.mapInArrow(run, "query_id long, qb long, n int, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "qb", "n").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: DataFrame, k: int, pivots: int = 256, length: int = 64, share: float = 0.2,
            least: int = 512) -> DataFrame:
    """Build the index of ``vectors`` and search it with ``queries`` (vec_id, embedding)."""
    all_rows = usable(vectors)
    chosen = pivots_of(all_rows, pivots)
    if not len(chosen):
        return all_rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    length = min(length, len(chosen))
    return search(durable(build_index(all_rows, chosen, length)), usable(queries), chosen, k, length, share=share, least=least)


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)
