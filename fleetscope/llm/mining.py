"""Hard negatives by angular triangle filtering.

Rows are integer vectors: each component times 256, rounded down. A few reference directions are drawn from a bounded sample, and
every row stores its angles to them. By the triangle inequality on the sphere, the angle between an anchor and a row lies between
the largest difference and the smallest sum of their angles to one reference; the cosines of these bounds times the two norms,
widened by ``SLACK`` and rounded outwards, enclose the integer score. Blocks of rows (of one label and nearest reference, by angle
to it) carry the range of their angles, so that a block outside all windows is passed over as a whole; in the others only rows whose
interval overlaps an anchor's window get an integer score.

The anchors are a stated query set. They are taken in batches of at most ``BATCH`` components, which bounds the broadcast and what
the driver holds; every batch goes over all rows in four scans: the scores of the nearest rows of the anchor's label, and then, in
windows below each of these positives, the highest scores of rows of other labels; each is first done over one block in ``SEED``, so
that the scan over all rows starts from thresholds and hands on some ``SEED`` times the rows wanted, not rows from every task.
A task keeps the best few of each window; the last cut is a ranking over these.

Scores are exact: a pair of blocks is multiplied in doubles where the product of its norms proves that all partial sums are below
2^53, in Python integers otherwise. Scores or components beyond a long are cut to it.

Defined cases: a row with a null label, a null vector, or a null or non-finite component takes no part; a zero or empty vector does,
with score 0; missing components of the shorter of two vectors count as 0; a null vec_id is no anchor, and as a candidate comes after
all others of its score; rows that share a vec_id are rows of their own, also as anchors, and equal ones rank in any order; an anchor
without positives or a window without negatives gives no rows; an empty table gives none; only vec_id, embedding and label are read,
whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import durable, shared_dir, table

#: Reference directions, and the rows of the sample that they are drawn from.
REFERENCES, SAMPLE = 16, 2048
#: Components of the anchors of one batch, at most (a broadcast of some 40 MB).
BATCH = 4_000_000
#: One block in this many is scanned first.
SEED = 8
#: Rows of a block, and anchors that meet a block at a time.
BLOCK, ANCHORS = 2048, 128
#: Radians by which an angle, and the share of the product of the norms by which a score, may be off: roundings are below 1e-7.
SLACK = 1e-6

ROW_SCHEMA = "rid long, vec_id long, label long, q array<long>, norm double, angles array<double>, home int"
LONG = np.iinfo(np.int64)


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, label, q (array of long) of the rows that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return rows.filter("label IS NOT NULL AND x IS NOT NULL").filter(finite).select(
        "vec_id", "label", F.transform("x", lambda v: F.floor(v * 256).cast("long")).alias("q"))


def references_of(rows: DataFrame, n: int = REFERENCES, sample: int = SAMPLE) -> np.ndarray:
    """Up to n unit vectors of the sample (the first by a hash), each the farthest by angle from those before it."""
    got = (rows.select("q", F.xxhash64("q").alias("h")).filter(F.exists("q", lambda v: v != 0)).groupBy("h").agg(F.min("q").alias("q"))
           .orderBy("h").limit(sample).collect())
    if not got:
        return np.zeros((0, 0))
    x = np.zeros((len(got), max(len(r["q"]) for r in got)))
    for k, r in enumerate(got):
        x[k, :len(r["q"])] = r["q"]
    x /= np.linalg.norm(x, axis=1)[:, None]
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(n, len(x)):
        k = int(np.argmin(nearest))
        chosen.append(k)
        nearest = np.maximum(nearest, x @ x[k])
    return x[chosen]


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a column of lists without nulls."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]], offsets - offsets[0]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The lists as rows of ``dim`` components, the rest 0."""
    flat, at = _lists(column)
    lens = np.diff(at)
    if (lens == dim).all():
        return flat.reshape(len(lens), dim)
    out = np.zeros((len(lens), dim), flat.dtype)
    out[np.repeat(np.arange(len(lens)), lens), np.arange(flat.size) - np.repeat(at[:-1], lens)] = flat
    return out


def _width(column: pa.Array) -> int:
    return int(np.diff(column.offsets.to_numpy()).max(initial=0))


def with_angles(rows: DataFrame, references: np.ndarray) -> DataFrame:
    """``rows`` with an id of their own, norms, angles to the references, and the number of the nearest one."""
    schema = pa.schema([("rid", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("q", pa.list_(pa.int64())), ("norm", pa.float64()),
                        ("angles", pa.list_(pa.float64())), ("home", pa.int32())])

    def measure(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for at in range(0, whole.num_rows, BLOCK):
                b = whole.slice(at, BLOCK)
                x = _matrix(b.column("q"), max(_width(b.column("q")), references.shape[1])).astype(float)
                norm = np.linalg.norm(x, axis=1)
                cos = x[:, :references.shape[1]] @ references.T / np.maximum(norm, 1e-300)[:, None]
                angles = np.arccos(np.clip(cos, -1, 1))
                ends = np.arange(0, angles.size + 1, max(1, len(references)), dtype=np.int32) if len(references) else np.zeros(len(x) + 1, np.int32)
                home = angles.argmin(axis=1) if len(references) else np.zeros(len(x))
                yield pa.record_batch([
                    b.column("rid"), b.column("vec_id"), b.column("label"), b.column("q"), pa.array(norm),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(angles.ravel())), pa.array(home.astype(np.int32))], schema=schema)

    return rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", "q").mapInArrow(measure, ROW_SCHEMA)


@dataclass
class Rows:
    """Rows of a block, or the anchors of a batch, as arrays."""

    rid: np.ndarray
    vec_id: np.ndarray
    no_id: np.ndarray
    label: np.ndarray
    q: np.ndarray
    norm: np.ndarray
    angles: np.ndarray

    @staticmethod
    def of(b: pa.RecordBatch | pa.Table) -> Rows:
        if isinstance(b, pa.Table):
            b = b.combine_chunks()
            b = b.to_batches()[0] if b.num_rows else pa.RecordBatch.from_pylist([], schema=b.schema)
        ids = b.column("vec_id")
        plain = {c: b.column(c).to_numpy(zero_copy_only=False) for c in ("rid", "label", "norm")}
        return Rows(plain["rid"], ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), plain["label"],
                    _matrix(b.column("q"), _width(b.column("q"))), plain["norm"], _matrix(b.column("angles"), _width(b.column("angles"))))

    def take(self, at) -> Rows:
        return Rows(*(getattr(self, f)[at] for f in self.__dataclass_fields__))


def scores(a: Rows, b: Rows) -> np.ndarray:
    """Exact inner products of all anchors with all rows of a tile."""
    dim = min(a.q.shape[1], b.q.shape[1])
    p, q = a.q[:, :dim], b.q[:, :dim]
    if a.norm.max(initial=0) * b.norm.max(initial=0) < 2.0**52:
        return (p.astype(float) @ q.astype(float).T).astype(np.int64)
    wide = p.astype(object) @ q.astype(object).T
    return np.clip(wide, LONG.min, LONG.max).astype(np.int64)


def bounds(a: Rows, b: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that no score of a tile is below or above, from angles and norms alone."""
    low = np.zeros((len(a.rid), len(b.rid)))
    high = np.full(low.shape, np.pi)
    for r in range(a.angles.shape[1]):
        s, t = a.angles[:, r][:, None], b.angles[:, r][None, :]
        np.maximum(low, np.abs(s - t), out=low)
        both = s + t
        np.minimum(high, np.minimum(both, 2 * np.pi - both), out=high)
    size = a.norm[:, None] * b.norm[None, :]
    spare = SLACK * size + 1
    return (np.floor(size * np.cos(np.minimum(high + SLACK, np.pi)) - spare), np.ceil(size * np.cos(np.maximum(low - SLACK, 0)) + spare))


def block_ceiling(a: Rows, b: Rows) -> np.ndarray:
    """A number for each anchor that no score with a row of the block is above."""
    low = np.zeros(len(a.rid))
    if a.angles.shape[1]:
        first, last = b.angles.min(axis=0), b.angles.max(axis=0)
        low = np.maximum(np.maximum(first[None, :] - a.angles, a.angles - last[None, :]), 0).max(axis=1)
    cos = np.cos(np.maximum(low - SLACK, 0))
    size = a.norm * np.where(cos > 0, b.norm.max(), b.norm.min())
    return np.ceil(size * cos + SLACK * a.norm * b.norm.max() + 1)


class Best:
    """The best ``k`` rows of every window, by (score descending, vec_id, null ids last)."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.kept = [np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64, np.int64)]
        self.n = n

    def add(self, window: np.ndarray, score: np.ndarray, rows: Rows, at: np.ndarray) -> None:
        new = (window, score, rows.no_id[at], rows.vec_id[at], rows.rid[at])
        w, s, none, i, r = (np.concatenate(x) for x in zip(self.kept, new, strict=True))
        # ~s is -s - 1, which no long overflows
        order = np.lexsort((r, i, none, ~s, w))
        w, s, none, i, r = w[order], s[order], none[order], i[order], r[order]
        start = np.searchsorted(w, np.arange(self.n))
        keep = np.arange(w.size) - start[w] < self.k
        self.kept = [x[keep] for x in (w, s, none, i, r)]
        w, s = self.kept[:2]
        ends = np.searchsorted(w, np.arange(self.n), "right")
        full = np.diff(np.concatenate([[0], ends])) == self.k
        self.least[full] = np.maximum(self.least[full], s[ends[full] - 1])

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        w, s, none, i, r = self.kept
        return pa.record_batch([pa.array(w), pa.array(i, mask=none), pa.array(r), pa.array(s)], schema=schema)


FOUND = pa.schema([("window", pa.int64()), ("vec_id", pa.int64()), ("rid", pa.int64()), ("score", pa.int64())])


def _blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
    for whole in parts:
        for at in range(0, whole.num_rows, BLOCK):
            yield Rows.of(whole.slice(at, BLOCK))


def _scan(rows: DataFrame, anchors, same: bool, owner: np.ndarray, least: np.ndarray, most: np.ndarray, k: int) -> DataFrame:
    """The best k rows of each window: of anchor ``owner``, scores from ``least`` to ``most``, of its label or of others (``same``).

    ``owner`` ascends. window, vec_id, rid, score and rank.
    """
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast((anchors, owner, least, most))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, owner, least, most = shared.value
        best = Best(owner.size, k, least)
        first = np.searchsorted(owner, np.arange(len(a.rid) + 1))
        for b in _blocks(parts):
            if not owner.size or not len(b.rid):
                continue
            labels = np.unique(b.label)
            floor = np.full(len(a.rid), LONG.max)
            np.minimum.at(floor, owner, best.least)
            meets = np.isin(a.label, labels) if same else (labels.size > 1) | (a.label != labels[0])
            near = np.flatnonzero(meets & (np.diff(first) > 0) & (block_ceiling(a, b) >= floor))
            for at in range(0, near.size, ANCHORS):
                who = near[at:at + ANCHORS]
                tile = a.take(who)
                low, high = bounds(tile, b)
                fits = (tile.label[:, None] == b.label[None, :]) == same
                fits &= tile.rid[:, None] != b.rid[None, :]
                # the windows of an anchor, one place after the other
                width = int((first[who + 1] - first[who]).max())
                wanted = []
                over = np.zeros(fits.shape, bool)
                for j in range(width):
                    window = np.minimum(first[who] + j, first[who + 1] - 1)
                    there = (first[who] + j < first[who + 1])[:, None]
                    hit = fits & there & (high >= best.least[window][:, None]) & (low <= most[window][:, None])
                    wanted.append((window, hit))
                    over |= hit
                cols = np.flatnonzero(over.any(axis=0))
                if not cols.size:
                    continue
                got = scores(tile, b.take(cols))
                for window, hit in wanted:
                    ok = hit[:, cols] & (got >= best.least[window][:, None]) & (got <= most[window][:, None])
                    # of more than k rows only those that reach the k-th score can stay
                    if cols.size > k and ok.sum() > 4 * k * len(who):
                        masked = np.where(ok, got, LONG.min)
                        ok &= got >= np.partition(masked, cols.size - k, axis=1)[:, cols.size - k][:, None]
                    x, y = np.nonzero(ok)
                    if x.size:
                        best.add(window[x], got[x, y], b, cols[y])
        if best.kept[0].size:
            yield best.batch(FOUND)

    found = rows.mapInArrow(run, "window long, vec_id long, rid long, score long")
    order = Window.partitionBy("window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _least_of(found: DataFrame, k: int, start: np.ndarray) -> np.ndarray:
    """The k-th score of each window that has k rows, ``start`` for the others."""
    got = found.filter(F.col("rank") == k).select("window", "score").toArrow()
    out = start.copy()
    out[got.column("window").to_numpy()] = got.column("score").to_numpy()
    return out


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least_percent: int = 80,
                   references: int = REFERENCES, batch: int = BATCH, seed: int = SEED) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on vec_id. Negatives score from ``least_percent`` % of the positive's score up to that score.
    """
    spark = vectors.sparkSession
    plain = durable(integers(vectors))
    refs = references_of(plain, references)
    measured = with_angles(plain, refs)
    # by label, nearest reference and the angle to it, ids last: equal vectors spread over as many blocks as they fill
    by = ["label", "home", F.coalesce(F.get("angles", F.col("home")), F.lit(0.0)), "norm", "rid"]
    tasks = max(1, min(100_000, -(-plain.count() // (4 * BLOCK))))
    rows = durable(measured.repartitionByRange(tasks, *by).sortWithinPartitions(*by))
    chosen = rows.filter(F.col("vec_id").isNotNull() & is_anchor)
    n, components = chosen.agg(F.count(F.lit(1)), F.sum(F.size("q") + F.lit(len(refs) + 8))).first()
    batches = max(1, -(-(components or 0) // batch))
    seeds = rows.filter(F.pmod(F.floor(F.col("rid") / 64) + F.col("label"), F.lit(seed)) == 0)
    folder = shared_dir(spark)
    for number in range(batches):
        part = chosen.filter(F.pmod(F.xxhash64("rid"), F.lit(batches)) == number)
        a = Rows.of(part.orderBy("label", "home", "rid").toArrow())
        count = len(a.rid)
        owner, least, most = np.arange(count), np.full(count, LONG.min), np.full(count, LONG.max)
        if batches * seed > 1 and count:
            least = _least_of(_scan(seeds, a, True, owner, least, most, positives), positives, least)
        got = _scan(rows, a, True, owner, least, most, positives).orderBy("window", "rank").toArrow()
        owner, high = got.column("window").to_numpy(), got.column("score").to_numpy()
        # least_percent * positive <= 100 * negative, in whole numbers; Python's own, as the product may leave a long
        low = np.array([-(-least_percent * int(s) // 100) for s in high], np.int64)
        least = low
        if owner.size:
            least = np.maximum(low, _least_of(_scan(seeds, a, False, owner, low, high, negatives), negatives, low))
        # the windows of this batch are bounded as its anchors are
        known = pa.table({"window": pa.array(np.arange(owner.size)), "anchor_id": pa.array(a.vec_id[owner], pa.int64()),
                          "positive_id": got.column("vec_id"), "positive_score": pa.array(high, pa.int64())})
        names = F.broadcast(spark.createDataFrame(known))
        found = _scan(rows, a, False, owner, least, high, negatives).join(names, "window")
        found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
                     F.col("score").alias("negative_score")).write.mode("append").parquet(folder)
    return spark.read.schema("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long").parquet(folder)


def op11_angular_triangle(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP11_SQL = r"""
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.r <> b.r
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, b) <= 5
), n AS (
  SELECT p.a, p.b, p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    (row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id, s.b))::INT AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
