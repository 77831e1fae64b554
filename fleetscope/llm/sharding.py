"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups are equal texts. Their sizes are summed before anything else moves (partial aggregation), so a text that a third of the
rows share is one row after the first step. A group of at least total / (shards * grain) bytes is an item of its own; there
are at most shards * grain of these. The smaller groups are hashed into shards * grain bundles, each one item. Hence the driver
packs at most 2 * shards * grain items, whatever the input's size, and the same bound holds for what it broadcasts.

``pack`` is best fit decreasing: items from large to small, each into the open bin with the tightest sufficient room, found in
a balanced tree (a treap keyed by room). ``fewest_bins`` gives the shards of a fixed capacity; ``even_bins`` searches the
smallest capacity for which the packing needs no more than the given number of shards.

Slots number each shard's rows from 0 without gaps: rows are ranked inside (shard, hash cell) and shifted by the counts of the
cells before, so no task sorts a whole shard.

Defined cases: a null text counts as the empty text (0 bytes, crc32 0) and is in its group; every row is placed, equal rows
included; a null doc_id sorts first; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table


class RoomTree:
    """Balanced search tree of (room, bin); a treap whose priorities are hashes of the bin number."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, priority, left, right]

    def _split(self, t, key):
        if t is None:
            return None, None
        if t[0] < key:
            a, b = self._split(t[3], key)
            t[3] = a
            return t, b
        a, b = self._split(t[2], key)
        t[2] = b
        return a, t

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b

    def add(self, room: int, bin_: int) -> None:
        key = (room, bin_)
        a, b = self._split(self.root, key)
        self.root = self._join(self._join(a, [key, (bin_ * 2654435761 + 40503) % 4294967291, None, None]), b)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the entry with the least room of at least ``size``."""
        a, b = self._split(self.root, (size, -1))
        if b is None:
            self.root = a
            return None
        if b[2] is None:
            key, b = b[0], b[3]
        else:
            up, t = b, b[2]
            while t[2] is not None:
                up, t = t, t[2]
            key, up[2] = t[0], t[3]
        self.root = self._join(a, b)
        return key


def pack(sizes: list[int], capacity: int, bins: int | None = None) -> list[int] | None:
    """Best fit for sizes that come in decreasing order: a bin number for each, or None if more than ``bins`` are needed."""
    tree, out, n = RoomTree(), [], 0
    for size in sizes:
        got = tree.take(size)
        if got is None:
            if size > capacity or (bins is not None and n >= bins):
                return None
            got, n = (capacity, n), n + 1
        out.append(got[1])
        tree.add(got[0] - size, got[1])
    return out


def fewest_bins(sizes: list[int], capacity: int) -> list[int]:
    """Bins of a fixed capacity; an item larger than that is an error."""
    out = pack(sizes, capacity)
    if out is None:
        raise ValueError(f"an item has {max(sizes)} bytes, a shard {capacity}")
    return out


def even_bins(sizes: list[int], bins: int) -> list[int]:
    """The smallest capacity that best fit decreasing meets with ``bins`` bins, by bisection between the mean and a sure bound."""
    if not sizes:
        return []
    low = max(-(-sum(sizes) // bins), sizes[0])
    high, best = low + sizes[0], None
    while (best := pack(sizes, high, bins)) is None:
        high += max(sizes[0], high // 8)
    while low < high:
        mid = (low + high) // 2
        if (found := pack(sizes, mid, bins)) is None:
            low = mid + 1
        else:
            best, high = found, mid
    return best


def shard_documents(docs: DataFrame, shards: int = 8, grain: int = 1024, capacity: int | None = None,
                    cells: int = 512) -> DataFrame:
    """All rows with doc_id, size (UTF-8 bytes + 1), text_crc32, shard and slot.

    ``capacity`` None: ``shards`` shards of nearly equal bytes. Otherwise as few shards of at most that many bytes as the
    packing needs; then ``shards`` only scales the number of items.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("g"))
    groups = rows.groupBy("g").agg(F.sum("size").alias("bytes")).withColumn(
        "bundle", F.pmod(F.xxhash64("g"), F.lit(shards * grain)))
    total = rows.agg(F.sum("size")).first()[0] or 0
    least = max(1, -(-total // (shards * grain)))
    large = [(r["g"], r["bytes"]) for r in groups.filter(F.col("bytes") >= least).select("g", "bytes").collect()]
    small = [(r["bundle"], r["bytes"]) for r in groups.filter(F.col("bytes") < least).groupBy("bundle").agg(F.sum("bytes").alias("bytes")).collect()]
    items = sorted([*large, *small], key=lambda x: (-x[1], str(x[0])))
    sizes = [x[1] for x in items]
    bins = even_bins(sizes, shards) if capacity is None else fewest_bins(sizes, capacity)
    to = list(zip((x[0] for x in items), bins, strict=True))
    # At most shards * grain rows each: the bound that makes the two broadcasts safe.
    large_df = spark.createDataFrame([(k, b) for k, b in to if isinstance(k, str)], "g string, own_shard int")
    small_df = spark.createDataFrame([(k, b) for k, b in to if not isinstance(k, str)], "bundle long, bundle_shard int")
    placed = (
        rows.withColumn("bundle", F.pmod(F.xxhash64("g"), F.lit(shards * grain)))
        .join(F.broadcast(large_df), "g", "left").join(F.broadcast(small_df), "bundle", "left")
        .select("doc_id", "size", "text_crc32", "g", F.coalesce("own_shard", "bundle_shard").alias("shard"))
        .withColumn("cell", F.pmod(F.xxhash64("doc_id", "g"), F.lit(cells)).cast("int")))
    counts = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "cell", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "g"))
    ranked = placed.withColumn("rank", rank)
    if capacity is None:  # at most shards * cells rows
        before = F.broadcast(before)
    return ranked.join(before, ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("rank") - 1).cast("long").alias("slot"))


def op8_bin_packing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
