"""Benchmark decontamination on a distributed positional inverted index.

``build_index`` cuts the corpus into segments of a bounded number of words. A segment is one row that stands on its own: the
documents in it, a sorted term dictionary and, per term, the postings (word positions) of that term. ``phrases`` and
``proximity`` look terms up in every segment, start from the rarest term of a phrase there and intersect the other terms'
offset-adjusted lists with it. Segments never meet, so nothing is shuffled and a text shared by many documents costs no more
than its occurrences.

Test phrases reach the tasks in blocks of about ``block_words`` words; several blocks are collected, looked up and written one after
another and their spans are united per document, so neither the driver nor a broadcast holds more than a block.

Defined cases: a null or empty text has no words and no hits; a null item text has no windows; an item without an id counts for
hits and is not listed; equal rows are separate documents; an empty table gives an empty result; only the named columns are
read, so extra columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import durable, rows_of, table, text_digest, words

INDEX_SCHEMA = T.StructType([
    T.StructField("segment", T.StringType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("doc_md5", T.ArrayType(T.BinaryType())),
    T.StructField("doc_starts", T.BinaryType()),
    T.StructField("doc_words", T.BinaryType()),
    T.StructField("terms", T.ArrayType(T.BinaryType())),
    T.StructField("offsets", T.BinaryType()),
    T.StructField("positions", T.BinaryType()),
])
HIT_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("doc_key", T.StringType()),
    T.StructField("text_md5", T.BinaryType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("lengths", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.LongType())),
])
#: Words of a segment. With four bytes a posting this bounds a row to some 8 MB.
SEGMENT_WORDS = 2_000_000
#: Words of one block of test items, which every task holds.
BLOCK_WORDS = 2_000_000


def _segment(ids: list, md5: list, terms: list[np.ndarray], names: list[bytes], gap: int) -> dict:
    """One index row. Documents lie ``gap`` positions apart, so that no phrase spans two of them."""
    lens = np.array([len(t) for t in terms], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lens + gap)[:-1]]).astype(np.int64)
    flat = np.concatenate(terms) if terms else np.zeros(0, np.int64)
    at = np.arange(flat.size) + np.repeat(np.arange(lens.size) * gap, lens)
    held = flat >= 0
    flat, at = flat[held], at[held]
    order = np.argsort(flat, kind="stable")
    used, first = np.unique(flat[order], return_index=True)
    by_name = sorted(range(used.size), key=lambda k: names[used[k]])
    ends = np.append(first[1:], flat.size)
    at = at[order]
    lists = [at[first[k]:ends[k]] for k in by_name]
    return {
        "doc_ids": ids,
        "doc_md5": md5,
        "doc_starts": starts.astype("<u4").tobytes(),
        "doc_words": lens.astype("<u4").tobytes(),
        "terms": [names[used[k]] for k in by_name],
        "offsets": np.cumsum([0, *map(len, lists)]).astype("<u4").tobytes(),
        "positions": (np.concatenate(lists) if lists else np.zeros(0)).astype("<u4").tobytes(),
    }


def build_index(docs: DataFrame, terms: list[bytes] | None = None, gap: int = 64,
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The index of ``docs`` (doc_id, text): one row per segment. With ``terms``, only their postings are stored.

    ``gap`` bounds the phrases that can be looked up later. A document of more than ``segment_words`` words is a segment alone.
    """
    spark = docs.sparkSession
    kept = spark.sparkContext.broadcast(sorted(set(terms))) if terms is not None else None
    schema = pa.schema([("segment", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("doc_md5", pa.list_(pa.binary())), ("doc_starts", pa.binary()), ("doc_words", pa.binary()),
                        ("terms", pa.list_(pa.binary())), ("offsets", pa.binary()), ("positions", pa.binary())])

    def build(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed = {w: k for k, w in enumerate(kept.value)} if kept is not None else None

        class Numbers(dict):
            def __missing__(self, w: bytes) -> int:
                if fixed is not None:
                    return -1
                self[w] = n = len(self)
                return n

        known, ids, md5, found, n, part, made = Numbers(fixed or {}), [], [], [], 0, TaskContext.get().partitionId(), 0
        for b in parts:
            for i, text, m in zip(*(c.to_pylist() for c in b.columns), strict=True):
                w = words(text)
                ids.append(i)
                md5.append(m)
                found.append(np.fromiter(map(known.__getitem__, w), np.int64, len(w)))
                n += len(w) + gap
                if n >= segment_words:
                    yield pa.RecordBatch.from_pylist([{"segment": f"{part}-{made}"} | _segment(ids, md5, found, list(known), gap)], schema=schema)
                    made += 1
                    known, ids, md5, found, n = Numbers(fixed or {}), [], [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([{"segment": f"{part}-{made}"} | _segment(ids, md5, found, list(known), gap)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_digest()).mapInArrow(build, INDEX_SCHEMA)


class Segment:
    """An index row opened for look-ups."""

    def __init__(self, row: dict):
        self.ids, self.md5 = row["doc_ids"], row["doc_md5"]
        self.starts = np.frombuffer(row["doc_starts"], "<u4").astype(np.int64)
        self.lens = np.frombuffer(row["doc_words"], "<u4").astype(np.int64)
        self.terms = {w: k for k, w in enumerate(row["terms"])}
        self.offsets = np.frombuffer(row["offsets"], "<u4").astype(np.int64)
        self.positions = np.frombuffer(row["positions"], "<u4").astype(np.int64)
        self.counts = np.diff(self.offsets)

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.offsets[term]:self.offsets[term + 1]]

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Positions where the phrase starts: the rarest term's list, cut down by the others from rare to frequent."""
        order = np.argsort(self.counts[terms], kind="stable")
        at = self.postings(terms[order[0]]) - order[0]
        for k in order[1:]:
            if not at.size:
                break
            there = self.postings(terms[k])
            slot = np.searchsorted(there, at + k)
            slot[slot == there.size] = 0
            at = at[there[slot] == at + k]
        return at

    def near(self, terms: np.ndarray, within: int) -> np.ndarray:
        """Positions of the rarest term that have every other term at most ``within`` words away in the same document."""
        order = np.argsort(self.counts[terms], kind="stable")
        at = self.postings(terms[order[0]])
        for k in order[1:]:
            there, doc = self.postings(terms[k]), self.doc_of(at)
            low = np.maximum(at - within, self.starts[doc])
            high = np.minimum(at + within, self.starts[doc] + self.lens[doc] - 1)
            at = at[np.searchsorted(there, high, "right") > np.searchsorted(there, low, "left")]
        return at

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, "right") - 1


class Windows:
    """The distinct windows of a block of test items: rows of term numbers, padded with the number of terms, and the items of each."""

    def __init__(self, items: list[tuple[int | None, str]], size: int):
        number: dict[bytes, int] = {}
        rows, of = [], []
        for k, (_, text) in enumerate(items):
            w = np.array([number.setdefault(x, len(number)) for x in words(text)], dtype=np.int32)
            if w.size:
                w = np.pad(w, (0, max(0, size - w.size)), constant_values=-1)
                rows.append(np.lib.stride_tricks.sliding_window_view(w, size))
                of.append(np.full(len(rows[-1]), k))
        grid, same = np.unique(np.concatenate(rows), axis=0, return_inverse=True) if rows else (np.zeros((0, size), np.int32), np.zeros(0, int))
        same = same.reshape(-1)
        self.lens = (grid >= 0).sum(axis=1)
        self.grid = np.where(grid < 0, len(number), grid).astype(np.int32)
        self.terms = list(number)
        self.ids = [i for i, _ in items]
        order = np.argsort(same, kind="stable")
        self.items = (np.concatenate(of) if of else np.zeros(0, int))[order]
        self.offsets = np.searchsorted(same[order], np.arange(len(grid) + 1))

    def items_of(self, window: int) -> set:
        return {self.ids[k] for k in self.items[self.offsets[window]:self.offsets[window + 1]].tolist()}


def _look_up(index: DataFrame, sent: Broadcast, within: int | None) -> DataFrame:
    """Hits of the sent windows in every segment, a row per document."""
    schema = pa.schema([("doc_id", pa.int64()), ("doc_key", pa.string()), ("text_md5", pa.binary()), ("n_words", pa.int64()),
                        ("starts", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("items", pa.list_(pa.int64()))])

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        for b in parts:
            for row in rows_of(b):
                seg = Segment(row)
                local = np.array([*(seg.terms.get(w, -1) for w in wanted.terms), 0], dtype=np.int64)
                there = np.array([*(local[:-1] >= 0), True])
                starts: dict[int, dict[int, int]] = {}
                items: dict[int, set] = {}
                for k in np.flatnonzero(there[wanted.grid].all(axis=1)):
                    size = int(wanted.lens[k])
                    terms = local[wanted.grid[k, :size]]
                    at = seg.phrase(terms) if within is None else seg.near(terms, within)
                    of = wanted.items_of(k) if at.size else ()
                    for p, d in zip(at.tolist(), seg.doc_of(at).tolist(), strict=True):
                        mine = starts.setdefault(d, {})
                        p -= int(seg.starts[d])
                        mine[p] = max(mine.get(p, 0), size if within is None else 1)
                        items.setdefault(d, set()).update(of)
                out = [{
                    "doc_id": i, "doc_key": f"{row['segment']}-{d}", "text_md5": seg.md5[d], "n_words": int(seg.lens[d]),
                    "starts": sorted(starts.get(d, ())), "lengths": [v for _, v in sorted(starts.get(d, {}).items())],
                    "items": sorted(x for x in items.get(d, ()) if x is not None),
                } for d, i in enumerate(seg.ids)]
                for k in range(0, len(out), 2000):
                    yield pa.RecordBatch.from_pylist(out[k:k + 2000], schema=schema)

    return index.mapInArrow(search, HIT_SCHEMA)


def _blocks(items: DataFrame, block_words: int) -> tuple[int, Iterator[list[tuple[int | None, str]]]]:
    """How many blocks of about ``block_words`` words the test items make, and the blocks, each collected when its turn comes.

    Equal rows count once; items of one text and several ids may lie in several blocks.
    """
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null").distinct()
    total = items.agg(F.sum(F.length("text") / 2)).first()[0] or 0
    n = int(total // block_words) + 1

    def block(k: int) -> list[tuple[int | None, str]]:
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        return [(r["item_id"], r["text"]) for r in part.collect()]

    return n, (block(k) for k in range(n))


def phrases(docs: DataFrame, items: DataFrame, size: int = 13, within: int | None = None,
            block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, text_md5, n_words, starts and lengths (in words) of all exact windows of the items, and the item ids.

    With ``within``, the proximity matches instead: positions of an item window's rarest term (rarest in its segment) that have
    all its other terms at most that many words away.

    Items of one block (``block_words``) are looked up in an index of their terms only. Of more items, the driver holds one block at
    a time; the index then has all terms of the corpus, is some four bytes a word larger, and each block's hits are written out.
    """
    spark = docs.sparkSession
    n, blocks = _blocks(items, block_words)
    gap = max(64, size)
    if n == 1:
        wanted = Windows(next(blocks), size)
        index = durable(build_index(docs, wanted.terms, gap=gap))
        return _look_up(index, spark.sparkContext.broadcast(wanted), within).drop("doc_key")
    index = durable(build_index(docs, gap=gap))
    both = _look_up(index, spark.sparkContext.broadcast(Windows([], size)), within)
    for b in blocks:
        sent = spark.sparkContext.broadcast(Windows(b, size))
        both = both.unionByName(durable(_look_up(index, sent, within).filter("size(starts) > 0")))
        sent.unpersist()
    return both.groupBy("doc_key").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_md5").alias("text_md5"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("lengths")).alias("lengths"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    ).drop("doc_key")


def contaminated(docs: DataFrame, items: DataFrame, size: int = 13) -> DataFrame:
    """Per document: doc_id, text_md5, n_words, n_hit (words inside any window), items (sorted ids), contaminated (5 % or more of its words hit)."""
    hits = phrases(docs, items, size)
    # Words covered: walk the spans by start, counting of each what lies beyond the furthest end so far.
    spans = F.array_sort(F.arrays_zip("starts", "lengths"))
    n_hit = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["starts"] + s["lengths"] - F.greatest(a["end"], s["starts"]))).alias("n"),
            F.greatest(a["end"], s["starts"] + s["lengths"]).alias("end"),
        ), lambda a: a["n"])
    return hits.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated")


OP5_SQL = r"""
WITH it AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), win AS (
  SELECT item_id, len(w) AS n, list_slice(w, k, k + 12) AS x
  FROM it, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS u(k) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT len(x) AS n FROM win
), d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), dw AS (
  SELECT r, k, sizes.n, list_slice(w, k, k + sizes.n - 1) AS x
  FROM d, sizes, unnest(range(1, len(w) - sizes.n + 2)) AS u(k)
), hit AS (
  SELECT dw.r, dw.k, dw.n, win.item_id FROM dw JOIN win ON dw.x = win.x
), cov AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM hit, unnest(range(hit.k, hit.k + hit.n)) AS u(p) GROUP BY r
), ids AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s FROM hit GROUP BY r
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN ids USING (r)
"""
