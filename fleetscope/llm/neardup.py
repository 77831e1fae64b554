"""Near duplicates by order MinHash and banded alignment.

``sketches`` labels every shingle of five words with its occurrence number, draws for each of 20 hash functions the three
smallest labelled shingles and hashes them in text order: two texts share such a sketch with about the cube of their similarity,
and only if the order agrees. Texts of equal words share a ``key`` and are one node from here on, however many copies there are.

Nodes that share a sketch are in one bucket. Every bucket is first compared with its centre only, the member whose sketches are
the most common overall (in a family of edited copies: the one nearest to the original). ``components`` joins what passed. Buckets
that still hold several components then compare members of different components, and only those, in chunks of bounded size, and
emit no more edges than it takes to connect them. So no link between different texts is lost to a bucket's size, a family of
copies costs a number of comparisons in proportion to its size, and pairs inside a component are never formed.

A comparison is an alignment of the two shingle sequences in the band that the threshold leaves, in words of bits; the similarity
is matched / (all - matched), a Jaccard similarity that counts only shingles in the same order. 0.8 or more is a link.

Defined cases: a null or empty text has no words, and all these are one class; a text of fewer than five words is one shingle; a
null doc_id is never a class id unless the whole class has none; rows that are equal are in the same class; an empty table gives no
rows; only doc_id and text are read, whatever other columns there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, table, text_digest, words

SHINGLE, SKETCHES, PICKS, SIMILAR = 5, 20, 3, 0.8
#: Members and words of a chunk of a large bucket.
CHUNK, CHUNK_WORDS = 1024, 1_000_000

_ODD = np.random.default_rng(20260101).integers(1, 1 << 63, size=64, dtype=np.uint64) | np.uint64(1)
_SALT = np.random.default_rng(20260102).integers(1, 1 << 63, size=256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(word_hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of ``size`` words; a shorter text that has words is one run."""
    if not word_hashes.size:
        return np.zeros(0, np.uint64)
    w, k = _mix(word_hashes.astype(np.uint64) + np.uint64(1)), min(size, word_hashes.size)
    n = w.size - k + 1
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += w[j:j + n] * _ODD[j]
    return _mix(out)


def labelled(sh: np.ndarray) -> np.ndarray:
    """Each shingle hashed with the number of times it came before."""
    order = np.argsort(sh, kind="stable")
    s = sh[order]
    first = np.concatenate([[True], s[1:] != s[:-1]]) if s.size else np.zeros(0, bool)
    at = np.arange(s.size)
    seen = np.empty(s.size, np.uint64)
    seen[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return _mix(sh + seen * _ODD[40])


def order_sketch(lab: np.ndarray, n: int = SKETCHES, picks: int = PICKS) -> np.ndarray:
    """n hashes, each of the ``picks`` smallest labelled shingles in text order."""
    if not lab.size:
        return np.zeros(0, np.int64)
    h = (lab[None, :] ^ _SALT[:n, None]) * _ODD[41]
    h ^= h >> np.uint64(32)
    at = np.argpartition(h, picks - 1, axis=1)[:, :picks] if lab.size > picks else np.broadcast_to(np.arange(lab.size), (n, lab.size)).copy()
    at.sort(axis=1)
    out = _SALT[100:100 + n].copy()
    for r in range(at.shape[1]):
        out = _mix(out * _ODD[42] + lab[at[:, r]])
    return out.view(np.int64)


def sketch_documents(docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, key (md5 of the words), n_words, sketch, words (a hash of each word) of every row; with ``digest`` text_md5 too."""
    extra = [("text_md5", pa.binary())] if digest else []
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("n_words", pa.int32()), ("sketch", pa.list_(pa.int64())), ("words", pa.binary()), *extra])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            out: list[tuple] = []
            for text in b.column(1).to_pylist():
                w = words(text)
                hashes = np.fromiter(map(crc32, w), np.uint32, len(w))
                out.append((hashlib.md5(b" ".join(w)).digest(), len(w), order_sketch(labelled(shingles(hashes))), hashes.astype("<u4").tobytes()))
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.record_batch([b.column(0), *(pa.array(c, t) for c, t in zip(cols, schema.types[1:5], strict=True)), *b.columns[2:]], schema=schema)

    more = [text_digest().alias("text_md5")] if digest else []
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *more).mapInArrow(
        run, "doc_id long, key binary, n_words int, sketch array<long>, words binary" + (", text_md5 binary" if digest else ""))


def common_in_order(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Matches of the best alignment of two sequences whose paired places differ by at most ``band``."""
    n = min(a.size, b.size)
    same = a[:n] == b[:n]
    head = n if same.all() else int(np.argmin(same))
    a, b = a[head:], b[head:]
    n = min(a.size, b.size)
    same = a[a.size - n:][::-1] == b[b.size - n:][::-1]
    tail = n if same.all() else int(np.argmin(same))
    a, b = a[:a.size - tail].tolist(), b[:b.size - tail].tolist()
    if not a or not b:
        return head + tail
    at: dict[int, list[int]] = {}
    for i, s in enumerate(a):
        at.setdefault(s, []).append(i)
    full = (1 << len(a)) - 1
    row = full  # a zero bit at i: the alignment gains a match there
    for j, s in enumerate(b):
        match = 0
        for i in at.get(s, ()):
            if -band <= i - j <= band:
                match |= 1 << i
        if match:
            hit = row & match
            row = ((row + hit) | (row - hit)) & full
    return head + tail + len(a) - row.bit_count()


def needed(n: int, m: int, similar: float) -> int:
    """Matches that two sequences of these lengths need for the similarity."""
    return int(np.ceil(similar * (n + m) / (1 + similar) - 1e-9))


def alike(a: np.ndarray, b: np.ndarray, similar: float = SIMILAR) -> bool:
    """Whether two shingle sequences have that similarity in order."""
    least = needed(a.size, b.size, similar)
    if min(a.size, b.size) < least or not least:
        return False
    if np.intersect1d(labelled(a), labelled(b), assume_unique=True).size < least:
        return False
    return common_in_order(a, b, a.size + b.size - 2 * least) >= least


def _verified(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """Those pairs (a, b: keys) that are links."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in parts:
            last, sh = None, np.zeros(0)
            out = []
            for a, b, x, y in zip(*(c.to_pylist() for c in t.columns), strict=True):
                if a != last:
                    last, sh = a, shingles(np.frombuffer(x, "<u4"))
                if alike(sh, shingles(np.frombuffer(y, "<u4")), similar):
                    out.append((a, b))
            if out:
                yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], schema=schema)

    x = texts.select(F.col("key").alias("a"), F.col("words").alias("x"), F.col("n_words").alias("nx"))
    y = texts.select(F.col("key").alias("b"), F.col("words").alias("y"), F.col("n_words").alias("ny"))
    # texts whose lengths alone rule the similarity out are not paired
    k = SHINGLE - 1
    n, m = F.greatest(F.col("nx") - k, F.lit(1)), F.greatest(F.col("ny") - k, F.lit(1))
    fits = F.least(n, m) >= F.lit(similar) * F.greatest(n, m) - 1e-9
    return pairs.join(x, "a").join(y, "b").filter(fits).select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """key and label (the smallest key of its component) of every key in ``edges`` (a, b), by alternating large and small stars."""
    def mark(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    def star(df: DataFrame) -> DataFrame:
        return df.groupBy("a").agg(F.min("b").alias("m"))

    e = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = mark(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = star(both).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = durable(large.filter("a <> b"))
        low = star(large)
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        e = durable(small.filter("a <> b").distinct())
        now = mark(e)
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("key"), F.col("b").alias("label")).unionByName(
        e.select(F.col("b").alias("key"), F.col("b").alias("label")).distinct())


def _across(t: pa.Table, similar: float) -> pa.Table:
    """Edges between different components of one chunk, or of a pair of chunks, of a bucket."""
    keys, labels, side = (t.column(c).to_pylist() for c in ("key", "label", "chunk"))
    low, high, bucket = t.column("low")[0].as_py(), t.column("high")[0].as_py(), t.column("bucket")[0].as_py()
    bands = np.array(t.column("sketch").to_pylist(), dtype=np.int64)
    band = int(np.argmax((bands == bucket).all(axis=0)))
    sh = [shingles(np.frombuffer(w, "<u4")) for w in t.column("words").to_pylist()]
    n = np.array([s.size for s in sh])
    _, flat = np.unique(np.concatenate([labelled(s) for s in sh]), return_inverse=True)
    of, ends = np.repeat(np.arange(n.size), n), np.cumsum(n)
    up = {x: x for x in labels}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    names, code = np.unique(np.array([x.hex() for x in labels]), return_inverse=True)
    usual = int(np.argmax(np.bincount(code)))
    out = []
    here = np.zeros(int(flat.max()) + 1, bool) if flat.size else np.zeros(0, bool)
    for i in range(n.size):
        if names.size == 1 or code[i] == usual:
            continue  # its partners of other components ask for it
        mine = flat[ends[i] - n[i]:ends[i]]
        here[mine] = True
        shared = np.bincount(of, here[flat], minlength=n.size)
        here[mine] = False
        least = np.ceil(similar * (n + n[i]) / (1 + similar) - 1e-9)
        first = np.argmax(bands == bands[i], axis=1) == band  # each pair is compared in the first bucket that it shares
        for j in np.flatnonzero((shared >= least) & first & (code != code[i])).tolist():
            if {side[i], side[j]} != {low, high} or root(labels[i]) == root(labels[j]):
                continue
            if common_in_order(sh[i], sh[j], int(n[i] + n[j] - 2 * least[j])) >= least[j]:
                up[root(labels[i])] = root(labels[j])
                out.append((keys[i], keys[j]))
    return pa.table([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], names=["a", "b"])


def _labels(rows: DataFrame, similar: float) -> DataFrame:
    """key and label (of its class) of every key that shares a class with another; a key without a row is its own class."""
    # One row per node and bucket; the bucket's number is the sketch itself, whose salt differs by position.
    member = rows.select("key", "n_words", F.explode("sketch").alias("bucket")).groupBy("bucket", "key").agg(F.first("n_words").alias("n_words"))
    member = durable(member)
    sizes = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("total")).filter("n > 1")
    shared = durable(member.join(sizes, "bucket"))
    degree = shared.groupBy("key").agg(F.sum("n").alias("degree"))
    centre = shared.join(degree, "key").groupBy("bucket").agg(F.max(F.struct("degree", "key")).getField("key").alias("a"))
    pairs = shared.join(centre, "bucket").filter("a <> key").select("a", F.col("key").alias("b")).distinct()
    # The words of the nodes that share a bucket, one row each: the row of the smallest doc_id.
    nodes = rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    chosen = nodes.join(degree, "key", "left_semi").select(F.col("key").alias("k"), F.col("doc_id").alias("d"))
    one = rows.join(chosen, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")), "left_semi")
    texts = durable(one.groupBy("key").agg(F.first("words").alias("words"), F.first("n_words").alias("n_words"), F.first("sketch").alias("sketch")))
    links = durable(_verified(pairs.sortWithinPartitions("a"), texts, similar))
    label = durable(components(links))
    # Buckets that hold several components; one of two members has been compared already.
    known = shared.filter("n > 2").join(label, "key", "left").withColumn("label", F.coalesce("label", "key"))
    open_ = known.groupBy("bucket").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).filter("l0 <> l1").select("bucket")
    chunks = F.greatest(F.ceil(F.col("n") / CHUNK), F.ceil(F.col("total") / CHUNK_WORDS)).cast("int")
    dealt = known.join(open_, "bucket", "left_semi").withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
    dealt = dealt.select("bucket", "key", "label", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    dealt = dealt.select("bucket", "key", "label", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    across = dealt.join(texts, "key").groupBy("bucket", "low", "high").applyInArrow(lambda t: _across(t, similar), "a binary, b binary")
    more = durable(across)
    if more.take(1):
        label = durable(components(label.select(F.col("key").alias("a"), F.col("label").alias("b")).unionByName(more)))
    return label


def classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id and class_id (the smallest doc_id of the class) of every row."""
    rows = durable(sketch_documents(docs))
    label = _labels(rows, similar)
    nodes = rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    named = nodes.join(label, "key", "left").withColumn("label", F.coalesce("label", "key"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    class_of = named.join(least, "label").select("key", "class_id")
    return rows.select("doc_id", "key").join(class_of, "key").select("doc_id", "class_id")


def representatives(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id and text_md5 of one text of each class: the smallest by (doc_id, text_md5), a null doc_id last."""
    rows = durable(sketch_documents(docs, digest=True))
    label = _labels(rows, similar)
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_md5")
    nodes = rows.groupBy("key").agg(F.min(order).alias("row"))
    named = nodes.join(label, "key", "left").withColumn("label", F.coalesce("label", "key"))
    return named.groupBy("label").agg(F.min("row").alias("row")).select("row.doc_id", "row.text_md5")


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
