"""Language-model scoring by a weighted backoff automaton.

The automaton has a state for every word that training texts hold, one for the start of a text, and one without history. A word
state's arcs are the word pairs seen in training; a failure arc leads to the state without history, which knows every word. With
T(h) the number of distinct words after h and c the training counts, interpolated Witten-Bell smoothing gives

    arc h -> w        log10 ((c(h w) + k T(h) P(w)) / (c(h) + k T(h)))
    failure of h      log10 (k T(h) / (c(h) + k T(h)))
    without history   log10 P(w) = log10 ((c(w) + 1) / (N + V + 1))

so that every state's probabilities sum to 1 over the vocabulary and one unseen word. A text is scored in one pass from left to
right: the state is the last word, a missing arc takes the failure arc and the arc without history.

No task holds the model. The corpus is cut into blocks of ``BLOCK_TOKENS`` tokens. A block sends the sorted hashes of its distinct
words and pairs with their training counts to the buckets of a range partition of the hashes, a bucket sums the counts over all
blocks and answers each block for exactly what it asked, and a second round does the same for T(h): each pair is reported by the
first block that has it in training, so T(h) is a sum of partial sums. The block then holds the states and arcs that its own texts
can reach, and no others. All counts cover all training texts; a word that a third of them holds is one row per block.

Words and pairs are identified by 63-bit hashes; two of n distinct ones collide with odds of n * n / 2 ** 64.

Defined cases: a null or empty text has the end token only; a null doc_id counts as the empty text for the split; equal rows are
separate texts and each counts; without training texts all counts are 0; an empty table gives no rows; only doc_id and text are
read, whatever other columns there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32, durable, rows_of, table

BLOCK_TOKENS = 1_500_000
#: Keys of a bucket, about.
BUCKET_KEYS = 1_500_000
#: A-Z become a-z, every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
END, START = b"", b" "  # no word is empty or has a space

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, without the end token."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def _hash(word: bytes) -> int:
    """Even: a word's key; pairs have odd ones."""
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little") & ~1


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = (left * _A) ^ (right * _B + (left >> np.uint64(7)))
    x = (x ^ (x >> np.uint64(32))) * _A
    return (x ^ (x >> np.uint64(29))) | np.uint64(1)


def planes(x: np.ndarray) -> bytes:
    """The bytes of unsigned integers, all lowest ones first and so on: what is mostly zero compresses away."""
    wide = x.astype("<u8").view(np.uint8).reshape(-1, 8)
    used = max(1, 8 - int((~wide.any(axis=0))[::-1].argmin())) if wide.any() else 1
    return bytes([used]) + np.ascontiguousarray(wide[:, :used].T).tobytes()


def unplanes(data: bytes) -> np.ndarray:
    used = data[0]
    low = np.frombuffer(data, np.uint8, offset=1).reshape(used, -1)
    wide = np.zeros((low.shape[1], 8), np.uint8)
    wide[:, :used] = low.T
    return wide.view("<u8").ravel()


def blocks_of(docs: DataFrame, folds: int, held_out: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of whole texts: ids, whether each trains, numbers of tokens, token numbers, and the hash of each numbered word."""
    schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("trains", pa.list_(pa.bool_())),
                        ("n_tokens", pa.list_(pa.int64())), ("total", pa.int64()), ("at", pa.binary()), ("hashes", pa.binary())])

    class Numbers(dict):
        def __missing__(self, w: bytes) -> int:
            self[w] = n = len(self)
            return n

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0

        def fresh():
            return Numbers({END: 0, START: 1}), [], [], []

        known, ids, trains, at = fresh()

        def block() -> pa.RecordBatch:
            nonlocal made
            made += 1
            flat = np.concatenate(at)
            row = {"block": (part << 32) + made, "doc_ids": ids, "trains": trains, "n_tokens": [a.size for a in at], "total": flat.size,
                   "at": planes(flat), "hashes": np.array([_hash(w) for w in known], "<u8").tobytes()}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        n = 0
        for b in parts:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = [*tokens(text), END]
                ids.append(i)
                trains.append(crc32(b"" if i is None else str(i).encode()) % folds != held_out)
                at.append(np.fromiter(map(known.__getitem__, w), np.uint32, len(w)))
                n += len(w)
                if n >= block_tokens:
                    yield block()
                    (known, ids, trains, at), n = fresh(), 0
        if ids:
            yield block()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "block long, doc_ids array<long>, trains array<boolean>, n_tokens array<long>, total long, at binary, hashes binary")


class Block:
    """A block's tokens, and the sorted keys of all it has to ask for."""

    def __init__(self, row: dict):
        self.row = row
        self.n = np.array(row["n_tokens"], np.int64)
        self.trains = np.array(row["trains"], bool)
        self.at = unplanes(row["at"]).astype(np.int64)
        self.hashes = np.frombuffer(row["hashes"], "<u8")
        ends = np.cumsum(self.n)
        self.starts = ends - self.n
        self.before = np.empty_like(self.at)
        self.before[1:] = self.at[:-1]
        self.before[self.starts] = 1  # START
        self.train = np.repeat(self.trains, self.n)
        pairs, self.pair_of = np.unique(_pair(self.hashes[self.before], self.hashes[self.at]), return_inverse=True)
        # all keys in one sorted array; where the words and the pairs stand in it
        keys = np.concatenate([self.hashes, pairs])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        place = np.empty(order.size, np.int64)
        place[order] = np.arange(order.size)
        self.words_at, self.pairs_at = place[:self.hashes.size], place[self.hashes.size:]
        self.n_pairs = pairs.size

    def counts(self) -> np.ndarray:
        """Training counts of ``keys``; START counts the training texts."""
        out = np.zeros(self.keys.size, np.int64)
        out[self.words_at] = np.bincount(self.at[self.train], minlength=self.hashes.size)
        out[self.words_at[1]] = int(self.trains.sum())
        out[self.pairs_at] = np.bincount(self.pair_of[self.train], minlength=self.n_pairs)
        return out

    def followers(self, owned: np.ndarray) -> np.ndarray:
        """Per word number, the pairs that start with it and are this block's to report."""
        left = np.zeros(self.n_pairs, np.int64)
        left[self.pair_of] = self.before
        return np.bincount(left[owned], minlength=self.hashes.size)


def _slices(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's part of sorted keys begins, and the end."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    if buckets == 1:
        return np.array([0, keys.size])
    return np.append(np.searchsorted(keys, np.arange(buckets, dtype=np.uint64) << shift), keys.size)


ASK = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
ANSWER = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("totals", pa.binary()), ("owned", pa.binary()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])


def _ask(block: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    cut = _slices(keys, buckets)
    rows = []
    for k in range(buckets):
        part = keys[cut[k]:cut[k + 1]]
        if part.size:
            steps = np.diff(part, prepend=np.uint64(0))
            rows.append({"bucket": k, "block": block, "keys": planes(steps), "counts": planes(counts[cut[k]:cut[k + 1]])})
    return pa.RecordBatch.from_pylist(rows, schema=ASK)


def _answer(t: pa.Table, special: tuple[int, ...]) -> pa.Table:
    """Sum the counts of one bucket over all blocks and answer every block in its own order."""
    by = np.argsort(np.array(t.column("block").to_pylist()), kind="stable").tolist()
    blocks = [t.column("block")[k].as_py() for k in by]
    keys = [np.cumsum(unplanes(t.column("keys")[k].as_py())) for k in by]
    counts = [unplanes(t.column("counts")[k].as_py()).astype(np.int64) for k in by]
    sizes = np.array([k.size for k in keys])
    flat, n = np.concatenate(keys), np.concatenate(counts)
    distinct, place = np.unique(flat, return_inverse=True)
    totals = np.zeros(distinct.size, np.int64)
    np.add.at(totals, place, n)
    at = np.flatnonzero(n > 0)[::-1]
    owner = np.full(distinct.size, -1)
    owner[place[at]] = at  # the last to be written is the first block's
    owned = np.zeros(flat.size, bool)
    owned[owner[owner >= 0]] = True
    words = (distinct & np.uint64(1) == 0) & ~np.isin(distinct, np.array(special, np.uint64)) & (totals > 0)
    rows, end = [], np.cumsum(sizes)
    for k, b in enumerate(blocks):
        part = slice(end[k] - sizes[k], end[k])
        rows.append({"bucket": t.column("bucket")[0].as_py(), "block": b, "totals": planes(totals[place[part]]), "owned": np.packbits(owned[part]).tobytes(),
                     "n_words": int(words.sum()) if k == 0 else 0, "n_tokens": int(totals[words].sum()) if k == 0 else 0})
    return pa.Table.from_pylist(rows, schema=ANSWER)


def _joined(parts: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    parts = sorted(parts, key=lambda r: r["bucket"])
    totals = [unplanes(r["totals"]).astype(np.int64) for r in parts]
    owned = [np.unpackbits(np.frombuffer(r["owned"], np.uint8), count=n.size).astype(bool) for r, n in zip(parts, totals, strict=True)]
    return np.concatenate(totals), np.concatenate(owned)


class Automaton:
    """The states and arcs that one block's texts can reach, with log10 weights."""

    def __init__(self, block: Block, counts: np.ndarray, followers: np.ndarray, n: int, v: int, k: float = 1.0):
        word = counts[block.words_at]
        self.known = word > 0
        self.plain = np.log10((np.where(np.arange(word.size) == 1, 0, word) + 1) / (n + v + 1))
        mass = k * followers
        seen = mass + word > 0
        self.failure = np.where(seen & (mass > 0), np.log10(np.maximum(mass, 1e-300) / np.maximum(word + mass, 1e-300)), 0.0)
        left, right = np.zeros(block.n_pairs, np.int64), np.zeros(block.n_pairs, np.int64)
        left[block.pair_of], right[block.pair_of] = block.before, block.at
        pairs = counts[block.pairs_at]
        self.has_arc = pairs > 0
        arc = (pairs + mass[left] * 10.0 ** self.plain[right]) / np.maximum(word[left] + mass[left], 1)
        self.arc = np.log10(np.where(self.has_arc, arc, 1.0))

    def traverse(self, block: Block) -> np.ndarray:
        """log10 probability of every token: the arc of the state, else its failure arc and the arc without history."""
        return np.where(self.has_arc[block.pair_of], self.arc[block.pair_of], self.failure[block.before] + self.plain[block.at])


def score(docs: DataFrame, folds: int = 7, held_out: int = 2, k: float = 1.0, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row. Texts whose crc32(doc_id) mod ``folds`` is
    ``held_out`` don't train."""
    spark = docs.sparkSession
    blocks = durable(blocks_of(docs, folds, held_out, block_tokens))
    total = blocks.agg(F.sum("total")).first()[0] or 0
    buckets = 1 << max(0, int(total // BUCKET_KEYS)).bit_length()
    special = (_hash(START),)

    def ask_counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            for row in rows_of(b):
                x = Block(row)
                yield _ask(row["block"], x.keys, x.counts(), buckets)

    def ask_followers(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            for row in rows_of(b):
                x = Block(row)
                _, owned = _joined(row["first"])
                order = np.argsort(x.hashes, kind="stable")
                yield _ask(row["block"], x.hashes[order], x.followers(owned[x.pairs_at])[order], buckets)

    ask, answer = "bucket int, block long, keys binary, counts binary", "bucket int, block long, totals binary, owned binary, n_words long, n_tokens long"

    def exchange(asked: DataFrame) -> DataFrame:
        return durable(asked.groupBy("bucket").applyInArrow(lambda t: _answer(t, special), answer))

    def given(to: DataFrame, answers: DataFrame, name: str) -> DataFrame:
        per = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "totals", "owned")).alias(name))
        return to.join(per, "block")

    first = exchange(blocks.mapInArrow(ask_counts, ask))
    v, n = first.agg(F.sum("n_words"), F.sum("n_tokens")).first()
    v, n = v or 0, n or 0
    second = exchange(given(blocks, first, "first").mapInArrow(ask_followers, ask))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            for row in rows_of(b):
                x = Block(row)
                counts, _ = _joined(row["first"])
                asked, _ = _joined(row["second"])
                followers = np.empty(x.hashes.size, np.int64)
                followers[np.argsort(x.hashes, kind="stable")] = asked
                model = Automaton(x, counts, followers, n, v, k)
                cols = [np.add.reduceat(c, x.starts) for c in (model.known[x.at].astype(np.int64), model.plain[x.at], model.traverse(x))]
                yield pa.record_batch([
                    pa.array(row["doc_ids"], pa.int64()), pa.array((~x.trains).tolist(), pa.bool_()), pa.array(x.n, pa.int64()), pa.array(cols[0], pa.int64()),
                    pa.array(np.full(x.n.size, n), pa.int64()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.float64())], schema=schema)

    return given(given(blocks, first, "first"), second, "second").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op3_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
