"""Byte-level BPE encoding and decoding by the ranks of a public vocabulary.

``encode_words`` is the native form: the vocabulary is a literal rank map (a cuckoo table of two literal arrays, as Spark's own maps
are searched entry by entry), the bytes of a distinct word are an array, and ``aggregate`` folds merges over it, the pair of the
lowest rank first, until no pair is in the map. ``decode`` is native too: it looks ids up in the literal array of pieces and
concatenates them.

``encode`` serves whole documents. Carrying ids back from distinct words to documents takes a shuffle of about the text's size, or
the fold once per document and word; the README has the figures of both. So ``encode`` folds the same merges inside Arrow batches:
a worker remembers the words that it has folded (within ``CACHE_BYTES``), and nothing is shuffled.

Defined cases: a null text counts as the empty text, which has no ids and decodes to no bytes; equal rows are encoded alike and
all kept; a word of any length takes time in n log n of its bytes; an empty table gives no rows; ``encode`` reads doc_id and text only, ``encode_words`` and ``decode`` only the column
named.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Bytes that a worker spends on remembered words, about; beyond it forgets all and starts anew.
CACHE_BYTES = 160_000_000
#: What an entry takes beside its word and ids, and the bytes of a word from which it isn't remembered, and is merged by a heap.
ENTRY, LONG_WORD = 200, 100


def load_ranks(path: str) -> dict[bytes, int]:
    """Pieces and their ranks, which are their ids."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: join the adjacent pair of the lowest rank, the leftmost of equals, while there is one.

    Long words keep the candidate pairs in a heap and the pieces in a linked list, n log n in their bytes.
    """
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) > LONG_WORD:
        return _merge_long(word, ranks)
    parts = [word[k:k + 1] for k in range(len(word))]
    none = len(ranks) + (1 << 40)
    pairs = [ranks.get(parts[k] + parts[k + 1], none) for k in range(len(parts) - 1)]
    while pairs and (low := min(pairs)) < none:
        k = pairs.index(low)
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
        del pairs[k]
        if k < len(pairs):
            pairs[k] = ranks.get(parts[k] + parts[k + 1], none)
        if k:
            pairs[k - 1] = ranks.get(parts[k - 1] + parts[k], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    n, get = len(word), ranks.get
    # A piece is named by its start; stop[k] is its end and so the piece to its right, pair[k] the rank of the two together or -1.
    stop, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pair = [get(word[k:k + 2], -1) for k in range(n - 1)] + [-1]
    heap = [r * n + k for k, r in enumerate(pair) if r >= 0]
    heapify(heap)
    while heap:
        r, a = divmod(heappop(heap), n)
        if pair[a] != r:
            continue  # one of the two has been joined to another since
        b = stop[a]
        stop[a] = z = stop[b]
        pair[b] = pair[a] = -1
        if z < n:
            before[z] = a
            pair[a] = r = get(word[a:stop[z]], -1)
            if r >= 0:
                heappush(heap, r * n + a)
        if a:
            left = before[a]
            pair[left] = r = get(word[left:z], -1)
            if r >= 0:
                heappush(heap, r * n + left)
    out, k = [], 0
    while k < n:
        out.append(ranks[word[k:stop[k]]])
        k = stop[k]
    return out


class Encoder:
    """Whole texts, word by word.

    A space between two characters that are no white space always goes with what follows it, so texts without other spaces next to
    white space are cut there and each chunk is remembered; the rest is split by the pattern as a whole.
    """

    ODD = re.compile(r" \s|\s ")

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks, self.pattern = load_ranks(path), regex.compile(pattern)
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.held = 0

    def _remember(self, known: dict[str, bytes], word: str, ids: bytes) -> bytes:
        """``ids``, remembered unless the word is long. Every entry of both tables goes through here, whatever text it is from."""
        if len(word) <= LONG_WORD:
            self.held += ENTRY + len(word) + len(ids)
            if self.held > CACHE_BYTES:
                self.chunks.clear()
                self.words.clear()
                self.held = ENTRY
            known[word] = ids
        return ids

    def _split(self, text: str) -> bytes:
        out = []
        for w in self.pattern.findall(text):
            if (got := self.words.get(w)) is None:
                got = self._remember(self.words, w, np.array(merge_bytes(w.encode("utf-8", "surrogatepass"), self.ranks), "<i4").tobytes())
            out.append(got)
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if self.ODD.search(text):
            return self._split(text)
        first, *rest = text.split(" ")
        known, out = self.chunks, [self._split(first)]
        for w in rest:
            if (got := known.get(w)) is None:
                got = self._remember(known, w, self._split(" " + w))
            out.append(got)
        return b"".join(out)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, pattern) not in _ENCODERS:
            _ENCODERS[path, pattern] = Encoder(path, pattern)
        enc = _ENCODERS[path, pattern]
        for b in parts:
            ids = [enc.encode(t) for t in b.column(1).to_pylist()]
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
            yield pa.record_batch([b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def _pieces(ranks: dict[bytes, int]) -> Column:
    """The literal array of the pieces, by id."""
    by_id = [b""] * (max(ranks.values(), default=-1) + 1)
    for p, r in ranks.items():
        by_id[r] = p
    return F.from_json(F.lit(json.dumps([base64.b64encode(p).decode() for p in by_id])), "array<binary>")


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of an array of ids."""
    pieces = _pieces(ranks)
    # Strings here are bytes: nothing is validated before the cast back.
    return F.array_join(F.transform(ids, lambda i: F.get(pieces, i).cast("string")), "").cast("binary")


def rank_slots(ranks: dict[bytes, int]) -> list[int]:
    """A cuckoo table: each piece's rank is at one of two places that its hash names; -1 is free."""
    import xxhash

    size = 1 << max(4, (len(ranks) * 5 // 2).bit_length())
    slots: list[int] = [-1] * size
    by_rank = {r: p for p, r in ranks.items()}

    def places(p: bytes) -> tuple[int, int]:
        h = xxhash.xxh64_intdigest(p, 42)
        return h & (size - 1), (h >> 32) & (size - 1)

    for r in by_rank:
        at, held = places(by_rank[r])[0], r
        for _ in range(500):
            slots[at], held = held, slots[at]
            if held < 0:
                break
            a, b = places(by_rank[held])
            at = b if at == a else a
        else:
            raise ValueError("the rank table needs more room")
    return slots


def encode_words(words: DataFrame, column: str, ranks: dict[bytes, int]) -> DataFrame:
    """``words`` with the ids of ``column`` (distinct words that the pattern has split) in a column ``ids``. No Python runs."""
    slots = rank_slots(ranks)
    table_, pieces, mask = F.from_json(F.lit(json.dumps(slots)), "array<int>"), _pieces(ranks), len(slots) - 1

    def let(value: Column, use) -> Column:
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def rank(piece: Column) -> Column:
        def at(h: Column) -> Column:
            a, b = F.get(table_, h.bitwiseAND(mask).cast("int")), F.get(table_, F.shiftrightunsigned(h, 32).bitwiseAND(mask).cast("int"))
            return F.when((a >= 0) & (F.get(pieces, a) == piece), a).when((b >= 0) & (F.get(pieces, b) == piece), b)
        return let(F.xxhash64(piece), at)

    def step(state: Column, _: Column) -> Column:
        def merged(ranked: Column) -> Column:
            low = F.array_min(ranked)

            def join(k: Column) -> Column:
                pair = F.concat(F.get(state, k - 1), F.get(state, k))
                return F.concat(F.slice(state, F.lit(1), k - 1), F.array(pair), F.slice(state, k + 2, F.greatest(F.size(state), F.lit(1))))

            return F.when(low.isNull(), state).otherwise(let(F.array_position(ranked, low).cast("int"), join))

        pairs = F.transform(F.sequence(F.lit(0), F.size(state) - 2), lambda i: rank(F.concat(F.get(state, i), F.get(state, i + 1))))
        return F.when(F.size(state) < 2, state).otherwise(let(pairs, merged))

    raw = F.coalesce(F.col(column).cast("binary"), F.lit(b""))
    single = F.when(F.octet_length(raw) > 0, F.transform(F.sequence(F.lit(1), F.octet_length(raw)), lambda i: F.substring(raw, i, F.lit(1)))).otherwise(F.array().cast("array<binary>"))
    steps = F.sequence(F.lit(1), F.greatest(F.octet_length(raw), F.lit(1)))
    folded = F.aggregate(steps, single, step, lambda s: F.transform(s, rank))
    return words.withColumn("ids", F.when(rank(raw).isNotNull(), F.array(rank(raw))).otherwise(folded))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


def digests(docs: DataFrame) -> DataFrame:
    """Encode and decode ``docs`` with the multilingual byte vocabulary: doc_id, n_tokens and the two digests."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode(docs, path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), load_ranks(path)), 256).alias("decoded_sha256"))
