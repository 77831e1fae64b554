"""Token ids in bit-packed files with block offsets.

File layout, little-endian: ``MAGIC``; bits, ids per block, documents, ids as four unsigned 64-bit integers; then per document
its id (signed 64), a null flag (unsigned 8) and its number of ids (unsigned 32); then the byte offset of every block in the
payload (unsigned 64); then the payload. A block holds ``BLOCK_IDS`` ids of ``bits`` bits each, the fewest that fit the
vocabulary, lowest bit first. 64 ids fill exactly ``bits`` 64-bit words, so numpy packs and unpacks lane by lane, and a reader
can unpack any block alone.

Documents are encoded where they are read; their ids, compressed, are dealt out by ranges of doc_id, sorted and written: file after
file holds ascending doc_ids. A file's name carries the task attempt, and the manifest lists what the successful attempts wrote; a
lost executor's half-written files are never read. Rows of one doc_id, or of none, are spread over as many ranges as they fill.

Defined cases: a null or empty text has only the end id; a null doc_id sorts first; equal rows are all kept, and rows of one doc_id
stand in any order; a text of any length is encoded whole (its ids must fit 2 GB); an empty table gives no files and no rows; only doc_id
and text are read, whatever other columns there are.
"""

from __future__ import annotations

import os
from bisect import bisect_right
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import crc32, durable, shared_dir, table

MAGIC = b"FSTOKEN1"
BLOCK_IDS = 4096
#: Ids of one file, 16 MB at 16 bits.
FILE_IDS = 8_000_000
#: Ranges that the documents are dealt out to at most (a range writes as many files as it needs), and rows sampled for each.
MAX_RANGES, SAMPLED = 20_000, 60
#: Words that a worker remembers at most, about, and pieces of words besides.
CACHE_WORDS, CACHE_PIECES = 1_200_000, 300_000


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Fixed-width packing, lowest bit first, padded to 64 ids."""
    lanes = np.zeros((-(-ids.size // 64), 64), dtype=np.uint64)
    lanes.ravel()[:ids.size] = ids
    out = np.zeros((lanes.shape[0], bits), dtype="<u8")
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[:, word] |= lanes[:, j] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= lanes[:, j] >> np.uint64(64 - shift)
    return out.tobytes()


def unpack_ids(data: bytes, n: int, bits: int) -> np.ndarray:
    words = np.frombuffer(data, "<u8").reshape(-1, bits)
    out = np.empty((words.shape[0], 64), dtype=np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        lane = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            lane = lane | words[:, word + 1] << np.uint64(64 - shift)
        out[:, j] = lane & mask
    return out.ravel()[:n].astype("<u4")


def file_bytes(docs: list[tuple[int | None, np.ndarray]], bits: int) -> bytes:
    """A whole file of (doc_id, ids)."""
    ids = np.concatenate([x for _, x in docs]) if docs else np.zeros(0, "<u4")
    blocks = [pack_ids(ids[k:k + BLOCK_IDS], bits) for k in range(0, ids.size, BLOCK_IDS)]
    return b"".join([
        MAGIC, np.array([bits, BLOCK_IDS, len(docs), ids.size], "<u8").tobytes(),
        np.array([i or 0 for i, _ in docs], "<i8").tobytes(), np.array([i is None for i, _ in docs], "u1").tobytes(),
        np.array([x.size for _, x in docs], "<u4").tobytes(),
        np.cumsum([0, *map(len, blocks)]).astype("<u8").tobytes(), *blocks])


class TokenFile:
    """Random access to a file's ids, block by block."""

    def __init__(self, source):
        self.source = source
        if (got := self._at(0, 8)) != MAGIC:
            raise ValueError(f"not a token file: {got!r}")
        self.bits, self.block, docs, self.size = map(int, np.frombuffer(self._at(8, 32), "<u8"))
        at = 40
        ids, null, lens = self._at(at, 8 * docs), self._at(at + 8 * docs, docs), self._at(at + 9 * docs, 4 * docs)
        self.doc_ids = [None if z else i for i, z in zip(np.frombuffer(ids, "<i8").tolist(), null, strict=True)]
        self.lens = np.frombuffer(lens, "<u4").astype(np.int64)
        blocks = -(-self.size // self.block)
        self.offsets = np.frombuffer(self._at(at + 13 * docs, 8 * (blocks + 1)), "<u8").astype(np.int64)
        self.base = at + 13 * docs + 8 * (blocks + 1)

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of this file; reads only the blocks that hold them."""
        if start >= stop:
            return np.zeros(0, "<u4")
        a, b = start // self.block, -(-stop // self.block)
        raw = self._at(self.base + int(self.offsets[a]), int(self.offsets[b] - self.offsets[a]))
        there = min(b * self.block, self.size) - a * self.block
        # whole blocks are whole groups of 64 ids, so several unpack at once
        return unpack_ids(raw, there, self.bits)[start - a * self.block:stop - a * self.block]


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _latin_1(text: str) -> bool:
    """Whether every character is below U+0100: its lower case is one character of its own, wherever it stands, and NFC as it is."""
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


class _Words(dict):
    """Ids of words; a word that is not there yet is asked for once."""

    def __init__(self, ask):
        super().__init__({"": b""})
        self.ask = ask

    def __missing__(self, word: str) -> bytes:
        got = self[word] = self.ask(word)
        return got


class WordEncoder:
    """Whole texts by a tokenizers file, word for word.

    A text is cut at spaces and line feeds. The tokenizer's own splitting never joins what white space parts (the constructor
    holds it to that for the file in use), so the ids of a text are those of its words, and a word is encoded once while it is
    remembered. Words of printable Latin characters are cut by the file's own pattern and go to the model directly. A text of
    printable Latin-1 is put in lower case as a whole, and its words are encoded where they are met.

    The strings of added tokens (``<|endoftext|>``) in a text are ordinary text, or, with ``added_as_text`` False, the tokens they
    name, as the library has them by default; a text that holds one is then encoded whole by the library.

    Two generations are remembered: words met since the last change, and those of the time before, so that frequent words stay.
    """

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: Characters below it have no combining marks, so they are as NFC has them; dotted capital I and the marks are left out.
    LATIN = "\u0250"

    def __init__(self, path: str, added_as_text: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = added_as_text
        added = [] if added_as_text else list(self.tok.get_added_tokens_decoder().values())
        if any(t.normalized for t in added):
            raise ValueError(f"{path} looks for added tokens in the normalised text")
        self.added = [t.content for t in added]
        self.mark = os.path.commonprefix(self.added)
        self.pieces = regex.compile(self.PATTERN)
        self.letters = _byte_letters()
        self.young = _Words(self._plain_word)
        self.old: dict[str, bytes] = {}
        self.by_piece: dict[str, bytes] = {}
        self.wide, self.code = ("<u2", "H") if self.tok.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        sample = "It's a Test,\n with 12 (odd) wörds' ÉTÉ &&& don't!! A.B ñ%%% ¿x? straße.²"
        self.direct = all(self._whole(w) == self._pieces(w) for w in sample.split())
        if self._whole(sample) != b"".join(map(self._whole, sample.split())):
            raise ValueError(f"{path} joins words across white space")

    def _raw(self, ids: list[int]) -> bytes:
        return pack(f"<{len(ids)}{self.code}", *ids)

    def _whole(self, text: str) -> bytes:
        return self._raw(self.tok.encode(text, add_special_tokens=False).ids)

    def _pieces(self, word: str) -> bytes:
        out = []
        for p in self.pieces.findall(word.lower()):
            if (got := self.by_piece.get(p)) is None:
                got = self.by_piece[p] = self._model(p)
            out.append(got)
        return b"".join(out)

    def _model(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return self._raw([x.id for x in self.tok.model.tokenize(shown)])

    def _plain_word(self, word: str) -> bytes:
        """Ids of a word of printable Latin-1 in lower case: letters are one piece, and so is one other character after them."""
        if (got := self.old.get(word)) is not None:
            return got
        if word.isalpha():
            return self._model(word)
        if word[:-1].isalpha():
            return self.young[word[:-1]] + self.young[word[-1]]
        return self._pieces(word)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian integers of ``wide``."""
        if self.added:
            whole = {k: self._whole(t) for k, t in enumerate(texts) if t and self.mark in t and any(a in t for a in self.added)}
            if whole:
                rest = iter(self._by_words([t for k, t in enumerate(texts) if k not in whole]))
                return [whole[k] if k in whole else next(rest) for k in range(len(texts))]
        return self._by_words(texts)

    def _by_words(self, texts: list[str | None]) -> list[bytes]:
        if len(self.young) > CACHE_WORDS // 2:
            self.old, self.young = self.young, _Words(self._plain_word)
        if len(self.by_piece) > CACHE_PIECES:
            self.by_piece = {}
        flat = [(t or "").replace("\n", " ") for t in texts]
        # other texts keep their case: in a word that the library encodes, lower case might name an added token
        plain = [self.direct and t.isprintable() and _latin_1(t) for t in flat]
        self._learn({w for t, p in zip(flat, plain, strict=True) if not p for w in t.split(" ")})
        ids = self.young.__getitem__
        return [b"".join(map(ids, (t.lower() if p else t).split(" "))) for t, p in zip(flat, plain, strict=True)]

    def _learn(self, words: set[str]) -> None:
        """Remember the ids of ``words``, those that only the library can encode many at a time."""
        known, old, late = self.young, self.old, []
        for w in words.difference(known):
            if (got := old.get(w)) is not None:
                known[w] = got
            elif self.direct and max(w) < self.LATIN and w.isprintable() and "\u0130" not in w:
                known[w] = self._pieces(w)
            else:
                late.append(w)
        for k in range(0, len(late), 2000):
            part = late[k:k + 2000]
            for w, e in zip(part, self.tok.encode_batch_fast(part, add_special_tokens=False), strict=True):
                known[w] = self._raw(e.ids)


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def _encoder(path: str, added_as_text: bool = True) -> WordEncoder:
    if (path, added_as_text) not in _ENCODERS:
        _ENCODERS[path, added_as_text] = WordEncoder(path, added_as_text)
    return _ENCODERS[path, added_as_text]


def _open_fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _bounds(docs: DataFrame, ranges: int) -> list[tuple]:
    """Up to ``ranges`` - 1 places (known, doc_id, salt) that part the rows evenly, from a sample of ``SAMPLED`` rows a range."""
    if ranges < 2:
        return []
    few = docs.select("known", "doc_id", "salt").sample(fraction=min(1.0, SAMPLED * ranges / max(1, docs.count())), seed=3).toArrow().to_pydict()
    places = sorted(zip(few["known"], few["doc_id"], few["salt"], strict=True))
    return [places[k * len(places) // ranges] for k in range(1, ranges)] if places else []


def write_files(docs: DataFrame, folder: str, path: str, end_id: int | None, vocab_size: int, file_ids: int = FILE_IDS,
                added_as_text: bool = True) -> DataFrame:
    """Encode ``docs`` and write the files in ascending doc_id order; the manifest: name, part, k, n_docs, n_tokens, start (ids in
    files before).

    Texts are encoded where they are read; what is dealt out to the ranges is their ids, compressed.
    """
    bits = max(1, (vocab_size - 1).bit_length())
    # rows of one doc_id, or of none, may fall to several ranges: the salt tells them apart and is the same on every run
    docs = docs.select(F.col("doc_id").isNotNull().alias("known"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
                       F.xxhash64(F.monotonically_increasing_id()).alias("salt"), F.col("text").cast("string").alias("text"))
    # a text has at most a handful of ids for every four bytes, so a range of this many bytes is about half a file
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, min(MAX_RANGES, -(-size // (2 * file_ids))))
    bounds = _bounds(docs, ranges)
    coded = pa.schema([("part", pa.int32()), ("known", pa.bool_()), ("doc_id", pa.int64()), ("salt", pa.int64()), ("n", pa.int32()), ("ids", pa.binary())])
    schema = pa.schema([("name", pa.string()), ("part", pa.int32()), ("k", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, zstd = _encoder(path, added_as_text), pa.Codec("zstd", 1)
        end = enc._raw([end_id]) if end_id is not None else b""
        for whole in parts:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                known, ids, salt = (b.column(c).to_pylist() for c in range(3))
                raw = [x + end for x in enc.encode(b.column(3).to_pylist())]
                where = [bisect_right(bounds, p) for p in zip(known, ids, salt, strict=True)] if bounds else [0] * len(raw)
                yield pa.record_batch([
                    pa.array(where, pa.int32()), b.column(0), b.column(1), b.column(2), pa.array([len(x) for x in raw], pa.int32()),
                    pa.array([zstd.compress(x, asbytes=True) for x in raw], pa.binary())], schema=coded)

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, fs_root, made, wide, zstd = TaskContext.get(), None, 0, _encoder(path, added_as_text).wide, pa.Codec("zstd", 1)
        held: list[tuple[int | None, np.ndarray]] = []
        n = part = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, n, made, fs_root
            if fs_root is None:
                fs_root = _open_fs(folder)
                fs_root[0].create_dir(fs_root[1], recursive=True)
            name = f"ids-{part:06d}-{made:04d}-{task.taskAttemptId()}.bin"
            with fs_root[0].open_output_stream(f"{fs_root[1]}/{name}") as out:
                out.write(file_bytes(held, bits))
            row = {"name": name, "part": part, "k": made, "n_docs": len(held), "n_tokens": n}
            held, n, made = [], 0, made + 1
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for b in parts:
            for p, known, i, size, raw in zip(*(b.column(c).to_pylist() for c in ("part", "known", "doc_id", "n", "ids")), strict=True):
                ids = np.frombuffer(zstd.decompress(raw, size, asbytes=True), wide)
                if held and (n + ids.size > file_ids or p != part):
                    yield flush()
                if p != part:
                    part, made = p, 0
                held.append((i if known else None, ids))
                n += ids.size
        if held:
            yield flush()

    dealt = (docs.mapInArrow(encode, "part int, known boolean, doc_id long, salt long, n int, ids binary")
             .repartitionById(ranges, F.col("part")).sortWithinPartitions("part", "known", "doc_id", "salt"))
    done = durable(dealt.mapInArrow(write, "name string, part int, k int, n_docs long, n_tokens long"))
    # A row per file, not per document: the running total is over the manifest only.
    before = F.sum("n_tokens").over(Window.orderBy("part", "k").rowsBetween(Window.unboundedPreceding, -1))
    return durable(done.withColumn("start", F.coalesce(before, F.lit(0))))


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open_fs(folder)
        for b in parts:
            for row in b.to_pylist():
                with fs.open_input_file(f"{root}/{row['name']}") as source:
                    f = TokenFile(source)
                    ends = np.cumsum(f.lens)
                    first = 0
                    while first < len(f.doc_ids):  # as many documents at a time as a million ids hold
                        at = int(ends[first] - f.lens[first])
                        last = max(first + 1, int(np.searchsorted(ends, at + 1_000_000, "right")))
                        ids = f.ids(at, int(ends[last - 1]))
                        cut = (ends[first:last] - at).tolist()
                        crcs = [crc32(ids[a:z].tobytes()) for a, z in zip([0, *cut], cut, strict=False)]
                        yield pa.record_batch([
                            pa.array(f.doc_ids[first:last], pa.int64()), pa.array(row["start"] + ends[first:last] - f.lens[first:last], pa.int64()),
                            pa.array(f.lens[first:last], pa.int64()), pa.array(crcs, pa.int64())], schema=schema)
                        first = last

    return manifest.select("name", "start").repartition(max(1, min(10_000, manifest.count()))).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str, end_id: int | None, vocab_size: int, added_as_text: bool = True) -> tuple[DataFrame, str]:
    """Encode ``docs`` and write the files to a new shared folder: their manifest and the folder."""
    folder = shared_dir(docs.sparkSession)
    return write_files(docs, folder, path, end_id, vocab_size, added_as_text=added_as_text), folder


def op4_bit_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    manifest, folder = token_files(table(spark, sf_dir, "documents"), path, 1, 49408, added_as_text=False)
    return read_files(manifest, folder)
