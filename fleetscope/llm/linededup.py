"""Substring dedup by hashing the units of a text.

The units are lines, and long lines are cut further by their content: a unit ends with its line, after a word that its digest and that
of the word before name an end (one in ``CUT``, whatever stands around them), or after ``UNIT_WORDS`` words. So the units of a passage
are the same wherever it is put in, but for a part of a unit at either end. Words are what white space and the marks of unspaced scripts part. A unit is
normalised (its words in lower case, A-Z, without marks at their ends, joined by a space) and hashed to 63 bits. Over all documents
the earliest occurrence of a digest, by (doc_id, digest of the whole text, unit number), is kept.

What is removed are runs of later occurrences, one unit after the other, that have ``MIN_WORDS`` words or ``MIN_BYTES`` bytes together:
of a passage that repeats nothing stays but the few words at either end, and phrases and lines that are merely common stay where
they are. No unit's earliest occurrence is ever removed. A unit takes what parts it from the next one along. Removed and kept spans
are offsets in code points of the original.

Each task remembers the earliest occurrence of up to ``HELD`` digests, so that an occurrence after it is known to be a later one on the
spot; of a digest that a third of the documents hold, one row a task goes on to be compared over all, by one shuffle of numbers. Only
documents with removed runs are cut again, to turn unit numbers into offsets.

Defined cases: a null text stays null and has no units, an empty one stays empty; a null doc_id ranks first; rows equal in doc_id
and text are the same document, whose units are kept or removed alike; a word of any length is one word, and a text of any length is
taken whole; an empty table gives no rows; only doc_id and text are read by ``find`` and ``clean`` keeps all columns of its input,
whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import md5

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, table

# White space, marks that part words where no spaces are written, and marks that are no part of a word's end.
SPACE, UNSPACED, MARKS = " \t\v\f\r", "。！？、，；：", b".!?,;:"
#: One word in this many ends a unit, and words of a unit at most.
CUT, UNIT_WORDS = 6, 24
#: What a run of repeated units has to have to be removed: this many words, or this many bytes once normalised. A passage of 51 words
#: loses the words before its first and after its last end, 10 on average; more than 26 in 5 of 100, of 62 words more than 37 in 1.
MIN_WORDS, MIN_BYTES = 25, 300
#: Digests (and documents) that a task remembers before it hands them on.
HELD = 400_000

TOKEN = re.compile(rf"[^{SPACE}{UNSPACED}\n]+|\n")


class Words(dict):
    """Of a word in lower case: its normal form, and 32 bits of its digest."""

    def __missing__(self, word: bytes) -> tuple[bytes, int]:
        if len(self) > 1_000_000:
            self.clear()
        plain = word.strip(MARKS)
        self[word] = got = plain, int.from_bytes(md5(plain).digest()[:4], "big")
        return got


WORDS = Words()


def units_of(text: str) -> Iterator[list[bytes]]:
    """The normalised words of every unit."""
    for mark in UNSPACED:
        if mark in text:
            text = text.replace(mark, " ")
    for line in text.encode("utf-8", "surrogatepass").lower().split(b"\n"):
        unit, before = [], 0
        for word in line.split():
            plain, here = WORDS[word]
            unit.append(plain)
            if (before + here) % CUT == 0 or len(unit) == UNIT_WORDS:
                yield unit
                unit = []
            before = here
        if unit:
            yield unit


def starts_of(text: str) -> list[int]:
    """Where each unit starts in the text; a unit goes on to the start of the next one."""
    out, held, before = [], 0, 0
    for m in TOKEN.finditer(text):
        token = m.group()
        if token == "\n":
            held = before = 0
            continue
        if not held:
            out.append(m.start())
        held, here = held + 1, WORDS[token.encode("utf-8", "surrogatepass").lower()][1]
        if held == UNIT_WORDS or (before + here) % CUT == 0:
            held = 0
        before = here
    return out


def doc_digest(text: Column) -> Column:
    """60 bits of the text's md5, null for a null text."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def units(docs: DataFrame) -> DataFrame:
    """doc_id, doc (digest of the text), at (the unit's number * 2^25 + its words * 2^20 + its bytes), and key of every unit.

    Units with an odd key are known to be later occurrences; the others of a digest share its key, one for each task that meets it.
    """
    import xxhash

    schema = pa.schema([("doc_id", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("key", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[int, tuple] = {}
        seen: set[tuple] = set()
        late: list[tuple] = []

        def out(rows: list[tuple], keys: list[int]) -> pa.RecordBatch:
            known, ids, doc, at = zip(*rows, strict=True) if rows else ((), (), (), ())
            return pa.record_batch([
                pa.array([i if k else None for k, i in zip(known, ids, strict=True)], pa.int64()), pa.array(doc, pa.int64()), pa.array(at, pa.int64()),
                pa.array(keys, pa.int64())], schema=schema)

        def spread(rows: list[tuple]) -> list[int]:
            return [(doc + 0x9E3779B97F4A7C15 * at) % (1 << 64) - (1 << 63) | 1 for _, _, doc, at in rows]

        for b in parts:
            for i, doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                known, number = (False, 0) if i is None else (True, i), 0
                if (*known, doc) in seen:
                    continue  # the same document once more
                seen.add((*known, doc))
                for words in units_of(text.as_py()):
                    plain = b" ".join(words)
                    here = (*known, doc, number << 25 | len(words) << 20 | min(len(plain), (1 << 20) - 1))
                    number += 1
                    digest = xxhash.xxh3_64_intdigest(plain) - (1 << 63) & -2
                    there = first.setdefault(digest, here)
                    if there < here:
                        late.append(here)
                    elif there > here:
                        first[digest] = here
                        late.append(there)
                if len(late) > 50_000:
                    yield out(late, spread(late))
                    late = []
                if len(first) + len(seen) > HELD:
                    yield out(list(first.values()), list(first))
                    first, seen = {}, set()
        yield out(late, spread(late))
        yield out(list(first.values()), list(first))

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_digest(text).alias("doc"), text.alias("text")).filter("text IS NOT NULL")
    return rows.mapInArrow(run, "doc_id long, doc long, at long, key long")


def find(docs: DataFrame, min_words: int = MIN_WORDS, min_bytes: int = MIN_BYTES) -> DataFrame:
    """doc_id, doc and runs (first and last unit, in ascending order) of every document that loses any."""
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "doc", "at")
    first = F.min(order).over(Window.partitionBy("key"))
    later = units(docs).withColumn("order", order).withColumn("first", first).filter(
        (F.col("key").bitwiseAND(1) == 1) | (F.col("order") > F.col("first")))
    # a document that several tasks met is once in each, so its rows stay few; one shuffle serves all that follows
    once = later.select("doc_id", "doc", "at").repartition("doc_id", "doc").groupBy("doc_id", "doc", "at").agg(F.count(F.lit(1)).alias("times"))
    unit, words, size = F.shiftright("at", 25), F.shiftright("at", 20).bitwiseAND(31), F.col("at").bitwiseAND((1 << 20) - 1)
    in_doc = Window.partitionBy("doc_id", "doc").orderBy("at")
    runs = (once.withColumn("run", unit - F.row_number().over(in_doc)).groupBy("doc_id", "doc", "run")
            .agg(F.min(unit).alias("first"), F.max(unit).alias("last"), F.sum(words).alias("words"), F.sum(size).alias("bytes"))
            .filter((F.col("words") >= min_words) | (F.col("bytes") >= min_bytes)))
    return runs.groupBy("doc_id", "doc").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))


def cut(text: str, runs: list[tuple[int, int]]) -> tuple[str, int, list[tuple[int, int]], list[tuple[int, int]]]:
    """What stays of the text, the units removed, and the removed and the kept spans."""
    starts = [*starts_of(text), len(text)]
    removed = [(starts[a], starts[z + 1]) for a, z in runs]
    edges = [0, *(x for span in removed for x in span), len(text)]
    kept = [(a, z) for a, z in zip(edges[::2], edges[1::2], strict=True) if z > a]
    return "".join(text[a:z] for a, z in kept), sum(z - a + 1 for a, z in runs), removed, kept


def clean(docs: DataFrame, min_words: int = MIN_WORDS, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``docs`` with the cleaned text, and a struct ``dedup``: n_removed (units), removed and kept (start and end of each span).

    The struct's name gives way (``dedup_``, ...) if the input has a column of that name already.
    """
    key, digest, runs, out = (free_name(docs, n) for n in ("row_doc", "row_digest", "runs", "dedup"))
    whole = docs.withColumn("text", F.col("text").cast("string"))
    found = find(docs, min_words, min_bytes).toDF(key, digest, runs)
    joined = whole.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col(key)) & (doc_digest(F.col("text")) == F.col(digest)), "left")
    joined = joined.select(*(F.col(f"`{c}`") for c in docs.columns), runs)
    place, n = docs.columns.index("text"), len(docs.columns)
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    report = T.StructType([T.StructField("n_removed", T.LongType()), T.StructField("removed", span), T.StructField("kept", span)])
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kind = pa.struct([("n_removed", pa.int64()), ("removed", spans), ("kept", spans)])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(xs: list[tuple[int, int]]) -> list[dict]:
            return [{"start": a, "end": z} for a, z in xs]

        for b in parts:
            texts, rows = b.column(place).to_pylist(), []
            for k, (text, gone) in enumerate(zip(texts, b.column(n).to_pylist(), strict=True)):
                if gone:
                    texts[k], units_gone, removed, kept = cut(text, [(g["first"], g["last"]) for g in gone])
                else:
                    units_gone, removed, kept = 0, [], [(0, len(text))] if text else []
                rows.append({"n_removed": units_gone, "removed": pairs(removed), "kept": pairs(kept)})
            columns = [*b.columns[:place], pa.array(texts, pa.string()), *b.columns[place + 1:n], pa.array(rows, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names[:n], out])

    return joined.mapInArrow(run, T.StructType([*whole.schema.fields, T.StructField(out, report)]))


def op9_line_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.transform("dedup.removed", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string")))
    return clean(docs).select("doc_id", F.col("dedup.n_removed").alias("n_removed"), F.array_join(spans, ",").alias("removed_spans"), "text")


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, text, ('0x' || substr(md5(text), 1, 15))::BIGINT AS m FROM documents
), t AS (
  SELECT r, doc_id, m, unnest(tokens) AS token, unnest(range(len(tokens))) AS k
  FROM (SELECT r, doc_id, m, regexp_extract_all(text,
    '[^\n。！？、，；：\x20\x09\x0B-\x0D]+[\n。！？、，；：\x20\x09\x0B-\x0D]*|[\n。！？、，；：\x20\x09\x0B-\x0D]+') AS tokens FROM d)
), w AS (
  SELECT *, (sum(length(token)) OVER (PARTITION BY r ORDER BY k))::BIGINT AS stop,
    translate(regexp_replace(token, '[\n。！？、，；：\x20\x09\x0B-\x0D]+', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word FROM t
), e AS (
  SELECT *, trim(word, '.!?,;:') AS plain, ('0x' || substr(md5(trim(word, '.!?,;:')), 1, 8))::BIGINT AS h, contains(token, chr(10)) AS line FROM w WHERE word <> ''
), b AS (
  SELECT *, CASE WHEN lag(line) OVER (PARTITION BY r ORDER BY k) THEN 0 ELSE coalesce(lag(h) OVER (PARTITION BY r ORDER BY k), 0) END AS before FROM e
), s AS (
  SELECT *, sum(ends) OVER (PARTITION BY r ORDER BY k) - ends AS seg FROM (SELECT *, CASE WHEN line OR (h + before) % 6 = 0 THEN 1 ELSE 0 END AS ends FROM b)
), c AS (
  SELECT *, (row_number() OVER (PARTITION BY r, seg ORDER BY k) - 1) // 24 AS part FROM s
), u AS (
  SELECT r, doc_id, m, row_number() OVER (PARTITION BY r ORDER BY seg, part) AS unit, string_agg(plain, ' ' ORDER BY k) AS plain, count(*) AS words,
    min(stop - length(token)) AS start, max(stop) AS stop
  FROM c GROUP BY r, doc_id, m, seg, part
), o AS (
  SELECT *, (CASE WHEN doc_id IS NULL THEN 0 ELSE 1 END, coalesce(doc_id, 0), m, unit) AS place FROM u
), f AS (
  SELECT plain, min(place) AS first FROM o GROUP BY 1
), later AS (
  SELECT o.*, unit - row_number() OVER (PARTITION BY r ORDER BY unit) AS run FROM o JOIN f USING (plain) WHERE place > first
), runs AS (
  SELECT r, run, min(start) AS start, max(stop) AS stop, count(*) AS n FROM later GROUP BY r, run
  HAVING sum(words) >= 25 OR sum(strlen(plain)) >= 300
), removed AS (
  SELECT r, sum(n)::BIGINT AS n_removed, list((start, stop) ORDER BY start) AS spans, string_agg(start || '-' || stop, ',' ORDER BY start) AS shown FROM runs GROUP BY r
), kept AS (
  SELECT r, string_agg(token, '' ORDER BY k) AS text FROM (
    SELECT w.r, w.k, w.token FROM w WHERE NOT EXISTS (SELECT 1 FROM runs WHERE runs.r = w.r AND w.stop > runs.start AND w.stop <= runs.stop)) GROUP BY r
)
SELECT d.doc_id, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(shown, '') AS removed_spans,
  CASE WHEN d.text IS NULL THEN NULL WHEN removed.r IS NULL THEN d.text ELSE coalesce(kept.text, '') END AS text
FROM d LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)
"""
