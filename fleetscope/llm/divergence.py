"""Source divergence audit by count cells.

A language's kept terms are those in at least ``min_docs`` of its documents. A group is a (lang, source) pair that occurs; every
group, and every language, gives each kept term a share p = 1 + floor(1e9 * (count + 5) / (N + 5 * V)). Two questions are answered:

* ``pair``: how far apart are two sources of one language, the sum of the absolute differences over all kept terms;
* ``term``: which terms does a source use more than its language does, by the difference.

Terms of one group that agree in (group count, language count) agree in their difference, so they form a cell. The difference is
evaluated once for each cell; cells of equal value are merged, ranked, and their multiplicities summed up until ``top`` terms are
reached; only the cells down to there are expanded into terms, in UTF-8 order.

A pair's sum starts from what it would be if no term occurred in either source, ``V`` times the difference of the two shares of a
count of 0, and adds a correction for each tile. A tile holds the counts of a bucket of terms for two blocks of at most
``BLOCK`` sources, so no tile and no task holds all terms of a source, all sources of a term or all pairs.

Counting is done inside the tasks that read the texts (at most ``HELD`` terms a time, and texts piece by piece), and counts, not
words, are shuffled, once, by (lang, term). Shares are integer divisions of decimals of 38 digits, everything else is 64-bit
integers: exact.

Defined cases: null text, lang and source count as empty; every row is a document, whether or not its doc_id is null or occurs
again; a language without kept terms has V = 0, pairs of value 0 and no terms; a source alone in its language has no pairs; equal
values rank by the item's UTF-8 bytes; texts of any length are read in pieces; an empty table gives no rows; only text, lang and
source are read, whatever other columns there are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import durable, table

#: Bytes that are no letter become a space, A-Z become a-z, bytes from 0x80 stay.
TERM_BYTES = bytes((b + 32) if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: Terms that a task holds before it hands them on.
HELD = 300_000
#: Bytes of a text that are split at a time.
PIECE = 1 << 20
#: Sources of one block of a tile, and count rows of one tile, about.
BLOCK, TILE_ROWS = 64, 200_000


def pieces(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a text, list by list; no term is cut."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            while end < len(text) and TERM_BYTES[text[end]] != 32:
                end += 1
        yield text[at:end].translate(TERM_BYTES).split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it); a group and term may have several rows, to be summed."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, seen) in held.items():
                terms = list(n)
                yield pa.record_batch([pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()),
                                       pa.array(n.values(), pa.int64()), pa.array(map(seen.__getitem__, terms), pa.int64())], schema=schema)
            held.clear()

        size = 0
        for b in parts:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                n, seen = held.setdefault((lang, source), (Counter(), Counter()))
                before, once = len(n), set()
                for words in pieces(text.as_py()):
                    n.update(words)
                    once.update(words)
                seen.update(once)
                size += len(n) - before
                if size > HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(count, "lang string, source string, term binary, n long, docs long").withColumn("term", F.col("term").cast("string"))


def share(n: str, total: str, kept: str) -> Column:
    """p of a count: 1 + floor(1e9 * (n + 5) / (total + 5 * kept)); null where there are no kept terms."""
    over = f"CAST({total} AS DECIMAL(19,0)) + 5 * CAST({kept} AS DECIMAL(18,0))"
    return F.expr(f"CASE WHEN {kept} > 0 THEN 1 + (CAST(1000000000 AS DECIMAL(10,0)) * (CAST({n} AS DECIMAL(19,0)) + 5)) div ({over}) END")


def kept_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """lang, source, term, n, lang_n (the term's count in its language), lead (one row of each lang and term) of every kept term."""
    one = Window.partitionBy("lang", "term")
    summed = (term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source")
              .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    return (summed.withColumns({"lang_docs": F.sum("docs").over(one), "lang_n": F.sum("n").over(one),
                                "lead": F.row_number().over(one.orderBy("source")) == 1})
            .filter(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "lead"))


def groups_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total (N), lang_total, v (V), zero (the share of a count of 0) and place (number of the source) of every group."""
    per_lang = kept.filter("lead").groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    per_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    there = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    joined = there.join(per_group, ["lang", "source"], "left").join(per_lang, "lang", "left").na.fill(0, ["total", "v", "lang_total"])
    place = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long")
    return joined.withColumn("zero", share("0", "total", "v")).withColumn("place", place)


def top_terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """lang, source, item, value, rank of the first ``top`` terms that a group has above its language."""
    cells = kept.groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("m"))
    above = (cells.join(groups, ["lang", "source"])
             .withColumn("value", share("n", "total", "v") - share("lang_n", "lang_total", "v")).filter("value > 0"))
    above = durable(above.select("lang", "source", "n", "lang_n", "m", "value"))
    merged = above.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # every value has a term at least, so the first ``top`` values hold all that can be ranked
    first = merged.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= top)
    before = F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("m")
    last = first.withColumn("before", before).filter(F.col("before") < top).groupBy("lang", "source").agg(F.min("value").alias("least"))
    chosen = above.join(last, ["lang", "source"]).filter("value >= least").select("lang", "source", "n", "lang_n", "value")
    terms = kept.join(chosen, ["lang", "source", "n", "lang_n"])
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    return terms.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "source", F.col("term").alias("item"), "value", "rank")


def _tile(places: np.ndarray, terms: np.ndarray, shares: np.ndarray, zero: dict[int, int]) -> Iterator[tuple[int, int, int]]:
    """(place, place, correction) of every two sources of a tile: differences of the shares less those of the shares of 0."""
    rows = {p: k for k, p in enumerate(sorted(zero))}
    base = np.array([zero[p] for p in sorted(zero)], np.int64)
    who, n_terms = np.array([rows[p] for p in places.tolist()], np.int64), int(terms.max()) + 1
    total = np.zeros((base.size, base.size), np.int64)
    order = np.argsort(terms, kind="stable")
    who, terms, shares = who[order], terms[order], shares[order]
    for a in range(0, n_terms, 4096):
        z = min(a + 4096, n_terms)
        lo, hi = np.searchsorted(terms, [a, z])
        p = np.repeat(base[:, None], z - a, axis=1)
        p[who[lo:hi], terms[lo:hi] - a] = shares[lo:hi]
        for k in range(base.size):
            total[k] += np.abs(p - p[k]).sum(axis=1)
    total -= n_terms * np.abs(base[:, None] - base)
    for a, x in enumerate(sorted(zero)):
        for b, y in enumerate(sorted(zero)):
            if a < b:
                yield x, y, int(total[a, b])


def pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value of every two sources of a language, both ways."""
    buckets = max(1, -(-kept.count() // TILE_ROWS))
    numbered = groups.withColumn("block", F.floor(F.col("place") / BLOCK))
    blocks = numbered.groupBy("lang").agg((F.max("block") + 1).alias("blocks"))
    # a tile is (lang, block, later or same block, bucket of terms); a count goes to every tile that its block is in
    facing = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    low, high = F.least("block", "facing").alias("low"), F.greatest("block", "facing").alias("high")
    known = numbered.join(blocks, "lang").withColumn("facing", facing)
    counts = kept.join(known, ["lang", "source"]).select(
        "lang", low, high, F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket"),
        F.col("place").alias("of"), "term", share("n", "total", "v").alias("p"))
    zeros = known.filter("v > 0").select("lang", low, high, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("bucket"), "place", "zero")
    zeros = zeros.toDF(*zeros.columns)  # columns of its own: both sides come from ``groups``
    schema = pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("more", pa.int64())])

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        lang, low, high = (right.column(c)[0].as_py() for c in ("lang", "low", "high"))
        zero = dict(zip(right.column("place").to_pylist(), right.column("zero").to_pylist(), strict=True))
        terms = left.column("term").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        got = [(x, y, v) for x, y, v in _tile(left.column("of").to_numpy(), terms, left.column("p").to_numpy(), zero)
               if low == high or x // BLOCK != y // BLOCK]
        a, b, more = zip(*got, strict=True) if got else ((), (), ())
        return pa.table([pa.array([lang] * len(a), pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(more, pa.int64())], schema=schema)

    key = ["lang", "low", "high", "bucket"]
    more = (counts.groupBy(*key).cogroup(zeros.groupBy(*key)).applyInArrow(tile, "lang string, a long, b long, more long")
            .groupBy("lang", "a", "b").agg(F.sum("more").alias("more")))
    one = numbered.select("lang", "source", "place", "zero", "v")
    two = numbered.select("lang", F.col("source").alias("item"), F.col("place").alias("other"), F.col("zero").alias("other_zero"))
    both = one.join(two, "lang").filter("place <> other").withColumns({"a": F.least("place", "other"), "b": F.greatest("place", "other")})
    base = F.col("v") * F.abs(F.col("zero") - F.col("other_zero"))
    return both.join(more, ["lang", "a", "b"], "left").select(
        "lang", "source", "item", (F.coalesce(base, F.lit(0)) + F.coalesce("more", F.lit(0))).cast("long").alias("value"))


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    kept = durable(kept_counts(docs, min_docs))
    groups = durable(groups_of(docs, kept))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(kept, groups).withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).select(*columns)
            .unionByName(top_terms(kept, groups, top).withColumn("part", F.lit("term")).select(*columns)))


def op13_count_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), w AS (
  SELECT r, lang, source, unnest(words) AS term FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS lang_n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 30
), v AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL
), n AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL
), p AS (
  SELECT n.lang, n.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (n.total + 5 * v.v) AS p, 1 + (1000000000 * (k.lang_n + 5)) // (v.lang_total + 5 * v.v) AS q
  FROM n JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = k.term
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), term AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q
), both_parts AS (SELECT * FROM pair UNION ALL SELECT * FROM term)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM both_parts
QUALIFY part = 'pair' OR rank <= 50
"""
