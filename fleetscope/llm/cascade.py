"""Quality rules as a short-circuit cascade.

A rule is a condition on a text that rejects it. What each rule costs and which texts it rejects is measured on a sample (some
``SAMPLE`` rows, drawn over the whole table): the tasks that hold the sample time every rule on every text of it. The order is
greedy: next comes the rule that rejects the most of the sample's texts still left for its seconds a text; rules that reject none
of them come last, cheapest first. A text then meets the rules in this order until one rejects it. The order changes the cost, never
a verdict, so the sample bounds no result.

Words are runs of characters other than space and \\t to \\r; lines are what line feeds part. Rules compare whole numbers only. What
a rule needs of a text (words, lines, windows) is made when the first rule asks for it, and kept for the next.

Defined cases: a null text counts as the empty text, which has no words and no lines with words; a text of any length is taken whole
(memory is a small multiple of the longest one); equal rows get equal verdicts; without rules all texts are kept; an empty table
gives no rows, and its order is the given one; ``measure`` and ``verdicts`` read the text only and ``verdicts`` keeps all columns of
its input, whatever their names.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, table

#: Rows of the sample, about.
SAMPLE = 2000
SPACE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
# Fixed values, the thresholds of the rules: shares are in per cent.
MIN_WORDS, MAX_WORDS = 50, 100_000
REPEATED, SYMBOL_SHARE, DOUBLE_LINES, LETTERED, CAPITALS, BULLETS, TRAILING = 50, 10, 50, 80, 30, 90, 30
SHORT_WORD, LONG_WORD = 3, 10
# The start of a word with a letter (A-Z, a-z or any character from U+0080), and a word without a-z; both are matched from the
# word's start only, so that a word of a million characters takes one pass.
LETTER_WORD = re.compile(rf"(?<![^{SPACE}])[^{SPACE}A-Za-z\u0080-\U0010ffff]*[A-Za-z\u0080-\U0010ffff]")
UNLOWERED_WORD = re.compile(rf"(?<![^{SPACE}])[^{SPACE}a-z]{{2,}}(?![^{SPACE}])")
CAPITAL = re.compile("[A-Z]")


class Text:
    """A text and what the rules ask of it, each made once."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACE))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        """The lines with a word."""
        return [x for x in self.text.split("\n") if x.strip(SPACE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in 3-word windows that occur twice or more."""
        n = self.n_words
        if n < 4:
            return 0
        numbers: dict[bytes, int] = {}
        w = np.fromiter((numbers.setdefault(x, len(numbers)) for x in self.words), np.int64, n)
        pair = w[:-1] * len(numbers) + w[1:]
        if len(numbers) >= 1 << 20:  # keeps the next product within 64 bits
            pair = np.unique(pair, return_inverse=True)[1]
        _, window, times = np.unique(pair[:-1] * len(numbers) + w[2:], return_inverse=True, return_counts=True)
        again = times[window] > 1
        inside = np.zeros(n, bool)
        for k in range(3):
            inside[k:n - 2 + k] |= again
        return int(inside.sum())

    @cached_property
    def n_letter_words(self) -> int:
        return sum(1 for _ in LETTER_WORD.finditer(self.text))

    @cached_property
    def n_capital_words(self) -> int:
        """Words with two of A-Z or more and none of a-z."""
        return sum(len(CAPITAL.findall(w)) > 1 for w in UNLOWERED_WORD.findall(self.text))

    @cached_property
    def n_bullets(self) -> int:
        return sum(x.lstrip(SPACE).startswith(("-", "*", "•")) for x in self.lines)

    @cached_property
    def n_trailing(self) -> int:
        return sum(x.rstrip(SPACE).endswith(("...", "…")) for x in self.lines)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


RULES = (
    Rule("few_words", lambda t: t.n_words < MIN_WORDS),
    Rule("many_words", lambda t: t.n_words > MAX_WORDS),
    Rule("repeated_words", lambda t: 100 * t.n_repeat_words > REPEATED * t.n_words),
    Rule("short_words", lambda t: t.word_chars < SHORT_WORD * t.n_words),
    Rule("long_words", lambda t: t.word_chars > LONG_WORD * t.n_words),
    Rule("symbols", lambda t: 100 * t.n_symbols > SYMBOL_SHARE * t.n_words),
    Rule("double_lines", lambda t: 100 * t.n_dup_lines > DOUBLE_LINES * len(t.lines)),
    Rule("letterless", lambda t: 100 * t.n_letter_words < LETTERED * t.n_words),
    Rule("capitals", lambda t: 100 * t.n_capital_words > CAPITALS * t.n_words),
    Rule("bullets", lambda t: 100 * t.n_bullets > BULLETS * len(t.lines)),
    Rule("trailing_off", lambda t: 100 * t.n_trailing > TRAILING * len(t.lines)),
)


def measure(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> list[tuple[int, int, list[float]]]:
    """(bits of the rules that reject, texts, seconds of each rule) for every set of rules that some texts of the sample are rejected by."""
    n, rules = docs.count(), list(rules)
    schema = pa.schema([("bits", pa.int64()), ("seconds", pa.list_(pa.float64()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            bits, seconds = [], []
            for text in b.column(0).to_pylist():
                found, took = 0, []
                for k, rule in enumerate(rules):
                    fresh, start = Text(text), time.perf_counter()  # nothing that another rule has made
                    found |= bool(rule.rejects(fresh)) << k
                    took.append(time.perf_counter() - start)
                bits.append(found)
                seconds.append(took)
            yield pa.record_batch([pa.array(bits, pa.int64()), pa.array(seconds, pa.list_(pa.float64()))], schema=schema)

    if not n or not rules:
        return []
    drawn = docs.select(F.col("text").cast("string")).sample(fraction=min(1.0, sample / n), seed=7)
    got = drawn.mapInArrow(run, "bits long, seconds array<double>").groupBy("bits").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.get("seconds", F.lit(k))).alias(f"s{k}") for k in range(len(rules))))
    return [(r["bits"], r["n"], [r[f"s{k}"] for k in range(len(rules))]) for r in got.collect()]


def ordered(rules: Sequence[Rule], measured: list[tuple[int, int, list[float]]]) -> list[Rule]:
    """The rules by rejection per cost among the texts that those before leave."""
    left, out, rest = [(bits, n) for bits, n, _ in measured], [], list(range(len(rules)))
    texts = sum(n for _, n, _ in measured)
    cost = [max(sum(s[k] for _, _, s in measured), 1e-9) / max(texts, 1) for k in rest]
    while rest:
        hits = {k: sum(n for bits, n in left if bits >> k & 1) for k in rest}
        if any(hits.values()):
            best = max(rest, key=lambda k: (hits[k] / cost[k], -k))
        else:
            best = min(rest, key=lambda k: (cost[k], k)) if measured else rest[0]
        rest.remove(best)
        out.append(rules[best])
        left = [(bits, n) for bits, n in left if not bits >> best & 1]
    return out


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def verdicts(docs: DataFrame, rules: Sequence[Rule], counts: Sequence[str] = ()) -> DataFrame:
    """``docs`` with a struct ``rules``: rejected_by (name of the first rule, in the order given, that rejects the text, or null),
    met (rules that the text met) and, for every text, the ``counts`` asked for.

    The struct's name gives way (``rules_``, ...) if the input has a column of that name already.
    """
    rules, counts, out = list(rules), list(counts), free_name(docs, "rules")
    text, result = docs.columns.index("text"), T.StructType([T.StructField("rejected_by", T.StringType()), T.StructField("met", T.IntegerType())])
    for c in counts:
        result = result.add(c, T.LongType())
    kind = pa.struct([("rejected_by", pa.string()), ("met", pa.int32()), *((c, pa.int64()) for c in counts)])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            found = []
            for value in b.column(text):
                t, row = Text(value.as_py()), {"rejected_by": None, "met": 0}
                for rule in rules:
                    row["met"] += 1
                    if rule.rejects(t):
                        row["rejected_by"] = rule.name
                        break
                found.append(row | {c: getattr(t, c) for c in counts})
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, kind)], names=[*b.schema.names, out])

    whole = docs.withColumn("text", F.col("text").cast("string"))
    return whole.mapInArrow(run, T.StructType([*whole.schema.fields, T.StructField(out, result)]))


def op12_short_circuit_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    order = ordered(RULES, measure(docs))
    # the base columns are asked for of every text; the verdict is the cascade's
    judged = verdicts(docs, order, COUNTS)
    base = f"rules.n_words < {MIN_WORDS} OR 100 * rules.n_repeat_words > {REPEATED} * rules.n_words"
    return judged.select("doc_id", *(F.col(f"rules.{c}") for c in COUNTS), F.expr(base).alias("base_failed"),
                         (F.col("rules.rejected_by").isNull() & ~F.expr(base)).alias("kept"))


OP12_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT r, k, words[k:k + 2] AS w FROM t, unnest(range(1, len(words) - 1)) AS x(k)
), again AS (
  SELECT r, unnest([k, k + 1, k + 2]) AS place FROM (SELECT r, k, count(*) OVER (PARTITION BY r, w) AS n FROM g) WHERE n > 1
), rep AS (
  SELECT r, count(DISTINCT place) AS n_repeat_words FROM again GROUP BY r
), c AS (
  SELECT r, doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
    len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) AS lettered,
    len(list_filter(words, lambda x: regexp_matches(x, '^[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*$'))) AS capitals,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS bullets,
    len(list_filter(lines, lambda x: regexp_matches(x, '([.][.][.]|…)[\x20\x09-\x0D]*$'))) AS trails
  FROM t LEFT JOIN rep USING (r)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_words > 100000 OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 100 * n_symbols > 10 * n_words
    OR 100 * n_dup_lines > 50 * n_lines OR 100 * lettered < 80 * n_words OR 100 * capitals > 30 * n_words
    OR 100 * bullets > 90 * n_lines OR 100 * trails > 30 * n_lines) AS kept
FROM b
"""
