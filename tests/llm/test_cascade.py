import re
from collections import Counter

import pytest
from helpers import HARD, documents, prose

from fleetscope.llm import cascade

TEXTS = [t for _, t in HARD] + [
    "LOUD WORDS!! " * 40, "a|b " * 60, "same line here\n" * 30, "- point\n" * 60, "wait for it ...\n" * 20, "x " * 70, "1234567 89 " * 40, "Q" * 50_000, "7" * 200_000,
    prose(5, 30_000), "a b c a b c d", "a b c\x85d e a b c\x85d e", "\x0b\x0cone\x1ctwo", "one two\n\none two\n ", prose(1, 60) + "\n…", "ÉTÉ ÀB AB1 aB A",
]


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    times, inside = Counter(windows), set()
    for k, x in enumerate(windows):
        if times[x] > 1:
            inside |= {k, k + 1, k + 2}
    counts = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
              "n_dup_lines": sum(x in lines[:k] for k, x in enumerate(lines)), "n_repeat_words": len(inside)}
    n, m = len(w), len(lines)
    bad = (n < 50 or n > 100_000 or 100 * len(inside) > 50 * n or counts["word_chars"] < 3 * n or counts["word_chars"] > 10 * n
           or 100 * counts["n_symbols"] > 10 * n or 100 * counts["n_dup_lines"] > 50 * m
           or 100 * sum(any(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" or c >= "\x80" for c in x) for x in w) < 80 * n
           or 100 * sum(len(re.findall("[A-Z]", x)) > 1 and not re.search("[a-z]", x) for x in w) > 30 * n
           or 100 * sum(x.lstrip(cascade.SPACE)[:1] in ("-", "*", "•") for x in lines) > 90 * m
           or 100 * sum(x.rstrip(cascade.SPACE).endswith(("...", "…")) for x in lines) > 30 * m)
    return counts, bad


def test_verdicts_equal_to_brute_force_in_any_order(spark):
    docs = documents(spark, list(enumerate(TEXTS)))
    order = cascade.ordered(cascade.RULES, cascade.measure(docs, sample=30))
    assert sorted(r.name for r in order) == sorted(r.name for r in cascade.RULES)
    for rules in (order, cascade.RULES, cascade.RULES[::-1]):
        got = cascade.verdicts(docs, rules, cascade.COUNTS)
        assert got.columns == [*docs.columns, "rules"]
        for r in got.collect():
            counts, bad = brute(TEXTS[r.doc_id])
            assert {c: r.rules[c] for c in cascade.COUNTS} == counts, TEXTS[r.doc_id]
            assert (r.rules.rejected_by is not None) == bad
            names = [x.name for x in rules]
            assert r.rules.met == (names.index(r.rules.rejected_by) + 1 if bad else len(rules))


def test_wide_vocabulary_takes_the_two_step_windows():
    words = [f"w{k}" for k in range((1 << 20) + 5)]
    assert cascade.Text(" ".join([*words, *words[:4]])).n_repeat_words == 8


def test_order_is_by_rejection_per_cost_of_what_is_left():
    a, b, c = (cascade.Rule(n, lambda t: False) for n in "abc")
    # b rejects most per second; of what it leaves, c rejects one and a none
    assert [r.name for r in cascade.ordered([a, b, c], [(0b011, 6, [6.0, 0.6, 3.0]), (0b100, 1, [1.0, 0.1, 0.5]), (0, 3, [3.0, 0.3, 1.5])])] == ["b", "c", "a"]
    assert cascade.ordered([a, b], []) == [a, b]


@pytest.mark.parametrize("rules", [(), cascade.RULES])
def test_empty_table_and_no_rules(spark, rules):
    none = documents(spark, [])
    assert cascade.measure(none, rules) == [] and cascade.verdicts(none, rules).count() == 0
    kept = cascade.verdicts(documents(spark, HARD).withColumnRenamed("row", "rules"), ()).select("rules_.*").distinct().collect()
    assert [tuple(r) for r in kept] == [(None, 0)]
