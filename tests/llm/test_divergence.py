import re
from collections import Counter, defaultdict

import pytest
from helpers import prose

from fleetscope.llm import divergence


def docs(spark, rows):
    return spark.createDataFrame([(k, *r, 1, 2, "x") for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n long, place long, term string")


def brute(rows, min_docs, top):
    seen, by_group, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        seen[lang].update(set(words))
        by_group[lang, source].update(words)
    out = []
    for lang, sources in groups.items():
        kept = sorted((t for t, n in seen[lang].items() if n >= min_docs), key=str.encode)
        v = len(kept)

        def shares(c, kept=kept, v=v):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * v) for t in kept}
        q = shares(sum((by_group[lang, s] for s in sources), Counter()))
        p = {s: shares(by_group[lang, s]) for s in sources}
        for s in sources:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s))
            out += [(lang, s, "pair", o, -x, k) for k, (x, _, o) in enumerate(pairs, 1)]
            terms = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if by_group[lang, s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t, -x, k) for k, (x, _, t) in enumerate(terms[:top], 1)]
    return sorted(out)


ROWS = [(prose(k, 20 + k % 30), "ab"[k % 2], f"s{k % 5}") for k in range(60)] + [
    (None, "a", "s0"), ("", "a", "empty"), (None, None, None), ("ba do", None, "é"), ("BA Ba bA1ba_ba", "a", None), ("ünïcode ba 你好 ba🙂", "a", "s1"),
    ("lonely", "z", "only"), (prose(3, 5000), "b", "s1"), ("tie1 x tie2", "a", "s2")]


@pytest.mark.parametrize(("min_docs", "top", "block", "tile"), [(1, 7, 64, 10), (3, 50, 2, 40), (30, 3, 64, 200_000), (1000, 5, 64, 10)])
def test_equal_to_brute_force(spark, monkeypatch, min_docs, top, block, tile):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "TILE_ROWS", tile)
    assert sorted(tuple(r) for r in divergence.audit(docs(spark, ROWS), min_docs, top).collect()) == brute(ROWS, min_docs, top)


def test_counts_do_not_depend_on_pieces_and_flushes(spark, monkeypatch):
    text = prose(1, 4000) + " ünï" * 50
    assert [w for part in divergence.pieces(text.encode(), 7) for w in part] == text.encode().translate(divergence.TERM_BYTES).split()
    monkeypatch.setattr(divergence, "HELD", 3)
    monkeypatch.setattr(divergence, "PIECE", 5)
    assert sorted(tuple(r) for r in divergence.audit(docs(spark, ROWS), 2, 9).collect()) == brute(ROWS, 2, 9)


def test_shares_are_exact_beyond_64_bits(spark):
    one = spark.sql("SELECT 4000000000000000000L AS n, 9000000000000000000L AS total, 7L AS v")
    assert one.select(divergence.share("n", "total", "v")).first()[0] == 1 + 10**9 * (4 * 10**18 + 5) // (9 * 10**18 + 35)


def test_empty_table(spark):
    assert divergence.audit(docs(spark, [])).count() == 0
