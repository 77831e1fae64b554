import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from helpers import HARD, documents, prose
from hypothesis import given
from hypothesis import strategies as st

from fleetscope.llm import lm

ROWS = [*HARD, *((40 + i, prose(i % 9, 50 + i)) for i in range(30))]


def brute(rows, folds=7, held=2):
    toks, uni, pairs, after, n_train = [], Counter(), Counter(), defaultdict(set), 0
    for i, t in rows:
        w = [*lm.tokens(t), b""]
        trains = zlib.crc32(b"" if i is None else str(i).encode()) % folds != held
        toks.append((i, w, trains))
        if trains:
            n_train += 1
            uni.update(w)
            for a, b in zip([b" ", *w], w, strict=False):
                pairs[a, b] += 1
                after[a].add(b)
    n, v, out = sum(uni.values()), len(uni), []
    for i, w, trains in toks:
        base = score = 0.0
        for a, b in zip([b" ", *w], w, strict=False):
            p = (uni[b] + 1) / (n + v + 1)
            c, t = (n_train if a == b" " else uni[a]), len(after.get(a, ()))
            base += math.log10(p)
            score += math.log10((pairs[a, b] + t * p) / (c + t)) if c + t else math.log10(p)
        out.append((i, not trains, len(w), sum(uni[x] > 0 for x in w), n, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


def found(df):
    return sorted(((*r[:5], round(r.base_score, 6), round(r.score, 6)) for r in df.collect()), key=str)


def test_equal_to_brute_force_in_one_and_many_blocks(spark):
    for rows, block in ((ROWS, 10**6), (ROWS, 150), ([], 100), ([(5, "all held out?")], 100)):
        assert found(lm.score(documents(spark, rows).repartition(2), block_tokens=block)) == brute(rows)


def test_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_KEYS", 200)
    assert found(lm.score(documents(spark, ROWS), block_tokens=300)) == brute(ROWS)


def test_probabilities_of_a_state_sum_to_one():
    rows = [(1, "a b a c"), (3, "b a d a")]
    for state in (b" ", b"a", b"b", b"zz"):
        uni = Counter(w for _, t in rows for w in [*lm.tokens(t), b""])
        seqs = [[b" ", *lm.tokens(t), b""] for _, t in rows]
        nxt = Counter(b for s in seqs for a, b in zip(s, s[1:], strict=False) if a == state)
        n, v, c, t = sum(uni.values()), len(uni), sum(nxt.values()), len(nxt)
        p = {w: (uni[w] + 1) / (n + v + 1) for w in [*uni, b"never"]}
        assert math.isclose(sum((nxt[w] + t * p[w]) / (c + t) if c + t else p[w] for w in p), 1)


@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_planes(xs):
    assert lm.unplanes(lm.planes(np.array(xs, np.uint64))).tolist() == xs
