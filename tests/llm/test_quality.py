import random
import zlib

import numpy as np
from helpers import HARD, documents, prose

from fleetscope.llm import quality as Q


def corpus():
    rows, labels = [], []
    for i in range(300):
        good = i % 4 != 0
        t = prose(i, 60)
        if not good:
            t = t.upper() if i % 8 else " | ".join(t.split())
        rows.append((i, t))
        labels.append((i, int(good)))
    return rows, labels


def frame(spark, labels):
    return spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_compiled_rules(spark):
    rows, labels = corpus()
    rules = Q.fit(documents(spark, rows), frame(spark, [*labels, (None, 1), (5, None)]))
    assert rules.terms and len(rules.terms) < 100
    got = {r.doc_id: r.score for r in Q.score(documents(spark, rows).select("doc_id", "text"), rules).select("doc_id", "score").collect()}
    held = [(got[i], q) for i, q in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 30 and np.mean([(s >= 0.3) == bool(q) for s, q in held]) >= 0.95
    plan = Q.score(documents(spark, rows), rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_labels_alone_move_nothing_else(spark):
    """A held-out label changes no score."""
    rows, labels = corpus()
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    a, b = (Q.fit(documents(spark, rows), frame(spark, x)) for x in (labels, flipped))
    assert a == b


def test_hard_rows_and_few_labels(spark):
    docs = documents(spark, HARD).select("doc_id", "text")
    for labels in ([], [(1, 1), (4, 1)], [(1, 1), (2, 0), (3, 0), (4, 1), (11, 1), (12, 0)]):
        rules = Q.fit(docs, frame(spark, labels))
        got = Q.score(docs, rules).collect()
        assert len(got) == len(HARD) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 2}) == 1
    assert Q.fit(documents(spark, []), frame(spark, [(1, 1)])) == Q.Rules()


def test_lasso_drops_noise():
    r = random.Random(3)
    y = np.array([r.random() < 0.5 for _ in range(800)], float)
    signal = np.array([v if r.random() < 0.95 else 1 - v for v in y])
    x = np.stack([signal, *(np.array([r.random() < 0.5 for _ in y], float) for _ in range(8))], axis=1)
    _, w = Q.lasso(x, y, 0.05)
    assert w[0] > 1 and not w[1:].any()
