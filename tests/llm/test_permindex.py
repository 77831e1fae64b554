import numpy as np

from fleetscope.llm import permindex as A


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 0.5) for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, score double")


def brute(rows, queries, k):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
          if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v) != 0)]
    out = []
    for q, x in ok:
        if q in queries:
            best = sorted((-(v * x).sum(), i) for i, v in ok if i != q)[:k]
            out += [(q, r + 1, i) for r, (_, i) in enumerate(best)]
    return sorted(out)


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(60)]
    rows += [(60, None), (61, [0.0] * 8), (62, [None] + [1.0] * 7), (63, [float("nan")] * 8), (64, [float("inf")] + [0.0] * 7), (None, rows[0][1])]
    rows += [(70 + i, rows[0][1]) for i in range(30)]  # ties
    queries = {0, 20, 40, 60, 80}
    df = frame(spark, rows)
    got = A.nearest(df, df.filter("vec_id % 20 = 0"), 20).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == brute(rows, queries, 20)
    few = frame(spark, rows[:5])
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in A.nearest(few, few, 20).collect()) == brute(rows[:5], set(range(5)), 20)
    assert A.nearest(frame(spark, []), frame(spark, []), 5).count() == 0


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = frame(spark, list(enumerate(x.tolist())))
    got = {}
    for r in A.nearest(df, df.filter("vec_id % 300 = 0"), 20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, ids in got.items():
        s = x @ x[q]
        s[q] = -9
        hits += len(ids & set(np.argsort(-s)[:20].tolist()))
    assert len(got) == 20 and hits / (20 * len(got)) >= 0.9
