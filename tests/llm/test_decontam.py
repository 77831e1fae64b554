from helpers import HARD, documents, prose

from fleetscope.llm import decontam
from fleetscope.llm.common import words

ITEMS = [(1, prose(4, 40)), (2, "one two three"), (3, None), (4, ""), (None, prose(13, 20)), (5, prose(77, 30)), (6, prose(4, 40)), (7, "One")]


def items(spark, rows):
    return spark.createDataFrame([(i, t, 0) for i, t in rows], "item_id long, text string, n_words int")


def windows_of(text, size):
    w = words(text)
    return [tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))] if w else []


def brute(docs, tests, size=13):
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for k, x in tests:
            for win in windows_of(x, size):
                for p in range(len(w) - len(win) + 1):
                    if tuple(w[p:p + len(win)]) == win:
                        hit |= set(range(p, p + len(win)))
                        ids |= {k} - {None}
        out.append((i, len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, sorted(r["items"]), r.contaminated) for r in df.collect()), key=str)


def test_equal_to_brute_force(spark):
    for docs, tests in ((HARD, ITEMS), (HARD, []), ([], ITEMS)):
        assert found(decontam.contaminated(documents(spark, docs), items(spark, tests))) == brute(docs, tests)


def test_blocks_of_items_and_small_segments(spark):
    docs = documents(spark, HARD).repartition(3)
    hits = decontam.phrases(docs, items(spark, ITEMS), block_words=60)
    whole = decontam.phrases(docs, items(spark, ITEMS))
    key = lambda r: (str(r.doc_id), r.n_words, sorted(set(zip(r.starts, r.lengths))), sorted(r["items"]))
    assert sorted(map(key, hits.collect())) == sorted(map(key, whole.collect()))
    small = decontam.build_index(docs, segment_words=100)
    assert small.count() > 3


def test_proximity(spark):
    docs = [(1, "alpha x beta y gamma"), (2, "gamma beta " + "z " * 30 + "alpha"), (3, "alpha beta")]
    near = decontam.phrases(documents(spark, docs), items(spark, [(9, "gamma alpha beta")]), within=5)
    assert {r.doc_id for r in near.collect() if r.starts} == {1}


def test_many_blocks_equal_brute_force(spark, monkeypatch):
    held = []
    made = decontam.Windows.__init__
    monkeypatch.setattr(decontam.Windows, "__init__", lambda self, items, size: (held.append(len(items)), made(self, items, size))[1])
    monkeypatch.setattr(decontam.phrases, "__defaults__", (13, None, 600))
    tests = [*ITEMS, *((100 + k, ITEMS[0][1]) for k in range(40))]
    assert found(decontam.contaminated(documents(spark, HARD), items(spark, tests))) == brute(HARD, tests)
    assert len(held) > 5 and max(held) < len(tests) / 2  # copies of one text are dealt out too


def test_very_long_text_is_looked_up_whole(spark):
    long = (9, prose(21, 100_000) + " " + prose(4, 40) + " " + prose(22, 100_000))
    got = found(decontam.contaminated(documents(spark, [long]), items(spark, ITEMS)))
    assert got == [(9, len(words(long[1])), 40, [1, 6], False)]
