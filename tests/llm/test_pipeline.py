import hashlib
import os

import corpus_pipeline as C
import public_tokenizers as P
import tiktoken
from helpers import BASE, HARD, documents, edited, prose
from pyspark.sql import functions as F
from test_decontam import brute as windows
from test_linededup import brute as lines
from test_neardup import brute as near

from fleetscope.llm import bpe, linededup, quality

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_hard_rows(spark):
    docs = documents(spark, HARD)
    for name, stage in C.STAGES:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, SF)
            n = out.count()
            assert n <= rows.count()
            if name != "byte_bpe":
                assert out.columns == docs.columns, name
                assert n == rows.count() or name in ("quality_classifier", "near_duplicates", "decontamination")
        if name == "near_duplicates":
            kept = [r.doc_id for r in stage(spark, docs, SF).collect()]
            assert len(kept) == len(set(kept)) and 1 in kept and 2 not in kept and 3 not in kept


def test_run_equals_brute_force(spark):
    """Every stage by all pairs, all lines, all windows and the reference tokenizer; the rules by their array form."""
    got = {r.doc_id: r for r in C.run(spark, SF).collect()}
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rules = quality.fit(docs, labels)
    stats = docs.select("doc_id", "text", *(c.cast("double").alias(k) for k, c in quality.statistics(F.col("text")).items())).toPandas()
    score = rules.score({k: stats[k].to_numpy() for k in stats.columns[2:]}, len(stats))
    left = [(int(i), t) for i, t, s in zip(stats.doc_id, stats.text, score, strict=True) if s >= 0.3]
    assert 0 < len(left) < len(stats)
    class_of = dict(near(left))
    left = [(i, t) for i, t in left if class_of[i] == i]
    left = [(i, t) for i, t, *_ in lines(left, linededup.MIN_WORDS, linededup.MIN_BYTES)]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {i for i, *_, hit in windows(left, items) if hit}
    left = {i: t for i, t in left if i not in bad}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    assert set(got) == set(left) and len(got) > 100
    for i, t in left.items():
        ids = enc.encode_ordinary(t)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_queries_are_registered():
    import __spark_entry__ as E
    names = E.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert os.path.exists(SF)


def test_near_duplicates_tells_rows_of_one_id_apart(spark):
    rows = [(None, prose(8, 40)), (None, None), (None, prose(9, 50)), (3, BASE), (20, prose(21, 90)), (20, edited(BASE, 5, 2)), (20, prose(22, 80)),
            (21, prose(21, 90)), (22, prose(23, 70)), (22, prose(23, 70)), (5, "")]
    got = C.near_duplicates(spark, documents(spark, rows).repartition(4), SF).collect()
    want = [(None, prose(8, 40)), (None, prose(9, 50)), (3, BASE), (20, prose(21, 90)), (20, prose(22, 80)), (22, prose(23, 70)), (5, "")]
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(want, key=str)
    clean = [r.text for r in C.near_duplicates(spark, documents(spark, HARD), SF).collect() if r.doc_id is None]
    assert clean == [prose(8, 40)]


def test_decontaminate_tells_rows_of_one_id_apart(spark):
    leak = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect() if r.text and len(r.text.split()) > 12)
    rows = [(None, leak), (None, prose(8, 40)), (None, None), (7, leak), (7, prose(9, 40)), (7, prose(9, 40)), (8, leak + " " + prose(3, 30)), (9, "")]
    got = C.decontaminate(spark, documents(spark, rows).repartition(3), SF).collect()
    want = [(i, t) for i, t in rows if not (t or "").startswith(leak)]
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(want, key=str)
