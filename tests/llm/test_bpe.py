import base64
import hashlib
import random
import time

import public_tokenizers as P
import pytest
import tiktoken
from helpers import HARD, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetscope.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_digests_of_hard_texts(spark, reference):
    got = sorted(map(tuple, bpe.digests(documents(spark, HARD)).collect()), key=str)
    want = []
    for i, t in HARD:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    assert bpe.digests(documents(spark, [])).count() == 0


encoder = bpe.Encoder(PATH, P.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab tTh'se12 \n\t é你🙂.,!"), max_size=60))
def test_cut_at_spaces_is_exact(text):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))} if not hasattr(test_cut_at_spaces_is_exact, "r") else None
    if ranks:
        test_cut_at_spaces_is_exact.r = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = test_cut_at_spaces_is_exact.r.encode_ordinary(text)
    raw = encoder.encode(text)
    assert [int.from_bytes(raw[k:k + 4], "little") for k in range(0, len(raw), 4)] == want


def test_native_fold_gives_the_same_ids(spark, reference):
    ranks = bpe.load_ranks(PATH)
    words = sorted({w for _, t in HARD for w in encoder.pattern.findall(t or "")})[:250] + ["", None]
    got = bpe.encode_words(spark.createDataFrame([(w,) for w in words], "w string"), "w", ranks)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    for w, ids in got.collect():
        assert ids == reference.encode_ordinary(w or ""), w


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "ab", "étë你🙂", "a"])
def test_long_words_are_merged_as_short_ones(reference, letters):
    r = random.Random(letters)
    for n in (bpe.LONG_WORD - 1, bpe.LONG_WORD + 1, 700, 30_000):
        word = "".join(r.choice(letters) for _ in range(n)).encode()
        assert bpe.merge_bytes(word, encoder.ranks) == reference._encode_single_piece(word)


def test_a_word_of_a_million_bytes():
    r = random.Random(1)
    word = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000)).encode()
    start = time.process_time()
    ids = bpe.merge_bytes(word, encoder.ranks)
    assert time.process_time() - start < 30  # some 4 s; a quadratic merge takes hours
    pieces = {r: p for p, r in encoder.ranks.items()}
    assert b"".join(pieces[i] for i in ids) == word


def test_remembered_words_are_bounded_on_every_path(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 50_000)
    own = bpe.Encoder(PATH, P.PATTERN)
    for k in range(200):
        for gap in (" ", "  "):  # plain texts, and texts that are split by the pattern as a whole
            own.encode(gap.join(f"w{k}x{j}" for j in range(100)) + " " + "long" * 500)
        assert (len(own.words) + len(own.chunks)) * bpe.ENTRY <= 50_000 + bpe.ENTRY
        assert max(map(len, [*own.words, *own.chunks])) <= bpe.LONG_WORD
