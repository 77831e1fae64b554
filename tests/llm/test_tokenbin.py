import io
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from helpers import HARD, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetscope.llm import tokenbin as B

PATH = P.path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 32).flatmap(lambda b: st.tuples(st.just(b), st.lists(st.integers(0, 2**b - 1), max_size=200))))
def test_packing_round_trip(case):
    bits, ids = case
    data = B.pack_ids(np.array(ids, np.uint64), bits)
    assert len(data) == -(-len(ids) // 64) * 8 * bits
    assert B.unpack_ids(data, len(ids), bits).tolist() == ids


def test_random_access():
    rng = np.random.default_rng(1)
    docs = [(i, rng.integers(0, 49408, size=n)) for i, n in enumerate((5, 0, 9000, 1, 4096))]
    f = B.TokenFile(io.BytesIO(B.file_bytes(docs, 16)))
    flat = np.concatenate([x for _, x in docs])
    assert f.doc_ids == [0, 1, 2, 3, 4] and f.bits == 16 and f.size == flat.size
    for a, z in ((0, 5), (4090, 4100), (8191, 8193), (0, flat.size), (flat.size - 1, flat.size), (7, 7)):
        assert f.ids(a, z).tolist() == flat[a:z].tolist()


@pytest.mark.parametrize("size", [B.FILE_IDS, 500])
def test_files_of_hard_texts(spark, size):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    rows = [*HARD, (30, "<|endoftext|> ÀÉ ǅ ́x don't  STOP now"), *[(15, prose(k, 50)) for k in range(40)]]
    want = []
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, ids.size, zlib.crc32(ids.tobytes())))
    folder = B.shared_dir(spark)
    files = B.write_files(documents(spark, rows).repartition(3), folder, PATH, 1, 49408, file_ids=size)
    got = B.read_files(files, folder).orderBy("start").collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert ids == sorted(ids)
    if size == 500:  # one doc_id that holds much of the rows falls to several ranges
        assert files.select("part").distinct().count() > 3


def test_empty_table(spark):
    files, folder = B.token_files(documents(spark, []), PATH, 1, 49408)
    assert B.read_files(files, folder).count() == 0


words = B.WordEncoder(PATH)
whole = Tokenizer.from_file(PATH)
whole.encode_special_tokens = True


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abT's12 \n\t éß́你🙂.,!ﬁİ"), max_size=40))
def test_word_by_word_is_exact(text):
    assert np.frombuffer(words.encode([text])[0], words.wide).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_added_tokens_as_the_library_has_them(spark, tmp_path):
    plain = Tokenizer.from_file(PATH)
    rows = [(1, "a <|endoftext|> b"), (2, "x<|startoftext|>\n<|ENDOFTEXT|> It's"), (3, "a <| b"), (4, None), (5, "after")]
    want, start = [], 0
    for i, t in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, ids.size, zlib.crc32(ids.tobytes())))
        start += ids.size
    assert plain.encode(rows[0][1], add_special_tokens=False).ids == [320, 49407, 321]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, B.op4_bit_packed_ids(spark, str(tmp_path)).collect())) == want


LATIN_1 = ["Don't", "O", "'S", "'", "ÉTÉ", "straße", "²", "ªº", "µm", "A.B", "&&&", "x²", "12", ".", ",", " ", "\n", "ñ", "×", "\xa0", "\xad", "<|", "!é"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(LATIN_1) | st.characters(max_codepoint=255), max_size=40).map("".join))
def test_latin_1_texts_are_exact(text):
    assert np.frombuffer(words.encode([text])[0], words.wide).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_plain_words_go_to_the_model_uncut(monkeypatch):
    """Letters, and letters with one mark after them, need no cutting by the pattern; a word is encoded once in all its cases."""
    enc, asked = B.WordEncoder(PATH), []
    enc.encode([". , !"])
    monkeypatch.setattr(enc, "pieces", None)
    model = enc._model
    monkeypatch.setattr(enc, "_model", lambda p: asked.append(p) or model(p))
    texts = ["Overture overture, OVERTURE.\noverture! Été", "ÉTÉ, overture"]
    assert [np.frombuffer(x, enc.wide).tolist() for x in enc.encode(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(asked) == ["overture", "été"]


def test_words_forgotten_and_case_kept_for_the_library(monkeypatch):
    """Ids stay as the library has them when words are dropped, and lower case names no added token by accident."""
    monkeypatch.setattr(B, "CACHE_WORDS", 8)
    monkeypatch.setattr(B, "CACHE_PIECES", 2)
    enc, plain = B.WordEncoder(PATH, added_as_text=False), Tokenizer.from_file(PATH)
    for k in range(4):
        texts = [f"a{k} B's, word{k}. Été\nlast", "\t<|ENDOFTEXT|> x\x01", "<|StartOfText|> “Quoted” İ", "<|ENDOFTEXT|>", None, "a <|endoftext|>"]
        assert [np.frombuffer(x, enc.wide).tolist() for x in enc.encode(texts)] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
