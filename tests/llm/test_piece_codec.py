import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from helpers import ODD_TEXTS, empty_docs, odd_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from formmart.llm import piece_codec
from formmart.llm.piece_codec import PieceModel, Stored, encode_decode

PATH = public_tokenizers.path("piece_bpe_32k.model")
library = sentencepiece.SentencePieceProcessor(model_file=PATH)
model = PieceModel(PATH)

EDGES = ["", " ", "  ", "a  b   c    d", "\n\n\t\r\n x", "▁", "▁▁a ▁", "ab" * 300, " " * 200, "x" + " " * 77 + "y\n" + " " * 31,
         "<0x0A> <s></s><unk>", "á ﬁ ½ 　x", "\x00 \x00a\x00\n"]


@pytest.mark.parametrize("text", [t for t in ODD_TEXTS if t is not None] + EDGES)
def test_equals_the_library(text):
    ids = library.encode(text)
    assert model.encode(text) == ids
    assert model.decode(ids) == library.decode(ids)
    assert [i for s in model.segments(model.normalized(text)) for i in model.ids(model.backtrack(s))] == ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aeiouthnrs .,\n▁é日ß😀\tİ", max_size=60))
def test_random_texts(text):
    assert model.encode(text) == library.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 31999), max_size=12) | st.lists(st.integers(3, 258), max_size=8))
def test_random_ids(ids):
    assert model.decode(ids) == library.decode(ids)


def test_pieces_in_any_order():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(model.pieces[259:]).replace("▁", " ") for _ in range(8))
        assert model.encode(text) == library.encode(text)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(odd_docs(spark, EDGES))
    rows = encode_decode(docs, PATH, end_id=2).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d in docs.collect():
        ids = library.encode(d.text or "", add_eos=True)
        want.append((d.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)), ids, library.decode(ids)))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))


def test_store_is_bounded(monkeypatch):
    import formmart.llm.piece_codec as P
    monkeypatch.setattr(P, "MAX_STORED", 5)
    stored = Stored(PieceModel(PATH))
    for text in ["a b c d e f g h i j a b c", "long" * 40 + " a b"]:
        ids, decoded = stored.encode_decode(text)
        assert list(map(int, ids.split())) == library.encode(text) and decoded == text
    assert len(stored) <= 5 and len(stored.old) <= 5 and max(map(len, stored)) <= P.MAX_STORED_CHARS


def test_empty(spark):
    assert encode_decode(empty_docs(spark), PATH, end_id=2).count() == 0


def test_a_worker_keeps_its_store(monkeypatch):
    loaded = []
    monkeypatch.setattr(piece_codec, "PieceModel", lambda path: loaded.append(path) or model)
    piece_codec.worker_store.cache_clear()
    try:
        for text in ["the thin \n other", "é😀 the\u0378", "the thin \n other"]:
            ids, decoded = piece_codec.worker_store(PATH).encode_decode(text)
            assert list(map(int, ids.split())) == library.encode(text)
            assert decoded == library.decode(library.encode(text))
    finally:
        piece_codec.worker_store.cache_clear()
    assert loaded == [PATH]
