import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import empty_docs, odd_docs, prose

from formmart.llm.packing import Packer, Piece, pack
from formmart.llm.word_ids import WordIds

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, docs, tokenizer, window):
    """Every id lies in one piece, pieces have their ids' checksum, sequences have no gap."""
    by_seq, by_text = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.doc_tokens >= r.start + r.length and r.length > 0
        by_seq[r.sequence_id].append(r)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
    want = defaultdict(list)
    for d in docs:
        want[d.doc_id].append(ids_of(tokenizer, d.text))
    for key, texts in want.items():
        if len(texts) == 1 or len({tuple(t) for t in texts}) == 1:
            pieces = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.start)
            assert sum(p.length for p in pieces) == len(texts) * len(texts[0])
            for p in pieces:
                ids = np.array(texts[0][p.start:p.start + p.length], "<u4").tobytes()
                assert p.ids_crc32 == zlib.crc32(ids) and p.doc_tokens == len(texts[0])
    assert sum(r.length for r in rows) == sum(len(t) for ts in want.values() for t in ts)
    return [sum(p.length for p in ps) for ps in by_seq.values()]


@pytest.mark.parametrize("window,open_windows,fan_in", [(2048, 32, 64), (64, 3, 2), (16, 1, 2)])
def test_pieces(spark, sf_dir, tokenizer, window, open_windows, fan_in):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(7)
    sizes = check(pack(docs, PATH, window=window, open_windows=open_windows, fan_in=fan_in).collect(),
                  docs.collect(), tokenizer, window)
    assert sum(s < window for s in sizes) <= 1  # all windows but the last are full


def test_odd_rows(spark, tokenizer):
    docs = odd_docs(spark, [prose(1, 3000)])
    check(pack(docs, PATH).collect(), docs.collect(), tokenizer, 2048)


def test_empty(spark):
    assert pack(empty_docs(spark), PATH).count() == 0


def test_words_equal_whole_texts(tokenizer):
    texts = ["", " ", "á e ́x", "İstanbul ΑΣ ΟΔΟΣ", "don't 's  x'll", "<|endoftext|>foo <|startoftext|>  b", "x\x1cy z\x0bq", "日本 ①½",
             "a b\u2003c\u3000d", "ﬁ ǅ", "é\ne", "H\u0331 x, y., z.,", "a,b. c.. d.\ne!. \u0130. 1. ²,", "A\u0301, B.", "x_. y-, z.", " .  , a ."]
    got = list(WordIds(PATH).texts(texts + [None], chunk=3))
    for text, ids in zip([*texts, ""], got):
        assert ids == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_best_fit_and_bounded_space():
    packer = Packer(10, 2)
    for i, n in enumerate([6, 8, 3, 2]):
        packer.add(Piece(i, 0, b"\0\0\0\0" * n, n))
    # 3 fits only the first window; 2 fills the second exactly
    assert [[p.doc_id for p in w] for w in packer.full] == [[1, 3]]
    assert len(packer.open) == 1
    packer.add(Piece(4, 0, b"\0\0\0\0" * 9, 9))
    packer.add(Piece(5, 0, b"\0\0\0\0" * 5, 5))  # none fits: the fullest (9 or 9) takes the head
    assert len(packer.open) <= 2
    assert all(sum(map(len, w)) == 10 for w in packer.full)


def test_added_tokens_in_other_cases(tokenizer):
    texts = [t for s in ("<|ENDOFTEXT|>", "<|EndOfText|>", "<|endoftext|>", "<|STARTOFTEXT|>") for t in (s, f"Some {s} Words", f"A{s}.")]
    got = [np.frombuffer(b, "<u4").tolist() for b in WordIds(PATH).texts(texts)]
    assert got == [ids_of(tokenizer, t)[:-1] for t in texts]


def test_every_code_point_before_a_mark(tokenizer):
    """Letters whose normal form ends in a combining mark keep the mark with what follows."""
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(letters), 1 << 17):
        texts = [f"日 x{c}{mark} y" for c in letters[at:at + (1 << 17)] for mark in ".,"]
        want = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        got = WordIds(PATH).texts(texts)
        wrong = [t for t, e, ids in zip(texts, want, got) if np.array(e.ids, "<u4").tobytes() != ids]
        assert not wrong, wrong[:5]


def test_the_store_starts_anew(monkeypatch, tokenizer):
    from formmart.llm import word_ids

    monkeypatch.setattr(word_ids, "MAX_WORDS", 5)
    texts = [prose(i, 20) + f" W{i}" for i in range(30)]
    got = WordIds(PATH).texts(texts, chunk=4)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [ids_of(tokenizer, t)[:-1] for t in texts]
