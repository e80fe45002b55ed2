import public_tokenizers
from helpers import empty_docs, odd_docs, words
from hypothesis import given, settings
from hypothesis import strategies as st

from formmart.llm import registry as R
from formmart.llm.token_counts import BLANK, TrieCounter, count_tokens, piece_scores

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCORES = piece_scores(PATH)
COUNTER = TrieCounter(SCORES)


def brute(word):
    """Tokens of the best path, found without sharing anything."""
    token, worst = BLANK + word, min(SCORES.values()) - 10
    best = [(0.0, 0)]
    for end in range(1, len(token) + 1):
        paths = [(best[at][0] + SCORES[token[at:end]], best[at][1] - 1) for at in range(max(0, end - 16), end) if token[at:end] in SCORES]
        if token[end - 1] not in SCORES:
            n = len(token[end - 1].encode())
            paths.append((best[end - 1][0] + n * worst, best[end - 1][1] - n))
        best.append(max(paths))
    return -best[-1][1]


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text(alphabet="aeioutshnr.,é日😀x▁", min_size=1, max_size=20), max_size=40))
def test_counts(found):
    assert dict(COUNTER.counts(found)) == {w: brute(w) for w in found}


def test_equals_the_unigram_model_of_tokenizers():
    """The same scores in the tokenizers library's unigram model; single characters all have a piece here."""
    from tokenizers import Tokenizer, models
    vocabulary = [("<unk>", -100.0), *SCORES.items()]
    t = Tokenizer(models.Unigram(vocabulary, unk_id=0))
    found = ["house", "anthropology", "the", "thationing", "xqzvk", "a"]
    for w in found:
        ids = t.encode(BLANK + w).ids
        mine = dict(COUNTER.counts({w}))[w]
        assert mine == len(ids)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(odd_docs(spark))
    rows = sorted(map(tuple, count_tokens(docs, PATH).collect()), key=repr)
    cache = {}
    want = []
    for d in docs.collect():
        w = words(d.text)
        want.append((d.doc_id, len(w), sum(cache.setdefault(x, None) or cache.__setitem__(x, brute(x)) or cache[x] for x in w)))
    assert rows == sorted(want, key=repr)


def test_empty(spark):
    assert count_tokens(empty_docs(spark), PATH).count() == 0


def test_query(spark, sf_dir):
    assert R.QUERIES["op7_token_counts"](spark, sf_dir).count() == 200
