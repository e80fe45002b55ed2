import math
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import empty_docs, low_words, odd_docs, prose
from pyspark.sql import functions as F

from formmart.llm import registry as R
from formmart.llm.language_id import split_held_out
from formmart.llm.ppm import SYMBOLS, score_corpus, train


class Brute:
    """PPM with escape by distinct symbols and exclusion, on dictionaries."""

    def __init__(self, texts, order, min_share=0.0):
        self.order = order
        self.counts = [defaultdict(Counter) for _ in range(order + 1)]
        for t in texts:
            data = bytes(order) + t
            for i, s in enumerate([*t, 256]):
                for j in range(order + 1):
                    self.counts[j][data[i + order - j:i + order]][s] += 1
        total = sum(len(t) + 1 for t in texts)
        for level in self.counts:
            for ctx in [c for c, n in level.items() if sum(n.values()) < min_share * total]:
                del level[ctx]

    def log10(self, context, symbol):
        out, excluded = 0.0, set()
        for j in range(self.order, -1, -1):
            seen = self.counts[j].get(context[len(context) - j:])
            if not seen:
                continue
            rest = {s: n for s, n in seen.items() if s not in excluded}
            n = sum(rest.values())
            room = len(rest) if len(seen) < SYMBOLS else 0
            if symbol in rest:
                return out + math.log10(rest[symbol] / (n + room))
            if n + room:
                out += math.log10(room / (n + room))
            excluded |= set(seen)
        return out - math.log10(SYMBOLS - len(excluded))

    def score(self, text):
        data = bytes(self.order) + text
        return sum(self.log10(data[i:i + self.order], s) for i, s in enumerate([*text, 256]))


def held(doc_id):
    return zlib.crc32((str(doc_id) if doc_id is not None else "").encode()) % 7 == 2


@pytest.mark.parametrize("order,share,chunk", [(3, 0.0, 24_000_000), (5, 2.0 ** -22, 4000), (2, 0.01, 100)])
def test_against_brute_force(spark, order, share, chunk):
    docs = odd_docs(spark, [prose(i, 30 + i) for i in range(40)])
    rows = score_corpus(docs.repartition(3), split_held_out(F.col("doc_id"), 7, 2), order=order, min_share=share, chunk_chars=chunk)
    all_docs = docs.collect()
    training = [d.text or "" for d in all_docs if not held(d.doc_id)]
    model = Brute([t.encode() for t in training], order, share)
    counts = Counter(w for t in training for w in low_words(t)) + Counter({"\n": len(training)})
    n, v = sum(counts.values()), len(counts)
    want = []
    for d in all_docs:
        c = [counts[w] for w in [*low_words(d.text), "\n"]]
        want.append((d.doc_id, held(d.doc_id), len(c), sum(x > 0 for x in c), n,
                     sum(math.log10((x + 1) / (n + v + 1)) for x in c), model.score((d.text or "").encode())))
    got = [tuple(r) for r in rows.collect()]
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 5))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_probabilities_sum_to_one(spark):
    import numpy as np
    texts = [prose(i, 40) for i in range(20)]
    model = train(spark.createDataFrame([(t,) for t in texts], "text string"), order=4)
    data = bytes(4) + texts[3].encode()
    for i in range(0, 120, 7):
        for context in (data[i:i + 4], b"zz" + data[i:i + 2]):
            base = int.from_bytes(context, "big") << 9
            p = 10 ** model.log10(np.array([base | s for s in range(SYMBOLS)], np.uint64))
            assert p.sum() == pytest.approx(1)


def test_all_symbols_seen(spark):
    import numpy as np
    model = train(spark.createDataFrame([("".join(map(chr, range(2000))),)], "text string"), order=0)
    p = 10 ** model.log10(np.arange(SYMBOLS, dtype=np.uint64))
    assert p.sum() == pytest.approx(1)


def test_beats_the_base_on_held_out_text(spark):
    rows = R.QUERIES["op1_ppm"](spark, "/root/testdata/sf0.1").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_untrained_and_empty(spark):
    assert score_corpus(empty_docs(spark), F.lit(False)).count() == 0
    rows = score_corpus(odd_docs(spark).limit(4), F.lit(True)).collect()
    for r in rows:
        size = 1 + (len({0: "", 1: "", 2: " ", 3: "\n\t \r"}[r.doc_id]))
        assert r.score == pytest.approx(-size * math.log10(SYMBOLS))
        assert (r.train_tokens, r.n_known, r.base_score) == (0, 0, 0.0)


def test_rare_contexts_of_a_larger_corpus_count(spark):
    """Over 2^20 symbols, contexts that occur once or twice still take part by default."""
    rare = [(i, prose(i, 30, [f"w{i * 30 + k}" for k in range(30)]) + " " + prose(i, 900)) for i in range(600)]
    docs = spark.createDataFrame(rare + [(1000 + i, t) for i, t in rare[:20]], "doc_id long, text string")
    held_out = F.col("doc_id") >= 1000
    training = docs.where(~held_out).select("text")
    assert training.agg(F.sum(F.length("text"))).first()[0] > 2 ** 21
    want = dict(zip(range(1000, 1020), train(training, min_share=0.0).score([t.encode() for _, t in rare[:20]])))
    got = {r.doc_id: r.score for r in score_corpus(docs, held_out).where("held_out").collect()}
    assert got == pytest.approx(want)


def test_no_limit_on_events_drops_contexts(spark, monkeypatch):
    monkeypatch.setattr("formmart.llm.ppm.MAX_EVENTS", 500, raising=False)  # the limit that there was
    texts = [prose(i, 40) for i in range(20)]
    model = train(spark.createDataFrame([(t,) for t in texts], "text string"), order=3, min_share=0.0)
    assert len(model.keys[3]) > 500
    assert model.score([b"the old river", b"unseen"]) == pytest.approx(
        [Brute([t.encode() for t in texts], 3).score(t) for t in (b"the old river", b"unseen")])


def test_superseded_tables_are_deleted_and_parts_change_nothing(spark, monkeypatch):
    """Only the scores stay on the disks."""
    import os

    from formmart.session import work_dir
    folder = os.path.join(work_dir(spark).removeprefix("file:"), "formmart", "llm")

    def files():
        return {(name, f) for name in (os.listdir(folder) if os.path.isdir(folder) else []) if not name.startswith(("scored", "ppm_level"))
                for _, _, names in os.walk(os.path.join(folder, name)) for f in names if f.endswith(".parquet")}

    docs = odd_docs(spark, [prose(i, 40 + i) for i in range(30)])
    held_out = split_held_out(F.col("doc_id"), 7, 2)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens, r.score)
    results, before = [], files()
    for parts in (1, 3):
        monkeypatch.setattr("formmart.llm.ppm.PASSES", parts, raising=False)
        results.append(sorted(score_corpus(docs, held_out, order=4, chunk_chars=1000).collect(), key=key))
    assert results[0] == results[1] and len(results[0]) == docs.count()
    assert files() == before


def test_a_chunk_is_scored_in_short_runs():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from formmart.llm.ppm import _score_chunk, events

    texts = [prose(i, 200) for i in range(20)] * 200 + ["", "Zz"]
    counts = Counter(w for t in texts for w in low_words(t)) + Counter({"\n": len(texts)})
    keys = np.unique(events([t.encode() for t in texts[-22:]], 5)[0])
    log = {int(k): -float(i % 7 + 1) for i, k in enumerate(keys)}
    given = pa.table({"word": [*counts, *[None] * len(log)],
                      "value": pa.array([*counts.values(), *keys.view(np.int64).tolist()], pa.int64()),
                      "log": pa.array([None] * len(counts) + list(log.values()), pa.float64())})
    rows = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "held_out": [False] * len(texts), "text": texts})
    assert rows.nbytes > 3 << 20
    tracemalloc.start()
    try:
        out = _score_chunk(rows, given, 5).to_pylist()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40 << 20  # runs of a megabyte alone take 57 MB
    for i in [0, 19, 4000, 4001]:
        c = [counts[w] for w in [*low_words(texts[i]), "\n"]]
        assert (out[i]["doc_id"], out[i]["n_tokens"], out[i]["n_known"]) == (i, len(c), len(c))
        assert out[i]["log_counts"] == pytest.approx(sum(math.log10(x + 1) for x in c))
        assert out[i]["score"] == pytest.approx(sum(log[int(k)] for k in events([texts[i].encode()], 5)[0]))


def test_words_are_split_and_counted_by_columns(monkeypatch):
    """Runs of words equal the words of each text, and a chunk's words are told without an object for each."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from formmart.llm.ppm import _base_sums, _word_runs

    monkeypatch.setattr("formmart.llm.ppm.WORD_BYTES", 40)
    texts = ["", " a\x0b\x0c B\tc\n\r ", "  ", "\u00dcn\u00ef x y\x85z  q", "\x1c\x1dA\x1f b", "one " * 30, "\x00 a\x00b", "\u0130I", "\n"]
    runs = [(begin, end, [w.encode() for w in words.to_pylist()], n.tolist()) for begin, end, words, n in _word_runs(pa.array(texts))]
    assert len(runs) == 3 and [r[0] for r in runs] == [0, *[r[1] for r in runs[:-1]]] and runs[-1][1] == len(texts)
    split = [t.encode().lower().split() for t in texts]
    assert [w for r in runs for w in r[2]] == sum(split, [])
    assert [k for r in runs for k in r[3]] == [len(ws) for ws in split]

    monkeypatch.undo()
    words = [f"w{i}" for i in range(200_000)]
    given = pa.table({"word": ["\n", *words, None], "value": pa.array([2, *[i % 3 for i in range(200_000)], 7], pa.int64())})
    column = pa.chunked_array([pa.array([" ".join(words[:100_000])]), pa.array([" ".join(words[100_000:])])])
    tracemalloc.start()
    try:
        n_tokens, n_known, logs = _base_sums(column, given)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n_tokens == [100_001] * 2 and n_known == [66_667, 66_668]
    assert logs == pytest.approx([sum(math.log10(i % 3 + 1) for i in at) + math.log10(3) for at in (range(100_000), range(100_000, 200_000))])
    assert peak < 12 << 20  # a dictionary of the words alone takes 25 MB
