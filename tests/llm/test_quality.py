from collections import Counter

import numpy as np
import pytest
from helpers import WORDS, empty_docs, odd_docs, prose, words

from formmart.llm.quality import BASE, References, judge, references


def brute_counts(text):
    text = text or ""
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def brute_distances(text, refs):
    """Jensen-Shannon distances of the nearest language."""
    def js(p, q):
        p, q = np.array(p, float), np.array(q, float)
        m = (p + q) / 2
        part = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x > 0)
        return max(0.0, (part(p) + part(q)) / 2) ** 0.5
    import regex
    n = max(len(text), 1)
    counts = [len(regex.findall(r"\p{Ll}", text)), len(regex.findall(r"\p{Lu}", text)), len(regex.findall(r"\p{Nd}", text)),
              len(regex.findall(r"[ \t\n\x0b\f\r]", text))]
    shares = [c / n for c in counts] + [(len(text) - sum(counts)) / n]
    w = words(text)
    out = []
    for lang, qs in refs.classes.items():
        common = refs.words[lang]
        c = Counter(x for x in w if x in common)
        p = [c[x] / max(len(w), 1) for x in common]
        q = list(common.values())
        out.append((js(shares, qs), js([*p, 1 - sum(p)], [*q, 1 - sum(q)])))
    return min(out, key=sum)


def test_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    refs = references(docs)
    rows = {r.doc_id: r for r in judge(docs, refs).collect()}
    all_docs = docs.collect()
    assert len(rows) == len(all_docs)
    for lang in refs.words:
        c = Counter(w for d in all_docs if d.lang == lang for w in words(d.text))
        top = sorted(c.items(), key=lambda x: (-x[1], x[0]))[:50]
        assert refs.words[lang] == pytest.approx({w: n / sum(c.values()) for w, n in top})
    for d in all_docs:
        r = rows[d.doc_id]
        assert tuple(r[c] for c in BASE) == brute_counts(d.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert (r.char_distance, r.word_distance) == pytest.approx(brute_distances(d.text, refs), abs=1e-6)
        assert not (r.kept and r.base_failed)


def test_labelled_documents(spark):
    """Clean documents stay, junk goes, on rows that the thresholds weren't set on."""
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    judged = judge(docs, references(docs)).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    rows = judged.where("NOT base_failed").select("quality", "kept").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert np.mean(clean) >= 0.99 and np.mean(junk) <= 0.1


def test_odd_rows(spark):
    docs = odd_docs(spark, [prose(1, 200), "word " * 60, "x y z " * 10 + prose(2, 80)])
    rows = judge(docs, references(docs)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert tuple(r[c] for c in BASE) == brute_counts(r.text)
        assert r.kept in (True, False)
    assert not any(r.kept for r in rows if not r.text)


def test_empty_and_without_references(spark):
    docs = empty_docs(spark)
    assert references(docs) == References()
    assert judge(docs, references(docs)).count() == 0
    rows = judge(odd_docs(spark, [prose(3, 100)]), References()).collect()
    assert [r.kept for r in rows] == [not r.base_failed for r in rows]


def test_clashing_columns_are_replaced(spark):
    df = spark.createDataFrame([(1, "a b", True, "x")], "doc_id long, text string, kept boolean, n_words string")
    assert judge(df, References()).collect()[0].n_words == 2


def test_no_python_in_the_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = judge(docs, references(docs))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_texts_without_common_words_are_rejected(spark):
    """At every judged length, also for a language whose common words are rare."""
    rng = np.random.default_rng(3)
    junk = lambda n: " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(6, 10)))) for _ in range(n))
    refs = references(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rare = {w: q * 0.15 / sum(refs.words["en"].values()) for w, q in refs.words["en"].items()}
    docs = spark.createDataFrame([(n, junk(n)) for n in (50, 60, 110, 119, 120, 200, 1000)], "doc_id long, text string")
    for r in (refs, References({"en": refs.classes["en"]}, {"en": rare})):
        rows = judge(docs, r).collect()
        assert not any(x.base_failed or x.kept for x in rows), [(x.n_words, x.char_distance, x.word_distance) for x in rows if x.kept]
