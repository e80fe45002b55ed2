import numpy as np
from helpers import empty_docs, odd_docs, prose

from formmart.llm import registry as R
from formmart.llm.language_id import LetterSpace, identify, train_prototypes, trigram_counts

DE = "der die und ein haus fluss stein wolke papier fenster licht gehen mit von schön über straße".split()


def brute_bundle(text, space):
    """Sum of the trigrams' vectors, one by one."""
    symbols = [0]
    for c in text.lower():
        if c.isalpha():
            symbols.append(ord(c))
        elif symbols[-1]:
            symbols.append(0)
    if symbols[-1]:
        symbols.append(0)
    v = {p: space.letters(np.array([p]))[0].astype(int) for p in set(symbols)}
    total = np.zeros(space.dim, int)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        total += np.roll(v[a], 2) * np.roll(v[b], 1) * v[c]
    return total


def test_bundles_equal_brute_force():
    space = LetterSpace(128)
    texts = ["Hello, world!", "", "a", "  Straße 12 über  ", "日本語 テ", "x" * 50]
    points, of, code, count = trigram_counts(texts)
    vectors = space.trigrams(points, code)
    for i, t in enumerate(texts):
        assert (count[of == i] @ vectors[of == i] == brute_bundle(t, space)).all()


def test_letter_vectors_are_random():
    v = LetterSpace(1024).letters(np.arange(97, 123)).astype(int)
    assert set(np.unique(v)) == {-1, 1}
    cos = v @ v.T / 1024 - np.eye(26)
    assert np.abs(cos).max() < 0.2


def test_prototypes_dont_depend_on_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one, many = train_prototypes(docs.coalesce(1)), train_prototypes(docs.repartition(5))
    assert list(one) == list(many) and all((one[x] == many[x]).all() for x in one)
    space = LetterSpace()
    for lang in one:
        want = sum(brute_bundle(r.text, space) for r in docs.where(docs.lang == lang).collect())
        assert (one[lang] == want).all()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    rows = R.QUERIES["op8_language_id"](spark, d).join(spark.read.parquet(f"{d}/documents.parquet"), "doc_id").where("held_out")
    hits = [r.lang == r.lang_pred for r in rows.collect()]
    assert len(hits) > 200 and np.mean(hits) > 0.98


def test_odd_rows(spark):
    docs = odd_docs(spark, [prose(1, 200)])
    more = spark.createDataFrame([(100, prose(2, 200, DE), "de", "s", 0)], docs.schema)
    protos = train_prototypes(docs.unionByName(more))
    clash = docs.unionByName(more).withColumn("score", docs.text)
    rows = identify(clash, protos).collect()
    assert len(rows) == docs.count() + 1
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered)
        assert 0 <= r.score <= 1
    assert [r.lang_pred for r in rows if r.doc_id == 100] == ["de"]


def test_nothing_learned(spark):
    assert train_prototypes(empty_docs(spark)) == {}
    assert {r.lang_pred for r in identify(odd_docs(spark), {}).collect()} == {"und"}
    assert identify(empty_docs(spark), {"en": np.ones(512)}).count() == 0


def test_identify_against_one_by_one(spark):
    """Predictions and scores from vectors bound and bundled letter by letter."""
    import numpy as np

    from formmart.llm.language_id import LetterSpace, identify, train_prototypes

    texts = [("the house and the river", "en"), ("la maison et la rivière", "fr"), ("das haus und der fluss", "de"),
             ("over the old stone", "en"), ("un vieux mur", "fr"), ("ein altes tor", "de")]
    train = spark.createDataFrame(texts, "text string, lang string")
    asked = [(i, t) for i, t in enumerate(["the stone house", "la vieille maison", "der alte fluss", "a", "", None, "12 ..", "ñandú über"])]
    space = LetterSpace()
    prototypes = train_prototypes(train)

    def bundle(text):
        from formmart.llm.language_id import trigram_counts
        points, _, codes, counts = trigram_counts([text])
        total = np.zeros(space.dim)
        for code, n in zip(codes, counts):
            total += n * space.trigrams(points, np.array([code])).astype(float)[0]
        return total

    for lang, vector in prototypes.items():
        assert np.allclose(vector, sum(bundle(t) for t, x in texts if x == lang))
    names = list(prototypes)
    got = identify(spark.createDataFrame(asked, "id int, text string"), prototypes).collect()
    for r in got:
        vector = bundle(r.text or "")
        if not vector.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosines = [float(vector @ prototypes[x] / np.linalg.norm(vector) / np.linalg.norm(prototypes[x])) for x in names]
        assert r.lang_pred == names[int(np.argmax(cosines))] and abs(r.score - max(0.0, max(cosines))) < 1e-6
