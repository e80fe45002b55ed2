"""Queries over ``documents``."""

from __future__ import annotations

from formmart.llm.common import read_table
from formmart.llm.registry import register


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file (the same on every machine)."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op6_packing")
def op6_packing(spark, sf_dir):
    from formmart.llm.packing import pack

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, tokenizer_file("word_bpe_49k.json"), end_id=1, window=2048)


@register("op5_piece_codec")
def op5_piece_codec(spark, sf_dir):
    from formmart.llm.piece_codec import encode_decode

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_decode(docs, tokenizer_file("piece_bpe_32k.model"), end_id=2, with_values=False)


@register("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    from formmart.llm.token_counts import count_tokens

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, tokenizer_file("piece_bpe_32k.model"))


@register("op8_language_id")
def op8_language_id(spark, sf_dir):
    from formmart.llm.language_id import identify, split_held_out, train_prototypes

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", split_held_out(docs.doc_id))
    prototypes = train_prototypes(docs.where("NOT held_out"))
    return identify(docs, prototypes).select("doc_id", "held_out", "lang_pred", "score")


@register("op4_quality_rules")
def op4_quality_rules(spark, sf_dir):
    from formmart.llm.quality import judge, references

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs, references(docs)).drop("text", "lang")


@register("op2_ngram_jaccard_join")
def op2_ngram_jaccard_join(spark, sf_dir):
    from formmart.llm.ngram_join import jaccard_join

    return jaccard_join(read_table(spark, sf_dir, "documents").select("doc_id", "text"), size=3, percent=90)


@register("op1_ppm")
def op1_ppm(spark, sf_dir):
    from formmart.llm.language_id import split_held_out
    from formmart.llm.ppm import score_corpus

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_corpus(docs, split_held_out(docs.doc_id, folds=7, held=2))


#: Counts and products stay within 128 bits.
_OP11_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                       unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                              'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM worded GROUP BY lang),
spans AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM worded, (SELECT unnest(range(1, 6)) AS k)),
counts AS (SELECT lang, ws[i:i + k - 1] AS w, k, count(*)::HUGEINT AS f FROM spans GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT lang, w, k, f AS a FROM counts WHERE k >= 2),
inside AS (SELECT DISTINCT lang, w[i:i + m - 1] AS w, a AS longer
           FROM cand, (SELECT unnest(range(2, 5)) AS m), (SELECT unnest(range(1, 5)) AS i) WHERE m < k AND i + m - 1 <= k),
kept AS (SELECT c.* FROM cand c WHERE NOT EXISTS (SELECT 1 FROM inside s WHERE s.lang = c.lang AND s.w = c.w AND s.longer >= c.a)),
cuts AS (SELECT c.lang, c.w, c.a, t.n, j, x.f AS l, y.f AS r, (1000 * c.a * t.n) // (x.f * y.f) AS score
         FROM kept c JOIN totals t USING (lang), (SELECT unnest(range(1, 5)) AS j), counts x, counts y
         WHERE j < c.k AND x.lang = c.lang AND y.lang = c.lang AND x.w = c.w[1:j] AND y.w = c.w[j + 1:]),
weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, w ORDER BY score, j) AS nth FROM cuts),
ranked AS (SELECT *, array_to_string(w, ' ') AS phrase,
                  row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank
           FROM weakest WHERE nth = 1)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""


@register("op11_collocations", _OP11_SQL)
def op11_collocations(spark, sf_dir):
    from formmart.llm.collocations import collocations

    return collocations(read_table(spark, sf_dir, "documents").select("text", "lang"), min_count=100, top=2000)
