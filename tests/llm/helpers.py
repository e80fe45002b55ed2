"""Small tables and plain reimplementations that the tests compare with."""

import random
import re

from pyspark.sql import types as T

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

ODD_TEXTS = [None, "", " ", "\n\t \r", "A.", "a  b   c", "x" * 5000, "日本語 テキスト ①", "e\u0301 É ß İ", "tab\there\x0bthere",
             "same line\nsame line\nother\n\nsame line", "\x00 nul", "<|endoftext|> </s> ▁▁ ▁", "😀 👍🏽", "don't 's it's. a., b"]


def odd_docs(spark, more=()):
    """Nulls in every column, odd texts, a repeated row and clashing extra columns."""
    rows = [(i, t, "en" if i % 3 else None, "s", None) for i, t in enumerate([*ODD_TEXTS, *more])]
    rows += [rows[5], (None, "a text without an id here", "en", None, 1), (7, "another text of an id that occurs twice", "fr", "s", 2)]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def prose(seed: int, n: int, words=("the of and to in that with from this was are for an old small river house green "
                                      "walks stone cloud paper window light").split()) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(n))


def words(text):
    return WORDS.findall(text) if text else []


def low_words(text):
    return WORDS.findall(text.translate(LOWER)) if text else []
