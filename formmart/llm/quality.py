"""Quality rules, with DataFrame functions only: base counts and distribution divergence.

Base rules.  A document fails when it has fewer than ``min_words`` words, or when
more than half of its words lie in 3-word windows that occur twice or more in it.

Divergence.  Two histograms of each document are compared with those of every
reference language by Jensen-Shannon distance (base 2, 0 to 1): character classes
(lower case, upper case, digits, white space, other), and the language's most
common words with one bin for all others.  The limit for words is a
share of the language's own distance from a text without any common word, wider
for short texts, whose shares vary more.  A histogram is judged only from a
minimum length on.  A document is kept when some language is near in both.

References come from all documents with a text and a language: sums of the
classes, and exact counts of the words, of which the most common ``top_words``
of each language are kept (ties to the smaller word).  At most
``MAX_LANGUAGES`` x ``top_words`` of them reach the driver.

Edge cases: a null text has no words and fails the base rules; a null language
takes no part in the references; without any reference the base rules alone
decide; a null doc_id or repeated rows are judged row by row; texts of any length are
judged whole, in one row; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formmart.llm.common import WORD_CLASS

MAX_LANGUAGES = 200
CLASSES = ("lower", "upper", "digit", "blank", "other")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    min_chars_for_classes: int = 200
    max_char_distance: float = 0.26
    #: Largest word distance, as a share of the distance that the language has from a
    #: text without any of its common words: word_share + word_noise / sqrt(words).
    #: Below 1 from 50 words on, so that such a text is always too far.
    min_words_for_common: int = 50
    word_share: float = 0.85
    word_noise: float = 1.0


@dataclass(frozen=True)
class References:
    """For each language the shares of the classes and of its common words."""

    classes: dict[str, tuple[float, ...]] = field(default_factory=dict)
    words: dict[str, dict[str, float]] = field(default_factory=dict)

    @property
    def all_words(self) -> list[str]:
        return sorted({w for ws in self.words.values() for w in ws})


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{WORD_CLASS}]+"), "")


def _classes(df: DataFrame, text: str) -> DataFrame:
    """Counts of the character classes; each class is cut out of what the one before left."""
    rest = F.col(text)
    df = df.withColumn("_n", F.length(rest))
    size = F.col("_n")
    for name, pattern in (("lower", r"\p{Ll}+"), ("blank", r"\s+"), ("upper", r"\p{Lu}+"), ("digit", r"\p{Nd}+")):
        df = df.withColumn(f"_rest_{name}", F.regexp_replace(rest, pattern, ""))
        rest = F.col(f"_rest_{name}")
        df = df.withColumn(f"_left_{name}", F.length(rest)).withColumn(f"_c_{name}", size - F.col(f"_left_{name}"))
        size = F.col(f"_left_{name}")
    return df.withColumn("_c_other", size)


def references(docs: DataFrame, text: str = "text", lang: str = "lang", top_words: int = 50) -> References:
    """Histograms of every language over all documents that have one."""
    rows = (docs.select(F.col(text).alias("t"), F.col(lang).alias("lang"))
            .where(F.col("t").isNotNull() & F.col("lang").isNotNull()))
    sums = (_classes(rows, "t").groupBy("lang")
            .agg(*[F.sum(f"_c_{c}").alias(c) for c in CLASSES], F.sum(F.size(word_array(F.col("t")))).alias("n_words"))
            .limit(MAX_LANGUAGES + 1).collect())
    if len(sums) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    classes, totals = {}, {r.lang: r.n_words for r in sums}
    for r in sums:
        total = sum(r[c] for c in CLASSES)
        if total:
            classes[r.lang] = tuple(r[c] / total for c in CLASSES)
    counts = (rows.select("lang", F.explode(word_array(F.col("t"))).alias("word"))
              .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    common = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_words).collect()
    words: dict[str, dict[str, float]] = {x: {} for x in classes}
    for r in common:
        words[r.lang][r.word] = r.n / totals[r.lang]
    return References(classes, words)


def base_counts(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_words`` and the five base counts of a text column without nulls."""
    t = F.col(text)
    df = df.withColumn("_words", word_array(t))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{WORD_CLASS}]"))
    df = df.withColumn("_lines", lines)
    n = F.size("_words")
    # where all hashes of windows differ, no window repeats; the others are compared as text
    of_window = lambda f: F.transform(F.sequence(F.lit(0), n - 3), lambda i: f(*[F.get(F.col("_words"), i + k) for k in range(3)]))
    df = df.withColumn("_hashes", F.when(n >= 3, of_window(F.xxhash64)))
    repeated = F.size("_hashes") > F.size(F.array_distinct("_hashes"))
    # no word holds a blank, so the joined windows are equal only if their words are
    windows = of_window(lambda *ws: F.concat_ws(" ", *ws))
    placed = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    df = df.withColumn("_sorted", F.when((n >= 3) & repeated, placed))
    df = df.withColumn("_at", F.sort_array(F.transform(F.filter(
        F.col("_sorted"),
        lambda x, j: ((j > 0) & (F.get(F.col("_sorted"), j - 1)["w"] == x["w"]))
        | F.coalesce(F.get(F.col("_sorted"), j + 1)["w"] == x["w"], F.lit(False))), lambda x: x["i"])))
    reach = F.transform(F.col("_at"), lambda p, k: F.least(F.lit(3), F.coalesce(F.get(F.col("_at"), k + 1) - p, F.lit(3))))
    return df.select(
        "*", n.cast("long").alias("n_words"),
        F.length(F.regexp_replace(t, f"[{WORD_CLASS}]+", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(reach, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long").alias("n_repeat_words"))


def bare_distance(shares: dict[str, float]) -> float:
    """Word distance between a language and a text without any of its common words."""
    common = min(1.0, sum(shares.values()))
    rest = 1 - common
    other = (math.log2(2 / (1 + rest)) + (rest * math.log2(2 * rest / (1 + rest)) if rest > 0 else 0.0)) / 2
    return math.sqrt(max(0.0, common / 2 + other))


def _term(p: Column, q: Column | float) -> Column:
    """A bin's part of the divergence; p or q may be 0."""
    q = q if isinstance(q, Column) else F.lit(float(q))
    half = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
    return (half(p, q) + half(q, p)) / 2


def _distances(df: DataFrame, refs: References) -> DataFrame:
    """Adds ``char_distance`` and ``word_distance``, arrays with one entry for each language."""
    df = _classes(df, "_t")
    share = lambda c: F.col(f"_c_{c}") / F.greatest(F.col("_n"), F.lit(1))
    chars = [F.sqrt(F.greatest(F.lit(0.0), reduce(lambda a, b: a + b, [_term(share(c), q) for c, q in zip(CLASSES, qs)])))
             for qs in refs.classes.values()]
    found = F.sort_array(F.filter(F.col("_words"), lambda w: w.isin(refs.all_words)))
    df = df.withColumn("_common", found)
    # runs of the sorted words: (word, first place), and the count from the next run's place
    df = df.withColumn("_runs", F.filter(
        F.transform(F.col("_common"), lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
        lambda x: (x["i"] == 0) | (F.get(F.col("_common"), x["i"] - 1) != x["w"])))
    per_word = F.greatest(F.size("_words"), F.lit(1))
    df = df.withColumn("_shares", F.transform(F.col("_runs"), lambda x, k: F.struct(
        x["w"].alias("w"),
        ((F.coalesce(F.get(F.col("_runs"), k + 1)["i"], F.size("_common")) - x["i"]) / per_word).alias("p"))))
    words = []
    for qs in refs.words.values():
        q_of = F.create_map(*[F.lit(v) for w, q in qs.items() for v in (w, q)])
        zero = F.struct(F.lit(0.0).alias("js"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))

        def add(a: Column, x: Column) -> Column:
            q, p = F.element_at(q_of, x["w"]), x["p"]
            return F.when(q.isNull(), a).otherwise(F.struct(
                (a["js"] + _term(p, q)).alias("js"), (a["p"] + p).alias("p"), (a["q"] + q).alias("q")))

        def total(a: Column) -> Column:
            # common words that the text lacks add half their share, all other words are one bin
            absent = F.greatest(F.lit(0.0), F.lit(sum(qs.values())) - a["q"]) / 2
            rest = _term(F.greatest(F.lit(0.0), 1 - a["p"]), max(0.0, 1 - sum(qs.values())))
            return F.sqrt(F.greatest(F.lit(0.0), a["js"] + absent + rest))

        words.append(F.aggregate(F.col("_shares"), zero, add, total))
    return df.withColumn("char_distance", F.array(*chars)).withColumn("word_distance", F.array(*words))


def judge(docs: DataFrame, refs: References, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The frame with the base counts, base_failed, char_distance, word_distance and kept.

    The two distances are those of the nearest language (least sum), null
    without references; clashing columns of the input are replaced.
    """
    out = (*BASE, "base_failed", "char_distance", "word_distance", "kept")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in out]
    df = base_counts(docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_t")), "_t")
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    df = df.withColumn("base_failed", failed)
    if refs.classes:
        df = _distances(df, refs)
        df = df.withColumn("_bare", F.array(*[F.lit(bare_distance(qs)) for qs in refs.words.values()]))
        df = df.withColumn("_near", F.array_min(F.transform(
            F.arrays_zip("char_distance", "word_distance", "_bare"),
            lambda x: F.struct((x["char_distance"] + x["word_distance"]).alias("sum"), x["char_distance"].alias("c"),
                               x["word_distance"].alias("w"), x["_bare"].alias("bare")))))
        df = df.withColumn("char_distance", F.col("_near.c")).withColumn("word_distance", F.col("_near.w"))
        far = (F.col("_n") >= limits.min_chars_for_classes) & (F.col("char_distance") > limits.max_char_distance)
        most = F.col("_near.bare") * (limits.word_share + limits.word_noise / F.sqrt(F.col("n_words")))
        far = far | ((F.col("n_words") >= limits.min_words_for_common) & (F.col("word_distance") > most))
    else:
        df = df.withColumn("char_distance", F.lit(None).cast("double")).withColumn("word_distance", F.lit(None).cast("double"))
        far = F.lit(False)
    df = df.withColumn("kept", ~F.col("base_failed") & ~far)
    # as a generated row, so that a later filter on a verdict isn't moved below, where all would be computed again
    return df.select(*kept, F.inline(F.array(F.struct(*out))))
