"""Language identification with hyperdimensional profiles.

Every letter (and the gap between words) has a random bipolar vector, derived
from its code point and a seed, so that all tasks have the same without sharing
them.  A letter trigram is bound from its letters' vectors: the first permuted
(rotated) twice, the second once, multiplied component by component.  A document
is the bundle (sum) of its trigrams' vectors; a language prototype is the bundle
of all its training documents.  Documents are compared with the prototypes by
cosine; equal cosines go to the language first in order.

Training sums integers for each language and component, in the tasks first, so
the prototypes don't depend on the partitioning.  What reaches the driver is one
vector for each language, at most ``MAX_LANGUAGES``.

Letters are Python's ``str.isalpha`` characters, lower-cased; all else is a gap.

Edge cases: a text that is null or has no letter is ``und`` with score 0, as is
every text when nothing was learned; rows without a language don't train; texts
of any length are used whole; repeated rows train as often as they occur; an empty table gives no
prototype and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
MAX_LANGUAGES = 2_000
#: Characters of text that are turned into arrays at a time (a longer text is a chunk alone).
CHUNK_CHARS = 1 << 20


class LetterSpace:
    """Vectors of letters and trigrams."""

    def __init__(self, dim: int = 512, seed: int = 7):
        if dim % 64:
            raise ValueError("the dimension is a multiple of 64")
        self.dim, self.seed = dim, seed

    def letters(self, points: np.ndarray) -> np.ndarray:
        """Bipolar vectors (int8) of code points; 0 is the gap."""
        with np.errstate(over="ignore"):
            words = np.arange(self.dim // 64, dtype=np.uint64)
            z = (points.astype(np.uint64)[:, None] << np.uint64(20)) + words + (np.uint64(self.seed) << np.uint64(44))
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15)):
                z = (z + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(factor)
                z ^= z >> np.uint64(shift)
        bits = np.unpackbits(z.view(np.uint8).reshape(len(points), -1), axis=1)
        return bits.astype(np.int8) * 2 - 1

    def trigrams(self, points: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Bound vectors (float32) of trigrams; a code has three digits, indexes into ``points``."""
        base, v = len(points), self.letters(points)
        first, second, third = codes // base ** 2, codes // base % base, codes % base
        bound = np.roll(v, 2, axis=1)[first] * np.roll(v, 1, axis=1)[second] * v[third]
        return bound.astype(np.float32)


def trigram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points in use, then for each text and trigram it has: the text's index, the code, the count."""
    text = "".join([f" {t.lower()} " for t in texts])
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    used = np.flatnonzero(np.bincount(chars))
    letters = used[[chr(c).isalpha() for c in used]]
    points = np.concatenate([[0], letters]).astype(np.int64)
    table = np.zeros(used[-1] + 1, np.int64)
    table[letters] = np.arange(1, len(points))
    symbol = table[chars]
    of = np.repeat(np.arange(len(texts)), [len(t.lower()) + 2 for t in texts])
    keep = np.ones(len(symbol), bool)
    keep[1:] = (symbol[1:] != 0) | (symbol[:-1] != 0) | (of[1:] != of[:-1])
    symbol, of = symbol[keep], of[keep]
    same = of[2:] == of[:-2]
    base = len(points)
    code = (symbol[:-2] * base + symbol[1:-1]) * base + symbol[2:]
    key, count = np.unique((of[2:] * base ** 3 + code)[same], return_counts=True)
    return points, key // base ** 3, key % base ** 3, count


def _chunks(*columns: list) -> Iterator[tuple]:
    """Runs of rows with a text (the first column), of about CHUNK_CHARS characters."""
    rows, size = [], 0
    for row in zip(*columns):
        if rows and size + len(row[0]) > CHUNK_CHARS:
            yield tuple(map(list, zip(*rows)))
            rows, size = [], 0
        rows.append(row)
        size += len(row[0])
    if rows:
        yield tuple(map(list, zip(*rows)))


def train_prototypes(docs: DataFrame, text: str = "text", lang: str = "lang",
                     space: LetterSpace = LetterSpace()) -> dict[str, np.ndarray]:
    """The prototype of each language that occurs with a text."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for texts, langs in _chunks(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                points, of, code, count = trigram_counts(texts)
                codes, where = np.unique(code, return_inverse=True)
                names = sorted(set(langs))
                which = np.array([names.index(x) for x in langs])[of]
                table = np.bincount(which * len(codes) + where, weights=count, minlength=len(names) * len(codes))
                table = table.reshape(len(names), len(codes))
                total = np.zeros((len(names), space.dim))
                for at in range(0, len(codes), 8192):
                    total += table[:, at:at + 8192] @ space.trigrams(points, codes[at:at + 8192]).astype(np.float64)
                for name, row in zip(names, total):
                    sums[name] = sums.get(name, 0) + np.rint(row).astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["lang", "sums"])

    rows = docs.select(F.col(text), F.col(lang)).where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    total = (rows.mapInArrow(bundle, "lang string, sums array<long>")
             .select("lang", F.posexplode("sums").alias("k", "v"))
             .groupBy("lang", "k").agg(F.sum("v").alias("v"))
             .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("sums")))
    found = total.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r.lang: np.array([x.v for x in r.sums], np.float64) for r in sorted(found, key=lambda r: r.lang)}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text",
             space: LetterSpace = LetterSpace()) -> DataFrame:
    """The frame with lang_pred and score (the cosine, not below 0); clashing columns are replaced."""
    names = list(prototypes)
    norms = [max(np.linalg.norm(v), 1e-300) for v in prototypes.values()]
    matrix = np.array([v / n for v, n in zip(prototypes.values(), norms)]).reshape(len(names), space.dim).T

    def judge(texts: list[str]) -> tuple[list[str], list[float]]:
        points, of, code, count = trigram_counts(texts)
        codes, where = np.unique(code, return_inverse=True)
        vectors = space.trigrams(points, codes)
        cuts = np.searchsorted(of, np.arange(len(texts) + 1))
        bundles = np.zeros((len(texts), space.dim), np.float32)
        weight = count.astype(np.float32)
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if a < b:
                bundles[i] = weight[a:b] @ vectors[where[a:b]]
        size = np.sqrt(np.einsum("ij,ij->i", bundles, bundles, dtype=np.float64))
        lettered = cuts[1:] > cuts[:-1]
        if not names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        cosine = (bundles.astype(np.float64) @ matrix) / np.maximum(size, 1e-300)[:, None]
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best], 0.0, 1.0)
        return ([names[k] if ok else UNKNOWN for k, ok in zip(best, lettered)],
                [float(s) if ok else 0.0 for s, ok in zip(score, lettered)])

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pred, score = [], []
            for (texts,) in _chunks([t or "" for t in batch]):
                p, s = judge(texts)
                pred += p
                score += s
            yield pd.DataFrame({"lang_pred": pd.Series(pred, dtype=object), "score": pd.Series(score, dtype=float)})

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*[F.col(f"`{c}`") for c in kept], predict(F.col(text)).alias("_judged")).select(
        *[F.col(f"`{c}`") for c in kept], "_judged.lang_pred", "_judged.score")


def split_held_out(doc_id: Column, folds: int = 3, held: int = 1) -> Column:
    """Whether crc32 of the id as text falls in the held-out fold (a null id counts as empty text)."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == held
