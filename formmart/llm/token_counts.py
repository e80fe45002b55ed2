"""Token counts under a unigram piece model, with one forward score for each shared prefix.

The distinct pre-tokens (a blank mark and a word) of a batch are visited in the
order of a depth-first walk of their trie: sorted, so that each pre-token shares
with the one before it the path down to their longest common prefix.  Forward
scores (the best score of a segmentation of the prefix, and its number of
tokens) are computed once for each node of the trie and dropped when the walk
leaves its subtree; a pre-token's count is what its terminal node has.  A
document's count is the sum over its words.  Counts of known words are kept in
a bounded store.

The model is a vocabulary with piece ranks; the score of the piece of rank r is
-log(r + 2.7) (Zipf-Mandelbrot).  Characters without a piece count as their
UTF-8 bytes, each at a score below every piece.  Of equal scores the fewer
tokens win.

Edge cases: a null text or one without words has 0 tokens; repeated rows are
counted one by one; words of any length are counted whole; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import os.path
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formmart.llm.common import WORD

BLANK = "▁"
MAX_WORDS = 400_000
MAX_WORD_CHARS = 64


def piece_scores(model_path: str) -> dict[str, float]:
    """Unigram scores from the ranks of a SentencePiece vocabulary's pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    special = lambda i: sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not special(i)]
    return {p: -math.log(rank + 2.7) for rank, p in enumerate(pieces)}


class TrieCounter:
    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.byte_score = min(scores.values()) - 10
        lengths: dict[str, set[int]] = {}
        for p in scores:
            if len(p) > 1:
                lengths.setdefault(p[-2:], set()).add(len(p))
        #: lengths of the pieces that end in two given characters
        self.lengths = {c: sorted(v) for c, v in lengths.items()}

    def counts(self, words: Iterator[str]) -> Iterator[tuple[str, int]]:
        """(word, tokens) of each of the distinct words, in trie order."""
        scores, lengths, byte_score = self.scores, self.lengths, self.byte_score
        forward: list[tuple[float, int]] = [(0.0, 0)]  # best score and minus its tokens, for each prefix
        path = ""
        for word in sorted(words):
            token = BLANK + word
            shared = len(os.path.commonprefix((path, token)))
            del forward[shared + 1:]
            for end in range(shared + 1, len(token) + 1):
                last = token[end - 1]
                before, n = forward[end - 1]
                single = scores.get(last)
                if single is None:
                    size = len(last.encode())
                    best = before + size * byte_score, n - size
                else:
                    best = before + single, n - 1
                for size in lengths.get(token[end - 2:end], ()) if end > 1 else ():
                    if size > end:
                        break
                    s = scores.get(token[end - size:end])
                    if s is not None:
                        before, n = forward[end - size]
                        s += before
                        if s > best[0] or s == best[0] and n - 1 > best[1]:
                            best = s, n - 1
                forward.append(best)
            path = token
            yield word, -forward[-1][1]


def count_tokens(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TrieCounter(piece_scores(model_path))
        known: dict[str, int] = {}
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n_words, n_tokens = [], []
            for at in range(0, len(texts), 4096):
                part = texts[at:at + 4096]
                here = set()
                for t in part:
                    here.update(WORD.findall(t) if t else ())
                kept = {w: known[w] for w in here if w in known}
                new = dict(counter.counts(here - kept.keys()))
                kept |= new
                for t in part:
                    words = WORD.findall(t) if t else ()
                    n_words.append(len(words))
                    n_tokens.append(sum([kept[w] for w in words]))
                known |= {w: n for w, n in new.items() if len(w) <= MAX_WORD_CHARS}
                if len(known) > MAX_WORDS:
                    known = kept if len(kept) <= MAX_WORDS else {}
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                                             names=["doc_id", "n_words", "n_tokens"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, "doc_id long, n_words long, n_tokens long"))
