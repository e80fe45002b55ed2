"""Exact encoding and decoding with merge-type (BPE) SentencePiece models.

Encoding by backtracking.  The merge order of a BPE model decides, for two
adjacent tokens alone, whether re-merging their joint text gives the same two
tokens; a sequence of tokens is the model's encoding exactly when every adjacent
pair passes that check.  An Aho-Corasick automaton finds all pieces that start
at each position; the search takes the longest one that is compatible with the
token before it, steps back to the next shorter one when a position has none
left, and records such positions in a bitfield, since the encoding of a prefix
is unique and so a failed position fails for every path.

Pieces that merging never reaches are left out, characters without a piece fall
back to their bytes.  A text is cut where no piece crosses (before runs of the
blank mark, around line feeds); each distinct segment is encoded once and kept
in a bounded store, which a worker keeps from task to task.

Edge cases: a null text is empty; the empty text has the end id alone; texts of
any length are encoded whole (long segments aren't stored); repeated rows are
encoded one by one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
#: Segments and token pairs kept by a worker; beyond that a store starts afresh.
MAX_STORED = 300_000
MAX_STORED_CHARS = 64


class PieceModel:
    """Pieces and scores of a model file, with the encoder and the decoder."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.normalize("  a ½ ") != f"{BLANK * 3}a{BLANK}½{BLANK}":
            raise ValueError("only models without normalization, with a blank put in front, are supported")
        size = range(sp.get_piece_size())
        self.pieces = [sp.id_to_piece(i) for i in size]
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in size if sp.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("only models with byte fallback are supported")
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.silent = {i for i in size if sp.is_control(i)}
        self.unknown = sp.unk_id()
        normal = [i for i in size if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id_of = {self.pieces[i]: i for i in normal}
        self.score = {self.pieces[i]: sp.get_score(i) for i in normal}
        inside = set("".join(p for p in self.id_of if len(p) > 1))
        self.cut_lines = "\n" not in inside
        self.cut_blanks = not any(BLANK in p.lstrip(BLANK) for p in self.id_of)
        self.automaton = ahocorasick.Automaton()
        self.longer = ahocorasick.Automaton()  # the pieces of two or more characters
        for piece in self.id_of:
            if self.merge(piece) == [piece]:
                self.automaton.add_word(piece, piece)
                if len(piece) > 1:
                    self.longer.add_word(piece, (len(piece) - 1, piece))
        self.automaton.make_automaton()
        self.longer.make_automaton()
        self.shown = {i: self.pieces[i].replace(BLANK, " ") for i in normal}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merge(self, text: str) -> list[str]:
        """The tokens of a short text by merging: best score first, of equal ones the leftmost."""
        parts, score, never = list(text), self.score.get, float("-inf")
        joint = [score(a + b, never) for a, b in zip(parts, parts[1:])]
        while joint:
            best = max(joint)
            if best == never:
                break
            i = joint.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del joint[i]
            if i < len(joint):
                joint[i] = score(parts[i] + parts[i + 1], never)
            if i:
                joint[i - 1] = score(parts[i - 1] + parts[i], never)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether re-merging the joint text of two tokens gives the two again."""
        key = left, right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MAX_STORED:
                self.pairs = {}
            known = self.pairs[key] = self.merge(left + right) == [left, right]
        return known

    def tokens(self, text: str) -> list[str]:
        """Encode by backtracking; a character without a piece is a token of its own."""
        # mostly the longest match from each position on is right at once
        out = [p for _, p in self.automaton.iter_long(text)]
        if sum(map(len, out)) == len(text):
            known = self.pairs.get
            for pair in zip(out, out[1:]):
                if not (known(pair) or self.compatible(*pair)):
                    break
            else:
                return out
        return self.backtrack(text)

    def backtrack(self, text: str) -> list[str]:
        n = len(text)
        starts = [[c] for c in text]  # pieces by their start, the longest last
        if len(self.longer):
            for end, (more, piece) in self.longer.iter(text):
                starts[end - more].append(piece)
        known, last = self.pairs.get, None
        failed = bytearray(n // 8 + 1)
        out: list[str] = []
        tried: list[int] = []  # which of a position's pieces stands in out
        pos, k = 0, len(starts[0]) - 1 if n else 0
        while pos < n:
            found = starts[pos]
            while k >= 0:
                token = found[k]
                end = pos + len(token)
                if not failed[end >> 3] >> (end & 7) & 1 and (
                        last is None or known((last, token)) or self.compatible(last, token)):
                    break
                k -= 1
            if k >= 0:
                out.append(token)
                tried.append(k)
                pos, last = end, token
                k = len(starts[pos]) - 1 if pos < n else 0
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                pos -= len(out.pop())
                last = out[-1] if out else None
                k = tried.pop() - 1
        return out

    def ids(self, tokens: list[str]) -> Iterator[int]:
        for token in tokens:
            known = self.id_of.get(token)
            if known is not None:
                yield known
            else:
                for b in token.encode():
                    yield self.bytes[b]

    def normalized(self, text: str) -> str:
        return BLANK + text.replace(" ", BLANK) if text else ""

    def segments(self, normal: str) -> list[str]:
        """The text in parts that no piece crosses."""
        if not self.cut_blanks:
            return [normal]
        if "\0" in normal or BLANK * 2 in normal:
            line = "\n" if self.cut_lines else ""
            return re.findall(f"\n|{BLANK}+[^{BLANK}{line}]*|[^{BLANK}{line}]+" if line
                              else f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+", normal)
        if self.cut_lines and "\n" in normal:
            normal = normal.replace("\n", "\0\n\0")
        return normal.replace(BLANK, "\0" + BLANK).split("\0")

    def encode(self, text: str | None) -> list[int]:
        """The ids of a whole text, without the end id."""
        return [i for s in self.segments(self.normalized(text or "")) for i in self.ids(self.tokens(s))]

    def decode_part(self, ids) -> str:
        """The text of ids with blanks in place of their marks, the blank put in front included."""
        out: list[str] = []
        pending = bytearray()
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            if pending:
                out.append(decode_bytes(pending))
                pending = bytearray()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.silent:
                out.append(self.pieces[i].replace(BLANK, " "))
        if pending:
            out.append(decode_bytes(pending))
        return "".join(out)

    def decode(self, ids) -> str:
        """The text of ids, without the blank that encoding put in front."""
        ids = [i for i in ids if i not in self.silent]
        marked = ids and ids[0] not in self.byte_of and self.pieces[ids[0]].startswith(BLANK)
        return self.decode_part(ids)[1 if marked else 0:]


def decode_bytes(data: bytes) -> str:
    """UTF-8; each byte that is no part of a character becomes U+FFFD."""
    out, at = [], 0
    while at < len(data):
        first = data[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        try:
            out.append(bytes(data[at:at + size]).decode())
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


class Stored(dict):
    """Segment → its ids, each after a blank, and their decoded part.

    The part is None where bytes of the neighbours may join it: where it isn't
    the segment's own text.  Two generations: when the young one is full it
    becomes the old one, and what is used again moves back, so that frequent
    segments stay.
    """

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model
        self.old: dict[str, tuple[str, str | None]] = {}

    def __missing__(self, segment: str) -> tuple[str, str | None]:
        value = self.old.get(segment)
        if value is None:
            model, tokens = self.model, self.model.tokens(segment)
            try:
                ids = [model.id_of[t] for t in tokens]
                part = "".join([model.shown[i] for i in ids])
            except KeyError:  # a character without a piece
                ids = list(model.ids(tokens))
                part = model.decode_part(ids)
            value = "".join([f" {i}" for i in ids]), part if part == segment.replace(BLANK, " ") else None
        if len(segment) <= MAX_STORED_CHARS:
            if len(self) >= MAX_STORED:
                self.old = dict(self)
                self.clear()
            self[segment] = value
        return value

    def encode_decode(self, text: str) -> tuple[str, str]:
        """Decimal ids, each after a blank, and the text decoded from them."""
        found = [self[s] for s in self.model.segments(self.model.normalized(text))]
        ids = "".join([i for i, _ in found])
        try:
            decoded = "".join([part for _, part in found])
        except TypeError:  # a part that needs its neighbours
            decoded = self.model.decode_part(map(int, ids.split()))
        return ids, decoded.removeprefix(" ")


@lru_cache(maxsize=1)
def worker_store(model_path: str) -> Stored:
    """The model and its store, once for all tasks of a Python worker."""
    return Stored(PieceModel(model_path))


def encode_decode(docs: DataFrame, model_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
                  with_values: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, where wanted, ids and decoded."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_values:
        schema += ", ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored = worker_store(model_path)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                ids, decoded = stored.encode_decode(text or "")
                ids = f"{ids} {end_id}"[1:]
                row = [ids.count(" ") + 1, sha(ids), sha(decoded)]
                rows.append(row + [list(map(int, ids.split(" "))), decoded] if with_values else row)
            if rows:
                types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
                columns = [batch.column(0)] + [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][:len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
