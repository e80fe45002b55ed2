"""Packing of tokenized documents into windows of a fixed length, online with bounded space.

Each partition keeps at most ``open_windows`` windows open.  A document's full
windows go out at once; what remains of it is placed best-fit (the open window
with the least room that still holds it).  When none fits and no more may be
opened, the fullest window takes the head of the piece and is emitted, full; the
rest of the piece is placed again.  What is open at the end of a partition is
joined into full windows and at most one partial one.  The partial windows of
all partitions are then merged in rounds: groups of ``fan_in`` partitions give
full windows and at most one partial window each, until one is left, the only
window of the corpus that isn't full.

Memory of a task: the open windows and one Arrow batch.  A merging group holds
at most ``fan_in`` partial windows.  The pieces are written before they are
read, so that a lost executor can't change a window after it was used.

Edge cases: a null text counts as empty and still has its end token; an empty
table gives no rows; repeated rows are documents of their own; other columns of
the input are ignored; of equally full windows the one opened last is taken; a
text of any length is encoded whole, in one row, and fills windows of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formmart.llm.common import written
from formmart.llm.word_ids import WordIds

TOKEN_BYTES = 4  # ids are unsigned 32-bit, little-endian
_ROUND_SHIFT, _GROUP_SHIFT = 58, 34  # sequence_id: round, partition or group, number there

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                "offset long, part long, ids binary")
_ARROW = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                              "offset", "part")] + [("ids", pa.binary())])


class Piece:
    """A run of a document's ids."""

    __slots__ = ("doc_id", "start", "ids", "doc_tokens")

    def __init__(self, doc_id, start: int, ids: bytes, doc_tokens: int):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def __len__(self) -> int:
        return len(self.ids) // TOKEN_BYTES

    def cut(self, head: int) -> tuple[Piece, Piece]:
        at = head * TOKEN_BYTES
        return (Piece(self.doc_id, self.start, self.ids[:at], self.doc_tokens),
                Piece(self.doc_id, self.start + head, self.ids[at:], self.doc_tokens))


class Packer:
    """The open windows of one task; ``full`` collects the windows that are done."""

    def __init__(self, window: int, open_windows: int):
        self.window, self.most = window, open_windows
        self.open: list[tuple[int, list[Piece]]] = []  # tokens used, pieces
        self.full: list[list[Piece]] = []

    def add(self, piece: Piece) -> None:
        while len(piece) >= self.window:
            head, piece = piece.cut(self.window)
            self.full.append([head])
        while len(piece):
            need = len(piece)
            fits = [(used, i) for i, (used, _) in enumerate(self.open) if used + need <= self.window]
            if fits:
                used, i = max(fits)
                self._put(i, piece)
                return
            if len(self.open) < self.most:
                self.open.append((need, [piece]))
                return
            used, i = max((used, i) for i, (used, _) in enumerate(self.open))
            head, piece = piece.cut(self.window - used)
            self._put(i, head)

    def _put(self, i: int, piece: Piece) -> None:
        used, pieces = self.open[i]
        pieces.append(piece)
        if used + len(piece) == self.window:
            self.full.append(pieces)
            self.open.pop(i)
        else:
            self.open[i] = (used + len(piece), pieces)

    def close(self) -> list[Piece]:
        """Join the open windows, the fullest first; the pieces of the one that stays partial."""
        last: list[Piece] = []
        room = self.window
        for _, pieces in sorted(self.open, key=lambda x: -x[0]):
            for piece in pieces:
                while len(piece) >= room:
                    head, piece = piece.cut(room)
                    self.full.append(last + [head])
                    last, room = [], self.window
                if len(piece):
                    last.append(piece)
                    room -= len(piece)
        self.open = []
        return last


def _rows(windows: list[list[Piece]], first_id: int) -> Iterator[tuple]:
    for n, pieces in enumerate(windows):
        offset = 0
        for p in pieces:
            yield p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, first_id + n, offset, None, None
            offset += len(p)


def _left(pieces: list[Piece], part: int) -> Iterator[tuple]:
    for p in pieces:
        yield p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, None, None, part, p.ids


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = 2048, open_windows: int = 32,
         fan_in: int = 64, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents with their sequence and offset there (see the module's text)."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, packer, done = WordIds(tokenizer_path), Packer(window, open_windows), part << _GROUP_SHIFT
        end = end_id.to_bytes(TOKEN_BYTES, "little")
        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), encode.texts(batch.column(1))):
                ids += end
                packer.add(Piece(key, 0, ids, len(ids) // TOKEN_BYTES))
            rows, done, packer.full = list(_rows(packer.full, done)), done + len(packer.full), []
            if rows:
                yield _batch(rows)
        left = packer.close()
        rows = [*_rows(packer.full, done), *_left(left, part)]
        if rows:
            yield _batch(rows)

    def merge(level: int):
        def of_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["part", "n"])
            packer = Packer(window, open_windows)
            for r in pdf.itertuples(index=False):
                packer.add(Piece(None if pd.isna(r.doc_id) else int(r.doc_id), int(r.start), bytes(r.ids),
                                 int(r.doc_tokens)))
            left = packer.close()
            first_id = (level << _ROUND_SHIFT) + (int(key[0]) << _GROUP_SHIFT)
            if pdf["last"].iloc[0] and left:  # nothing to merge with: the one window that stays partial
                packer.full.append(left)
                left = []
            rows = [*_rows(packer.full, first_id), *_left(left, int(key[0]))]
            return pd.DataFrame(rows, columns=_ARROW.names).astype(
                {c: "Int64" for c in _ARROW.names if c != "ids"})
        return of_group

    stored = written(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
                     .mapInArrow(first, PIECE_SCHEMA), "packed")
    out = [stored.where("sequence_id IS NOT NULL")]
    level = 1
    while True:
        left = stored.where("sequence_id IS NULL")
        most = left.agg(F.max("part")).first()[0]
        if most is None:
            break
        stored = written(
            left.withColumn("n", F.xxhash64("doc_id", "start", "ids_crc32"))
            .withColumn("last", F.lit(most < fan_in))
            .groupBy(F.floor(F.col("part") / fan_in).cast("long").alias("grp"))
            .applyInPandas(merge(level), PIECE_SCHEMA), f"packed_{level}")
        out.append(stored.where("sequence_id IS NOT NULL"))
        level += 1
        if most < fan_in:
            break
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result.drop("part", "ids")
