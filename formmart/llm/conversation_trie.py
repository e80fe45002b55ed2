"""Prefix trie of conversations, built from sorted neighbours.

A conversation is a sequence of turns; a turn is a 16-byte digest of role and
text with the text's size, and each turn's digest is chained with those before it,
so that equal chain values mean equal beginnings.  Sorted by their chains,
conversations that begin alike are neighbours, and the length that two neighbours
share (their LCP) is an edge between them.

*Union-find in descending depth.*  A task walks its range of the sorted distinct
conversations.  Edges are taken from the deepest on; an edge of depth d joins the
components on both sides into a node of depth d, their deeper roots become its
children and are finished: a finished node covers the depths below its parent's
down to its own.  Sums over conversations travel with the components, so the trie
itself is never held.

*Borders.*  A component at the end of a range may go on in the next one.  Edges
whose components aren't complete are left; what remains of a range is a chain of
open components whose edges fall and then rise, at most two for each depth.  These
contracted ranges are merged with their neighbours, ``FAN`` at a time, by the
same union-find, until one is left; its ends are closed and the root is finished.

Edge cases: rows without a conv_id belong to no conversation; null roles and
texts are empty; null turns come first, turns of equal number are ordered by role
and by the text's digest, and repeated rows are turns of their own; with ``base``
a conversation without its own turns left may be empty and ends at the root;
conversations of equal content share all nodes; an empty table has no node, not
even the root; columns are read by name, others are ignored.  A conversation of
many turns is read and sorted over several tasks, its digests (24 bytes a turn)
then fit one row; texts aren't moved.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formmart.llm.common import written
from formmart.operators.joins import salted_join

ROOT = bytes(16)
#: Turns in a piece of a conversation, ids in a piece of a list, open components before a contraction, ranges merged by a task.
PIECE_TURNS = 1 << 12
PIECE_IDS = 1 << 16
OPEN = 1 << 14
FAN = 64

_NODE = ("key binary, depth int, parent_key binary, parent_depth int, conv_id long, n_convs long, n_children long, "
         "n_leaves long, member_bytes long, first_bytes long, later_bytes long, above array<long>")
_OUT = f"{_NODE}, part long, block binary"


class Component:
    """Neighbours that share ``depth`` turns.

    ``sizes[d]`` is the size of the first d turns; member_bytes that of all
    members' turns, first_bytes that of the first distinct conversation, and
    later_bytes that of each later one behind what it shares with the one before.
    """

    __slots__ = ("key", "depth", "sizes", "conv_id", "n_convs", "n_children", "n_leaves", "member_bytes", "first_bytes",
                 "later_bytes")

    def __init__(self, key, depth, sizes, conv_id, n_convs, n_children=0, n_leaves=0, member_bytes=0, first_bytes=0,
                 later_bytes=0):
        self.key, self.depth, self.sizes, self.conv_id, self.n_convs = key, depth, sizes, conv_id, n_convs
        self.n_children, self.n_leaves = n_children, n_leaves
        self.member_bytes, self.first_bytes, self.later_bytes = member_bytes, first_bytes, later_bytes

    @classmethod
    def of(cls, chain: bytes, sizes: np.ndarray, conv_id: int, n_convs: int) -> Component:
        total = int(sizes[-1])
        return cls(chain[-16:] or ROOT, len(sizes) - 1, sizes, conv_id, n_convs, member_bytes=n_convs * total, first_bytes=total)

    def finished(self, parent_key: bytes | None, parent_depth: int) -> tuple:
        """The node's row; ``above``: sizes of what lies above each depth that it covers."""
        above = self.sizes[max(parent_depth, 0):self.depth].tolist()
        return (self.key, self.depth, parent_key, parent_depth, self.conv_id, self.n_convs, self.n_children,
                self.n_leaves or 1, self.member_bytes, self.first_bytes, self.later_bytes,
                above if parent_depth >= 0 else [0, *above], None, None)


def joined(left: Component, right: Component, depth: int, key: bytes, emit: Callable[[tuple], None]) -> Component:
    children = leaves = 0
    for side in (left, right):
        if side.depth > depth:
            emit(side.finished(key, depth))
            children, leaves = children + 1, leaves + (side.n_leaves or 1)
        else:
            children, leaves = children + side.n_children, leaves + side.n_leaves
    return Component(key, depth, left.sizes[:depth + 1], min(left.conv_id, right.conv_id), left.n_convs + right.n_convs,
                     children, leaves, left.member_bytes + right.member_bytes, left.first_bytes,
                     left.later_bytes + right.later_bytes + right.first_bytes - int(left.sizes[depth]))


def contract(components: list[Component], edges: list[tuple[int, bytes]], emit: Callable[[tuple], None],
             closed: bool = False) -> tuple[list[Component], list[tuple[int, bytes]]]:
    """Join along the edges, the deepest first, whatever can't change any more.

    ``edges[i]`` lies between components i and i + 1.  A component that is
    deeper than an edge is finished by it, so its other edge must be known and no
    deeper; beyond the ends of a list that isn't ``closed`` nothing is known.
    """
    top = list(range(len(components)))                # union-find over positions
    low, high = list(top), list(top)                  # ends of the component at its representative
    at = dict(enumerate(components))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    def ready(component: Component, other: int, depth: int) -> bool:
        """``other``: the edge on the component's far side."""
        if 0 <= other < len(edges):
            return edges[other][0] <= depth
        return closed or component.depth == depth

    used = set()
    for e in sorted(range(len(edges)), key=lambda e: -edges[e][0]):
        depth, key = edges[e]
        a, b = find(e), find(e + 1)
        if ready(at[a], low[a] - 1, depth) and ready(at[b], high[b], depth):
            at[a] = joined(at[a], at.pop(b), depth, key, emit)
            top[b], high[a] = a, high[b]
            used.add(e)
    return [at[i] for i in sorted(at)], [edge for e, edge in enumerate(edges) if e not in used]


def shared(a: bytes, b: bytes) -> tuple[int, bytes]:
    """How many turns two chains share, and the chain value there."""
    lo, hi = 0, min(len(a), len(b)) // 16
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[16 * mid - 16:16 * mid] == b[16 * mid - 16:16 * mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo, a[16 * lo - 16:16 * lo] if lo else ROOT


def _table(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)


_OUT_ARROW = pa.schema([("key", pa.binary()), ("depth", pa.int32()), ("parent_key", pa.binary()), ("parent_depth", pa.int32()),
                        *((c, pa.int64()) for c in ("conv_id", "n_convs", "n_children", "n_leaves", "member_bytes",
                                                    "first_bytes", "later_bytes")),
                        ("above", pa.list_(pa.int64())), ("part", pa.int64()), ("block", pa.binary())])


def _block(part: int, components, edges, first: bytes, last: bytes) -> tuple:
    return (None,) * 12 + (part, pickle.dumps((components, edges, first, last)))


def _contract_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished nodes of a sorted range, and one row with what is left of it."""
    components, edges, first, last, rows = [], [], None, None, []
    for batch in batches:
        for chain, sizes, conv_id, n in zip(*(batch.column(c).to_pylist() for c in ("chain", "sizes", "conv_id", "n_convs"))):
            if last is None:
                first = chain
            else:
                edges.append(shared(last, chain))
            components.append(Component.of(chain, np.frombuffer(sizes, "<i8"), conv_id, n))
            last = chain
            if len(components) >= 2 * OPEN:
                components, edges = contract(components, edges, rows.append)
                yield _table(rows, _OUT_ARROW)
                rows.clear()
    if last is not None:
        components, edges = contract(components, edges, rows.append)
        rows.append(_block(TaskContext.get().partitionId(), components, edges, first, last))
        yield _table(rows, _OUT_ARROW)


def _merge(closed: bool):
    def merge(table: pa.Table) -> pa.Table:
        rows = []
        blocks = sorted((part, *pickle.loads(b)) for part, b in zip(table["part"].to_pylist(), table["block"].to_pylist()))
        part, components, edges, first, last = blocks[0]
        for _, more, inner, begins, ends in blocks[1:]:
            edges = [*edges, shared(last, begins), *inner]
            components, last = components + more, ends
        components, edges = contract(components, edges, rows.append, closed)
        if closed:
            rows.append(components[0].finished(None, -1))
        else:
            rows.append(_block(part // FAN, components, edges, first, last))
        return pa.Table.from_batches([_table(rows, _OUT_ARROW)])
    return merge


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns packed by conversation; one that fills more than a piece, or passes a range's end, has several."""
    part, nth = TaskContext.get().partitionId(), 0
    kinds = pa.schema([("base", pa.int64()), ("conv_id", pa.int64()), ("part", pa.int32()), ("nth", pa.int32()),
                       ("digests", pa.binary()), ("bytes", pa.binary())])
    now, base, digests, sizes, rows = None, None, [], [], []

    def close():
        nonlocal nth
        rows.append((base, now, part, nth, b"".join(digests), np.array(sizes, "<i8").tobytes()))
        nth += 1
        digests.clear()
        sizes.clear()

    for batch in batches:
        for b, conv, digest, size in zip(*(batch.column(c).to_pylist() for c in ("base", "conv_id", "digest", "bytes"))):
            if digests and (conv != now or len(digests) >= PIECE_TURNS):
                close()
            now, base = conv, b
            digests.append(digest)
            sizes.append(size)
        yield _table(rows, kinds)
        rows.clear()
    if digests:
        close()
        yield _table(rows, kinds)


def _chains(batches: Iterator[pa.RecordBatch], heads: int) -> Iterator[pa.RecordBatch]:
    """Each conversation in one row, rebuilt with its base's first turns: key, chain, sizes."""
    kinds = pa.schema([("conv_id", pa.int64()), ("key", pa.binary()), ("chain", pa.binary()), ("sizes", pa.binary())])
    now, base, digests, sizes = None, None, [], []
    head = (None, b"", b"")

    def close() -> tuple:
        nonlocal head
        own, own_sizes = b"".join(digests), b"".join(sizes)
        if heads:
            if now == base:
                head = (base, own[:16 * heads], own_sizes[:8 * heads])
            else:
                h = zlib.crc32(str(now).encode()) % (heads + 1)
                before = head[1:] if head[0] == base else (b"", b"")
                own, own_sizes = before[0][:16 * h] + own[16 * h:], before[1][:8 * h] + own_sizes[8 * h:]
        chain, value = [], ROOT
        for i in range(0, len(own), 16):
            value = hashlib.blake2b(value + own[i:i + 16], digest_size=16).digest()
            chain.append(value)
        total = np.concatenate([[0], np.cumsum(np.frombuffer(own_sizes, "<i8"))]).astype("<i8")
        return now, value, b"".join(chain), total.tobytes()

    for batch in batches:
        rows = []
        for b, conv, digest, size in zip(*(batch.column(c).to_pylist() for c in ("base", "conv_id", "digests", "bytes"))):
            if now is not None and conv != now:
                rows.append(close())
                digests.clear()
                sizes.clear()
            now, base = conv, b
            digests.append(digest)
            sizes.append(size)
        yield _table(rows, kinds)
    if now is not None:
        yield _table([close()], kinds)


def _id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) rows as comma-joined lists."""
    kinds = pa.schema([("key", pa.binary()), ("part", pa.int32()), ("nth", pa.int32()), ("conv_id", pa.int64()),
                       ("n_convs", pa.int64()), ("ids", pa.string())])
    part, nth, now, ids, rows = TaskContext.get().partitionId(), 0, None, [], []
    for batch in batches:
        for key, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (key != now or len(ids) >= PIECE_IDS):
                rows.append((now, part, nth, ids[0], len(ids), ",".join(map(str, ids))))
                ids, nth = [], nth + 1
            now = key
            ids.append(conv)
        yield _table(rows, kinds)
        rows.clear()
    if ids:
        yield _table([(now, part, nth, ids[0], len(ids), ",".join(map(str, ids)))], kinds)


def _list_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lists' pieces in order: the least id, their number, the SHA-256 of the whole list."""
    kinds = pa.schema([("key", pa.binary()), ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("ends_sha256", pa.string())])
    now, first, n, sha = None, None, 0, None
    for batch in batches:
        rows = []
        for key, conv, count, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "conv_id", "n_convs", "ids"))):
            if key != now:
                if now is not None:
                    rows.append((now, first, n, sha.hexdigest()))
                now, first, n, sha = key, conv, 0, hashlib.sha256()
            else:
                sha.update(b",")
            n += count
            sha.update(ids.encode())
        yield _table(rows, kinds)
    if now is not None:
        yield _table([(now, first, n, sha.hexdigest())], kinds)


def sequences(df: DataFrame, heads: int = 0, every: int = 5) -> DataFrame:
    """conv_id, key, chain, sizes of every conversation.

    With ``heads``, conversation c begins with the first h turns of conversation
    c - c mod ``every`` (h = crc32 of c as text, modulo heads + 1) in the place of
    its own first h.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = df.select(
        (F.col("conv_id") - F.pmod("conv_id", F.lit(every))).cast("long").alias("base") if heads
        else F.col("conv_id").cast("long").alias("base"),
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.substring(F.unhex(F.sha2(content.cast("binary"), 256)), 1, 16).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes")).where("conv_id IS NOT NULL")
    order = ("conv_id", "turn", "role", "digest")
    pieces = written(turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _pieces, "base long, conv_id long, part int, nth int, digests binary, bytes binary"), "trie_pieces")
    return (pieces.repartition("base").sortWithinPartitions("base", "conv_id", "part", "nth")
            .mapInArrow(lambda batches: _chains(batches, heads), "conv_id long, key binary, chain binary, sizes binary"))


def prefix_trie(df: DataFrame, heads: int = 0, every: int = 5) -> DataFrame:
    """One row for each distinct beginning of the conversations (see ``sequences``) of any number of turns.

    conv_id is the least member; parent_conv_id that of the node one turn
    shorter; n_convs its members, n_children its nodes one turn longer, n_leaves
    the childless ones below or at it; saved_tokens the sum over the nodes below
    or at it of (n_convs - 1) times the size of their last text; ends_sha256 the
    hash of the comma-joined ids of the conversations that end there.
    """
    whole = written(sequences(df, heads, every), "trie_sequences")
    lists = (whole.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
             .mapInArrow(_id_pieces, "key binary, part int, nth int, conv_id long, n_convs long, ids string"))
    ends = written(lists.repartition("key").sortWithinPartitions("key", "part", "nth")
                   .mapInArrow(_list_hashes, "key binary, conv_id long, n_convs long, ends_sha256 string"), "trie_ends")
    distinct = whole.groupBy("key").agg(F.first("chain").alias("chain"), F.first("sizes").alias("sizes"))
    found = written(distinct.join(ends.select("key", "conv_id", "n_convs"), "key").repartitionByRange("chain")
                    .sortWithinPartitions("chain").mapInArrow(_contract_range, _OUT), "trie_ranges")
    nodes, blocks = [found.where("block IS NULL")], found.where("block IS NOT NULL").select("part", "block")
    left = blocks.count()
    while left:
        last = left <= FAN
        group = F.lit(0) if last else F.floor(F.col("part") / FAN)
        found = written(blocks.groupBy(group.alias("g")).applyInArrow(_merge(last), _OUT), "trie_merge")
        nodes.append(found.where("block IS NULL"))
        blocks = found.where("block IS NOT NULL").select("part", "block")
        left = 0 if last else blocks.count()
    tree = reduce(DataFrame.unionByName, nodes).drop("part", "block")

    parents = tree.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above_id"))
    named = (salted_join(tree, parents, "parent_key", "left")
             .join(ends.select("key", "ends_sha256"), "key", "left"))
    rows = named.select("*", F.posexplode("above").alias("step", "size"))
    own = F.col("parent_depth") + 1 + F.col("step")
    lowest = own == F.col("depth")
    return rows.select(
        "conv_id", own.cast("long").alias("depth"),
        F.when(own > 0, F.when(F.col("step") == 0, F.col("above_id")).otherwise(F.col("conv_id"))).alias("parent_conv_id"),
        "n_convs", F.when(lowest, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"), "n_leaves",
        (F.col("member_bytes") - F.col("first_bytes") - F.col("later_bytes") - (F.col("n_convs") - 1) * F.col("size"))
        .alias("saved_tokens"),
        F.when(lowest & F.col("ends_sha256").isNotNull(), F.col("ends_sha256"))
        .otherwise(F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
