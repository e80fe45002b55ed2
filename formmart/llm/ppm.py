"""Language-model scores by prediction by partial matching (PPM) over bytes.

The model is a trie of byte contexts of up to ``order`` bytes with the counts of
the symbol that followed (a byte, or the text's end).  A symbol is coded in the
longest context that the model has.  There, a symbol with count c has
probability c / (n + d) (n: the context's total, d: its distinct symbols); a new
symbol escapes with d / (n + d) to the context shorter by a byte, where all
symbols of the longer one are excluded, and in the end to an even share of the
symbols never seen.  A text is preceded by ``order`` zero bytes; its score is the
log10 of the product over its bytes and its end.

Texts are stored in chunks.  Each chunk sends each of its distinct events
(context and symbol) once, with its count in the chunk's training texts, 0 where
only held-out texts have it.  Their sums are the counts of the longest contexts,
from which those of every shorter order follow.  The log10 probabilities come
from joins, order by order: an event is joined with the same symbol's event in
the context shorter by a byte (each has at most 256 longer ones), and a context's
totals are sums over its at most 257 symbols.  From four bytes on, the events
are grouped by their last three bytes of context instead.  The values go back to the chunks
by a join, and each chunk is scored as a whole.  The trie holds all contexts of
the training texts at every size of the corpus, and is in no task, on no driver
and in no broadcast as a whole.  Tables and shuffle files that no later step
reads are deleted, and the chunks are scored in ``PASSES`` parts, so that the
disks hold the texts, words and logs of all chunks once and one part's a second
time.  (``min_share`` leaves out contexts with less
than that share of all symbols, for callers who ask for it.)

The base score is a unigram model of words with add-one smoothing, over counts
of all training texts.  Each chunk sends each of its distinct words once and
gets back the word's count.  No word list is ever held for the whole corpus.
Words are split, counted and looked up in Arrow columns of about ``WORD_BYTES``
of text, without an object for each word.

Edge cases: a null text is empty and consists of its end; without training texts
all symbols are equally likely; a null doc_id counts as empty text for the fold;
texts of any length are scored whole; repeated rows are scored, and train, row
by row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formmart.llm.common import dropped, stored, written

END = 256             # the symbol after a text's last byte
SYMBOLS = 257
END_WORD = b"\n"      # the base model's end token; no word holds a line feed
RUN_BYTES = 1 << 20   # bytes of text turned into events at a time
SCORED_BYTES = 1 << 18  # bytes of text scored at a time
WORD_BYTES = 1 << 22  # bytes of text split into words at a time
HELD_WORDS = 1 << 20  # distinct words of runs that a counting task holds
HELD_EVENTS = 1 << 22  # distinct events that a counting task holds
JOINED = 3            # orders up to this one are scored by joins of rows
BUCKET_EVENTS = 1 << 18  # distinct events of the longer orders in one task
PASSES = 4            # parts of the chunks that are scored one after the other


def events(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (context bytes, then 9 bits of the symbol) of all symbols, and where each text's begin."""
    pad = bytes(order)
    data = np.frombuffer(b"".join([pad + t for t in texts]) + b"\0", np.uint8)
    sizes = np.array([len(t) for t in texts])
    first = np.concatenate([[0], np.cumsum(sizes + order)])[:-1]
    symbols = data.astype(np.uint64)
    symbols[first + sizes + order] = END
    n = len(data) - order
    keys = np.zeros(n, np.uint64)
    for k in range(order):
        keys |= data[k:k + n].astype(np.uint64) << np.uint64(8 * (order - 1 - k) + 9)
    keys |= symbols[order:]
    inside = np.zeros(n + 1, np.int32)  # windows that begin at a text's first order bytes or its own
    inside[first] += 1
    np.add.at(inside, first + sizes + 1, -1)
    keys = keys[np.cumsum(inside[:n]).astype(bool)]
    return keys, np.concatenate([[0], np.cumsum(sizes + 1)])


def _runs(texts: Iterable[bytes], most: int = RUN_BYTES) -> Iterator[list[bytes]]:
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


class PPM:
    """The trie as sorted arrays by order: contexts, and their symbols with counts."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        """levels[j]: sorted keys of order j and their counts; shorter contexts have all symbols of longer ones."""
        self.order = len(levels) - 1
        self.keys = [k for k, _ in levels]
        self.counts = [c.astype(np.float64) for _, c in levels]
        self.contexts, self.weight, self.escape = [], [], []
        self.reduced, self.reduced_escape = [], []
        totals = []
        for j, (keys, counts) in enumerate(levels):
            contexts, first = np.unique(keys >> np.uint64(9), return_index=True)
            n = np.add.reduceat(counts.astype(np.float64), first) if len(first) else np.zeros(0)
            d = np.diff(np.concatenate([first, [len(keys)]])).astype(np.float64)
            room = np.where(d < SYMBOLS, d, 0.0)  # nothing is left to escape to when all symbols were seen
            self.contexts.append(contexts)
            self.weight.append(n + room)
            with np.errstate(divide="ignore"):
                self.escape.append(np.log10(room / np.maximum(n + room, 1)))
            totals.append((n, d))
            if j == 0:
                self.reduced.append(None)
                self.reduced_escape.append(None)
                continue
            # what the next shorter context has besides the symbols of this one
            up = self._find(self.contexts[j - 1], contexts & self._mask(j - 1, 0))
            at = self._find(self.keys[j - 1], keys & self._mask(j - 1, 9))
            excluded = np.add.reduceat(self.counts[j - 1][at], first) if len(first) else np.zeros(0)
            rest_n, rest_d = totals[j - 1][0][up] - excluded, totals[j - 1][1][up] - d
            rest_room = np.where(totals[j - 1][1][up] < SYMBOLS, rest_d, 0.0)
            weight = rest_n + rest_room
            self.reduced.append(weight)
            with np.errstate(divide="ignore", invalid="ignore"):
                self.reduced_escape.append(np.where(weight > 0, np.log10(rest_room / weight), 0.0))

    @staticmethod
    def _mask(order: int, bits: int) -> np.uint64:
        return np.uint64((1 << (8 * order + bits)) - 1)

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Places in a sorted table, -1 where it lacks the key."""
        if not len(table):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where(table[at] == keys, at, -1)

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each event of the full order."""
        out = np.zeros(len(keys))
        todo = np.arange(len(keys))
        longer = np.full(len(keys), -1)  # place of the context escaped from, one order up
        for j in range(self.order, -1, -1):
            key = keys[todo] & self._mask(j, 9)
            context = self._find(self.contexts[j], key >> np.uint64(9))
            at = self._find(self.keys[j], key)
            here = context >= 0
            escaped = longer[todo] >= 0
            if j < self.order and escaped.any():
                up = longer[todo]
                weight = np.where(escaped, self.reduced[j + 1][up], 0.0)
                escape = np.where(escaped, self.reduced_escape[j + 1][up], 0.0)
            else:
                weight = escape = np.zeros(len(todo))
            if len(self.weight[j]):
                weight = np.where(escaped, weight, self.weight[j][context])
                escape = np.where(escaped, escape, self.escape[j][context])
            hit = here & (at >= 0)
            out[todo[hit]] += np.log10(self.counts[j][at[hit]] / weight[hit])
            missed = here & ~hit
            out[todo[missed]] += escape[missed]
            longer[todo] = np.where(here, context, -1)
            todo = todo[~hit]
            if not len(todo):
                return out
        seen = len(self.keys[0])
        out[todo] -= np.log10(SYMBOLS - seen)
        return out

    def score(self, texts: list[bytes]) -> list[float]:
        """log10 probability of each text and its end."""
        out: list[float] = []
        for run in _runs(texts):
            keys, first = events(run, self.order)
            unique, where = np.unique(keys, return_inverse=True)
            out += np.add.reduceat(self.log10(unique)[where], first[:-1]).tolist()
        return out


def count_events(texts: DataFrame, order: int) -> DataFrame:
    """(key, n): how often each symbol followed each context of the full order, over all rows of a text column."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for run in _runs([(t or "").encode() for t in batch.column(0).to_pylist()]):
                held.append(np.unique(events(run, order)[0], return_counts=True))
            if sum(len(k) for k, _ in held) > HELD_EVENTS:
                held = [_summed(*map(np.concatenate, zip(*held)))]
                if len(held[0][0]) > HELD_EVENTS // 2:
                    yield _event_batch(*held.pop())
        if held:
            yield _event_batch(*_summed(*map(np.concatenate, zip(*held))))

    return texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _event_batch(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["key", "n"])


def train(texts: DataFrame, order: int = 5, min_share: float = 0.0) -> PPM:
    """The trie over all rows of a text column as one object on the driver, for small corpora; score_corpus has none."""
    counted = written(count_events(texts, order), "ppm_events")
    shorter = [counted.groupBy(F.col("key").bitwiseAND((1 << (8 * j + 9)) - 1).alias("key")).agg(F.sum("n").alias("n"))
               .select(F.lit(j).alias("j"), "key", "n") for j in range(order)]
    levels = reduce(DataFrame.unionByName, shorter, counted.select(F.lit(order).alias("j"), "key", "n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    of_context = Window.partitionBy("j", F.shiftright("key", 9))
    held = levels.withColumn("all", F.sum("n").over(of_context)).where(F.col("all") >= min_share * total)
    rows = held.select(F.col("j").cast("byte").alias("j"), "key", "n").toArrow()
    out = []
    for j in range(order + 1):
        here = rows["j"].to_numpy() == j
        keys, counts = rows["key"].to_numpy()[here].view(np.uint64), rows["n"].to_numpy()[here]
        at = np.argsort(keys)
        out.append((keys[at], counts[at]))
    return PPM(out)


def _longer_logs(keys: np.ndarray, counts: np.ndarray, up: dict[str, np.ndarray], first: int, order: int,
                 least: float) -> tuple[np.ndarray, np.ndarray]:
    """Sorted events of the full order and their logs, from all of some contexts of order first - 1.

    ``up``: the rows of ``_shorter_levels`` of that order, sorted by key.  The formulas are the same.
    """
    for j in range(first, order + 1):
        key, n = _summed(keys & np.uint64((1 << (8 * j + 9)) - 1), counts)
        above = np.searchsorted(up["key"], key & np.uint64((1 << (8 * j + 1)) - 1))
        up = {c: x[above] for c, x in up.items()}
        begin = np.flatnonzero(np.concatenate([[True], key[1:] >> np.uint64(9) != key[:-1] >> np.uint64(9)]))
        size = np.diff(np.append(begin, len(key)))
        of_context = lambda x: np.repeat(np.add.reduceat(x, begin), size)
        total, seen, excluded = of_context(n), of_context((n > 0).astype(np.int64)), of_context(np.where(n > 0, up["n"], 0))
        kept = total >= least
        n, total, seen = n * kept, total * kept, seen * kept
        rest_room = np.where(up["seen"] < SYMBOLS, up["seen"] - seen, 0)
        weight = up["all"] - excluded + rest_room
        room = np.where(seen < SYMBOLS, seen, 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(weight > 0, np.log10(rest_room / weight), 0.0)
            below = np.where(up["n"] > 0, np.log10(up["n"] / weight), escape + up["log_below"])
            below = np.where(total == 0, up["log"], below)
            log = np.where(n > 0, np.log10(n / (total + room)),
                           np.where(total > 0, np.log10(room / (total + room)) + below, below))
        up = {"key": key, "n": n, "all": total, "seen": seen, "log_below": below, "log": log}
    return up["key"], up["log"]


def _shorter_levels(counted: DataFrame, order: int, least: float, name: str = "ppm_level") -> DataFrame:
    """The events of an order with n, their context's all and seen, log_below (of a new symbol) and log.

    ``counted``: (key, n) of that order; contexts with fewer than ``least`` symbols count as absent.
    """
    levels = [counted]
    for j in range(order - 1, -1, -1):
        shorter = levels[0].groupBy(F.col("key").bitwiseAND((1 << (8 * j + 9)) - 1).alias("key")).agg(F.sum("n").alias("n"))
        levels.insert(0, stored(shorter, f"{name}_{j}"))
    of_context = Window.partitionBy(F.shiftright("key", 9))
    rows = None
    for j, level in enumerate(levels):
        # up_*: the same symbol in the context shorter by a byte
        if j:
            up = rows.select(F.col("key").alias("up"), *[F.col(c).alias(f"up_{c}") for c in ("n", "all", "seen", "log_below", "log")])
            level = level.withColumn("up", F.col("key").bitwiseAND((1 << (8 * j + 1)) - 1)).join(up, "up")
        sums = {"all": F.sum("n"), "seen": F.count_if(F.col("n") > 0)}
        if j:
            sums["excluded"] = F.sum(F.when(F.col("n") > 0, F.col("up_n")).otherwise(0))
        level = level.withColumns({c: x.over(of_context) for c, x in sums.items()})
        kept = F.col("all") >= least
        level = level.withColumns({c: F.when(kept, F.col(c)).otherwise(0) for c in ("n", "all", "seen")})
        if j:
            rest_room = F.when(F.col("up_seen") < SYMBOLS, F.col("up_seen") - F.col("seen")).otherwise(0)
            weight = F.col("up_all") - F.col("excluded") + rest_room
            escape = F.when(weight > 0, F.log10(rest_room / weight)).otherwise(0.0)
            log_below = (F.when(F.col("all") == 0, F.col("up_log")).when(F.col("up_n") > 0, F.log10(F.col("up_n") / weight))
                         .otherwise(escape + F.col("up_log_below")))
        else:
            log_below = -F.log10(F.lit(SYMBOLS) - F.col("seen"))
        room = F.when(F.col("seen") < SYMBOLS, F.col("seen")).otherwise(0)
        rows = level.withColumn("log_below", F.when(F.col("n") == 0, log_below).otherwise(0.0)).select(
            "key", "n", "all", "seen", "log_below",
            F.when(F.col("n") > 0, F.log10(F.col("n") / (F.col("all") + room)))
            .when(F.col("all") > 0, F.log10(room / (F.col("all") + room)) + F.col("log_below"))
            .otherwise(F.col("log_below")).alias("log"))
    return rows


def event_logs(counted: DataFrame, order: int, min_share: float = 0.0) -> DataFrame:
    """(key, log): log10 probability of each event of the full order in ``counted``.

    ``counted``: each event's key and training count n, 0 for one that is only asked for.
    Up to JOINED bytes of context every order is joined with the next shorter one.  The longer
    orders of a context of JOINED bytes are in one task, which the alphabet bounds; tasks
    take such contexts by a hash, about BUCKET_EVENTS events each.
    """
    size = counted.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).first()
    least = min_share * (size.n or 0)
    if order <= JOINED:
        return _shorter_levels(counted, order, least).select("key", "log")
    mask = (1 << (8 * JOINED + 9)) - 1
    joined = stored(counted.groupBy(F.col("key").bitwiseAND(mask).alias("key")).agg(F.sum("n").alias("n")), f"ppm_level_{JOINED}")
    bucket = F.pmod(F.xxhash64(F.shiftright(F.col("key").bitwiseAND(mask), 9)), F.lit(size.rows // BUCKET_EVENTS + 1)).alias("bucket")

    def logs(key: tuple, rows: pa.Table, up: pa.Table) -> pa.Table:
        at = np.argsort(up["key"].to_numpy())
        up = {c: up[c].to_numpy()[at] for c in ("key", "n", "all", "seen", "log_below", "log")}
        up["key"] = up["key"].view(np.uint64)
        keys, log = _longer_logs(rows["key"].to_numpy().view(np.uint64), rows["n"].to_numpy(), up, JOINED + 1, order, least)
        return pa.table({"key": keys.view(np.int64), "log": log})

    return (counted.select(bucket, "key", "n").groupBy("bucket")
            .cogroup(_shorter_levels(joined, JOINED, least).select(bucket, "*").groupBy("bucket"))
            .applyInArrow(logs, "key long, log double"))


def _chunked(docs: DataFrame, chunk_chars: int) -> DataFrame:
    """The rows with the number of their chunk, stored."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            numbers = []
            for n in batch.column(0).to_pylist():
                if size and size + n > chunk_chars:
                    chunk, size = chunk + 1, 0
                size += n
                numbers.append(chunk)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), *batch.columns[1:]],
                                             names=["chunk", "doc_id", "held_out", "text"])

    sized = docs.select(F.length("text").alias("size"), "doc_id", "held_out", "text")
    return stored(sized.mapInArrow(number, "chunk long, doc_id long, held_out boolean, text string"), "chunks")


def _word_runs(texts: pa.Array) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """Ranges of texts of about WORD_BYTES, their words as in ``low_words`` one after another, and each text's number of words."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
    begin = 0
    while begin < len(texts):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + WORD_BYTES, side="right")))
        split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts.slice(begin, end - begin))))
        words, n = split.flatten(), pc.list_value_length(split).to_numpy().astype(np.int64)
        alone = np.flatnonzero(n == 1)  # a text without words is split into one empty word
        empty = alone[pc.equal(words.take((np.cumsum(n) - n)[alone]), "").to_numpy(zero_copy_only=False)]
        if len(empty):
            n[empty] = 0
            words = words.filter(pc.not_equal(words, ""))
        yield begin, end, words, n
        begin = end


def _words_summed(held: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    """Distinct words and the sums of their counts."""
    words, n = pa.concat_arrays([w for w, _ in held]).dictionary_encode(), np.concatenate([n for _, n in held])
    out = np.zeros(len(words.dictionary), np.int64)
    np.add.at(out, words.indices.to_numpy(), n)
    return words.dictionary, out


def _chunk_words(chunks: DataFrame) -> DataFrame:
    """(chunk, word, n): the distinct words of each chunk, and how often its training texts have them."""
    schema = pa.schema([("chunk", pa.int64()), ("word", pa.string()), ("n", pa.int64())])
    end_word = pa.array([END_WORD.decode()], pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def done() -> pa.RecordBatch:
            words, n = _words_summed(held)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(words), now)), words, pa.array(n)], schema=schema)

        for batch in batches:
            numbers = batch["chunk"].to_numpy()
            trains = ~batch["held_out"].fill_null(False).to_numpy(zero_copy_only=False)
            texts = batch["text"].cast(pa.string())
            first = np.flatnonzero(np.diff(numbers, prepend=numbers[:1] - 1))  # rows of a chunk lie together
            for at, to in zip(first, np.append(first[1:], len(numbers))):
                if numbers[at] != now:
                    if now is not None:
                        yield done()
                    now = numbers[at]
                for begin, end, words, n in _word_runs(texts.slice(at, to - at)):
                    own = trains[at + begin:at + end]
                    coded = words.dictionary_encode()
                    counts = np.bincount(coded.indices.to_numpy()[np.repeat(own, n)], minlength=len(coded.dictionary))
                    held += [(coded.dictionary, counts.astype(np.int64)), (end_word, np.array([own.sum()], np.int64))]
                    if sum(len(w) for w, _ in held) > max(HELD_WORDS, 2 * len(held[0][0])):
                        held[:] = [_words_summed(held)]
        if now is not None:
            yield done()

    return chunks.select("chunk", "held_out", "text").mapInArrow(count, "chunk long, word string, n long")


def _chunk_events(chunks: DataFrame, order: int) -> DataFrame:
    """(chunk, key, n): the distinct events of each chunk, and how often its training texts have them; stored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, size, texts, held = None, 0, {True: [], False: []}, []

        def run() -> None:
            for held_out, ts in texts.items():
                if ts:
                    keys, n = np.unique(events(ts, order)[0], return_counts=True)
                    held.append((keys, n * (not held_out)))
                    ts.clear()
            if sum(len(k) for k, _ in held) > max(HELD_EVENTS // 4, 2 * len(held[0][0])):
                held[:] = [_summed(*map(np.concatenate, zip(*held)))]

        def done() -> pa.RecordBatch:
            run()
            keys, n = _summed(*map(np.concatenate, zip(*held)))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), now)), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))],
                names=["chunk", "key", "n"])

        for batch in batches:
            for chunk, held_out, text in zip(*(c.to_pylist() for c in batch.columns)):
                if chunk != now:
                    if now is not None:
                        yield done()
                    now, size = chunk, 0
                texts[bool(held_out)].append(text.encode())
                size += len(text)
                if size >= RUN_BYTES:
                    run()
                    size = 0
        if now is not None:
            yield done()

    return stored(chunks.select("chunk", "held_out", "text").mapInArrow(count, "chunk long, key long, n long"), "chunk_events")


def _base_sums(texts: pa.ChunkedArray, given: pa.Table) -> tuple[list[int], list[int], list[float]]:
    """Each text's tokens, its known ones, and the sum of log10(count + 1) over them."""
    words, counts = [], []
    for batch in given.select(["word", "value"]).to_batches():
        here = batch.filter(batch["word"].is_valid())
        words.append(here["word"].cast(pa.string()))
        counts.append(here["value"].to_numpy())
    words, counts = pa.concat_arrays(words), np.concatenate(counts)
    log_counts = np.log10(counts + 1.0)
    end_word = pc.index(words, END_WORD.decode()).as_py()
    n_tokens, n_known, logs = [], [], []
    for part in texts.cast(pa.string()).chunks:
        for _, _, run, n in _word_runs(part):
            last = np.cumsum(n)
            at = np.insert(pc.index_in(run, value_set=words).to_numpy(), last, end_word)
            last += np.arange(1, len(n) + 1)
            first = last - n - 1
            n_tokens += (n + 1).tolist()
            n_known += np.add.reduceat(counts[at] > 0, first, dtype=np.int64).tolist()
            log = log_counts[at]
            logs += [float(log[b:e].sum()) for b, e in zip(first.tolist(), last.tolist())]
    return n_tokens, n_known, logs


def _score_chunk(rows: pa.Table, given: pa.Table, order: int) -> pa.Table:
    """The scores of a chunk's texts.  ``given``: a word's row has its count as value, an event's its key, and a log.

    Words come first and are freed before the events; each needs arrays of a short run of text alone.
    """
    n_tokens, n_known, logs = _base_sums(rows["text"], given)
    scores = []
    pa.default_memory_pool().release_unused()
    texts = rows["text"].cast(pa.binary()).chunks
    event, log = [], []
    for batch in given.select(["value", "log"]).to_batches():
        here = batch.filter(batch["log"].is_valid())
        event.append(here["value"].to_numpy())
        log.append(here["log"].to_numpy())
    event, log = np.concatenate(event).view(np.uint64), np.concatenate(log)
    at = np.argsort(event)
    event, log = event[at], log[at]
    del at
    for run in _runs((t.as_py() for part in texts for t in part), SCORED_BYTES):
        keys, begin = events(run, order)
        unique, where = np.unique(keys, return_inverse=True)
        scores += np.add.reduceat(log[np.searchsorted(event, unique)][where], begin[:-1]).tolist()
    out = rows.select(["doc_id", "held_out"])
    for name, values, kind in (("n_tokens", n_tokens, pa.int64()), ("n_known", n_known, pa.int64()),
                               ("log_counts", logs, pa.float64()), ("score", scores, pa.float64())):
        out = out.append_column(name, pa.array(values, kind))
    return out


def score_corpus(docs: DataFrame, held_out, order: int = 5, min_share: float = 0.0, doc_id: str = "doc_id",
                 text: str = "text", chunk_chars: int = 24_000_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    chunks = _chunked(docs, chunk_chars)
    chunk_events = _chunk_events(chunks, order)
    counted = stored(chunk_events.groupBy("key").agg(F.sum("n").alias("n")), "ppm_events")
    logs = stored(event_logs(counted, order, min_share), "ppm_logs")
    dropped(counted)
    part = F.pmod(F.xxhash64("chunk"), F.lit(PASSES)).cast("int")
    chunk_logs = stored(chunk_events.select("chunk", "key").join(logs, "key").withColumn("part", part), "chunk_logs", "part")
    dropped(chunk_events)
    dropped(logs)
    of_word = Window.partitionBy("word")
    chunk_words = stored(_chunk_words(chunks).withColumn("c", F.sum("n").over(of_word))
                         .withColumn("first", F.row_number().over(of_word.orderBy("chunk")) == 1)
                         .withColumn("part", part), "chunk_words", "part")
    totals = chunk_words.agg(F.count_if(F.col("first") & (F.col("c") > 0)).alias("v"), F.sum("n").alias("n")).first()
    n, v = totals.n or 0, totals.v or 0
    known_of_chunk = (chunk_words.select("chunk", "word", F.col("c").alias("value"), F.lit(None).cast("double").alias("log"), "part")
                      .unionByName(chunk_logs.select("chunk", F.lit(None).cast("string").alias("word"), F.col("key").alias("value"),
                                                     "log", "part")))

    def score(key: tuple, rows: pa.Table, given: pa.Table) -> pa.Table:
        return _score_chunk(rows, given, order)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double"
    passes = [stored(chunks.where(part == i).groupBy("chunk").cogroup(known_of_chunk.where(F.col("part") == i).drop("part").groupBy("chunk"))
                     .applyInArrow(score, schema), "scored") for i in range(PASSES)]
    scored = reduce(DataFrame.unionByName, passes)
    for df in (chunks, chunk_words, chunk_logs):
        dropped(df)
    base = F.col("log_counts") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         base.alias("base_score"), "score")
