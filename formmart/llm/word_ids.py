"""Ids of a ``tokenizers`` file, encoded word by word with a bounded store of known words.

For tokenizers that normalize to NFC and lower case, drop white space and split
runs of letters, single digits and runs of other marks, cutting a text at blanks
and line feeds gives the same ids as encoding it whole: no pre-token and no
composition of characters goes across a blank (the tests compare the two, for
every code point before a full stop and a comma).  A batch is cut into distinct
words at once; only words that aren't known yet are encoded.  So that more are
known, A-Z are lower-cased first in texts that hold no added token, which is
matched in the raw text, and no character from U+0300 on, which may combine with
a letter of one case alone; and a new word that ends in a Latin letter or a digit
and a full stop or comma is put together from the ids of both parts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The store starts anew when it holds this many words or characters.
MAX_WORDS = 1 << 19
MAX_CHARS = 1 << 24

_COMBINING = r"[\x{0300}-\x{10FFFF}]"
#: The letters from U+00C0 on stay single letters in lower case and normal form, U+0130 alone excepted.
_LATIN = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_ENDED = re.compile(f"[{_LATIN}0-9][.,]\\Z")
_LETTERS = re.compile(f"[{_LATIN}]+")


class WordIds:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.added = tuple(t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values())
        # what the byte-level pre-tokenizer writes for the bytes of letters
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_chars = {}
        for c in map(chr, range(0x80, 0x800)):
            self.byte_chars.update(zip(c.encode(), level.pre_tokenize_str(c)[0][0]))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # word: its place in starts and lengths
        self.chars = 0
        self.ids = np.zeros(0, np.uint32)
        self.starts = self.lengths = np.zeros(0, np.int64)

    def _places(self, words: list[str]) -> np.ndarray:
        """Where each of the distinct words is stored, after encoding the new ones."""
        if len(self.known) >= MAX_WORDS or self.chars >= MAX_CHARS:
            self._forget()
        known = self.known
        new = [w for w in words if w not in known]
        ended = [w for w in new if _ENDED.search(w)]
        alone = set(new).difference(ended)
        unseen = [w for w in alone.union([w[:-1] for w in ended], ".,") if w not in known]
        # a word of Latin letters is one pre-token: its lower case goes to the merges at once
        letters = [w for w in unseen if _LETTERS.fullmatch(w)]
        others = [w for w in unseen if not _LETTERS.fullmatch(w)]
        unseen = letters + others
        merge, byte_chars = self.tokenizer.model.tokenize, self.byte_chars
        coded = [[t.id for t in merge(w.lower() if w.isascii() else w.lower().encode().decode("latin-1").translate(byte_chars))]
                 for w in letters]
        coded += [e.ids for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        of = dict(zip(unseen, coded))
        for w in ended:
            coded.append([*self._ids(of, w[:-1]), *self._ids(of, w[-1])])
        if coded:
            known.update(zip([*unseen, *ended], range(len(self.starts), len(self.starts) + len(coded))))
            lengths = np.fromiter(map(len, coded), np.int64, len(coded))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(coded), np.uint32)])
        self.chars += sum(map(len, new))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def _ids(self, fresh: dict[str, list[int]], word: str) -> list[int]:
        if word in fresh:
            return fresh[word]
        at = self.known[word]
        return self.ids[self.starts[at]:self.starts[at] + self.lengths[at]].tolist()

    def _lowered(self, texts: pa.Array) -> pa.Array:
        """Texts with A-Z lower-cased, but for those where that could change an id."""
        low = pc.ascii_lower(texts)
        raw = pc.match_substring_regex(texts, _COMBINING)
        for token in self.added:
            raw = pc.or_(raw, pc.match_substring(low, token))
        return pc.if_else(raw, texts, low)

    def texts(self, texts: pa.Array | list[str | None], chunk: int = 2048) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        for at in range(0, len(texts), chunk):
            lists = pc.split_pattern(pc.replace_substring(self._lowered(texts.slice(at, chunk)), "\n", " "), " ")
            coded = lists.flatten().dictionary_encode()
            place = self._places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            lengths = self.lengths[place]
            ends = np.concatenate([[0], np.cumsum(lengths)])
            # place of an id: its word's start, and how far into the word
            kind = np.int32 if ends[-1] + len(self.ids) < 1 << 31 else np.int64
            gather = np.repeat((self.starts[place] - ends[:-1]).astype(kind), lengths)
            gather += np.arange(len(gather), dtype=kind)
            data = self.ids[gather].astype("<u4", copy=False).tobytes()
            bounds = 4 * ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                yield data[a:b]
