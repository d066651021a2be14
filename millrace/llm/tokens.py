"""Token ids of whole texts, by a given tokenizer file.

The tokenizer never joins a word with the space before the next one, so a text whose words are
parted by single spaces and line ends has the ids of its words, one after another. Words recur,
so each worker keeps the ids of those it has met and asks the tokenizer for new ones only. A text
with any other white space goes to the tokenizer as it is.

All texts of a piece are looked up at once: words are known by two 64-bit hashes of their bytes
(should only one of them agree, the text goes to the tokenizer), and the ids of all texts come as
one array. Words of more than ``KEPT_BYTES`` bytes are learnt for their piece only, so that the
memory of a worker is bounded by ``MAX_WORDS`` whatever the texts hold. A piece has at most
``PIECE_ROWS`` texts and, but for a longer text alone, ``PIECE_CHARS`` characters.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

TOKENIZER = "byte_bpe_50k.json"
MAX_WORDS = 1_000_000
KEPT_BYTES = 64
PIECE_ROWS, PIECE_CHARS = 1024, 4_000_000

_ODD = re.compile(r"[^\S \n]")
_SPACE, _LINE_END = 32, 10
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, rows) of bounded pieces of a column of texts."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        rows = int(np.searchsorted(ends, before + PIECE_CHARS, "right")) - first
        rows = min(max(rows, 1), PIECE_ROWS)
        yield first, min(rows, len(ends) - first)
        first += rows


def _hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each of the strings of ``data``, which ends with eight more bytes."""
    eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    out = [size.astype(np.uint64) * f for f in _FACTORS]
    rows, done = np.arange(len(start)), 0
    while len(rows):
        left = size[rows] - done
        x = eights[start[rows] + done] & _MASKS[np.minimum(left, 8)]
        for h, factor in zip(out, _FACTORS):
            y = (h[rows] ^ x) * factor
            h[rows] = y ^ (y >> np.uint64(32))
        done += 8
        rows = rows[left > 8]
    return out[0], out[1]


def _is_odd(text: str) -> bool:
    """Whether there is white space other than single spaces and line ends between words."""
    if not text or text[0].isspace() or text[-1].isspace():
        return True
    return any(pair in text for pair in ("  ", "\n\n", " \n", "\n ")) or _ODD.search(text) is not None


class Encoder:
    """Ids as little-endian numbers, two bytes each where the vocabulary allows it, else four."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 2**16 else "<u4")
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.begins[number] = token.startswith("Ġ")
        self.line_end = self.direct("\n")
        self._forget()

    def _forget(self) -> None:
        """Words are numbered; of each, where its ids begin in one array, and how many."""
        self.number: dict[int, int] = {}
        self.check = np.empty(0, np.uint64)
        self.begin, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, self.dtype)

    def direct(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _word_ids(self, words: list[str], before: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``words``, each after a space or a line end, and the number of each."""
        ids = self.direct("".join([before + w for w in words]))
        starts = np.flatnonzero(self.begins[ids] if before == " " else ids == self.line_end[0])
        if len(starts) == len(words) and (not len(words) or starts[0] == 0):
            return ids, np.diff(np.append(starts, len(ids)))
        each = [self.direct(before + w) for w in words]
        return np.concatenate([*each, self.ids[:0]]), np.array([len(e) for e in each], np.int64)

    def _learn(self, words: list[str], line_start: np.ndarray, check: np.ndarray) -> None:
        """Append words, those after a space first."""
        for before, mine in ((" ", ~line_start), ("\n", line_start)):
            chosen = [w for w, m in zip(words, mine.tolist()) if m]
            for first in range(0, len(chosen), 50_000):
                ids, count = self._word_ids(chosen[first : first + 50_000], before)
                self.begin = np.append(self.begin, len(self.ids) + np.cumsum(count) - count)
                self.count = np.append(self.count, count)
                self.ids = np.append(self.ids, ids)
        self.check = np.append(self.check, np.concatenate([check[~line_start], check[line_start]]))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and the place where each text's ids end; equal to ``direct`` of
        each text."""
        odd = [i for i, t in enumerate(texts) if _is_odd(t)]
        ids, count, wrong = self._plain(texts, odd)
        again = {i: self.direct(texts[i]) if texts[i] else self.ids[:0] for i in sorted({*odd, *wrong})}
        if again:
            ends = np.cumsum(count)
            parts, done = [], 0
            for i, own in again.items():
                parts += [ids[done : ends[i] - count[i]], own]
                done = ends[i]
                count[i] = len(own)
            ids = np.concatenate([*parts, ids[done:]])
        return ids, np.cumsum(count)

    def _plain(self, texts: list[str], odd: list[int]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Ids and their number by text, none for ``odd`` ones; texts whose words are in doubt."""
        skip = set(odd)
        plain = [i for i in range(len(texts)) if i not in skip]
        count = np.zeros(len(texts), np.int64)
        if not plain:
            return self.ids[:0], count, []
        # Every text begins like a new line.
        data = np.frombuffer(("\n" + "\n".join([texts[i] for i in plain])).encode() + b"\n" * 9, np.uint8)
        cut = np.flatnonzero((data[:-8] == _SPACE) | (data[:-8] == _LINE_END))
        start, size, line_start = cut[:-1] + 1, np.diff(cut) - 1, data[cut[:-1]] == _LINE_END
        text_bytes = np.array([len(texts[i].encode()) + 1 for i in plain], np.int64)
        # Place of the first word of each text among all words.
        first = np.searchsorted(start, np.cumsum(text_bytes) - text_bytes + 1)
        one, two = _hashes(data, start, size)
        one ^= line_start.astype(np.uint64) * _FACTORS[1]
        number, where = self._numbers(data, start, size, line_start, one, two)
        begin, n = self.begin[number][where], self.count[number][where]
        # The line end before a text is not part of it.
        begin[first] += len(self.line_end)
        n[first] -= len(self.line_end)
        ends = np.cumsum(n)
        ids = self.ids[np.repeat(begin - (ends - n), n) + np.arange(ends[-1])]
        count[plain] = np.add.reduceat(n, first)
        doubt = np.flatnonzero(self.check[number][where] != two)
        wrong = [plain[i] for i in np.unique(np.searchsorted(first, doubt, "right") - 1)] if len(doubt) else []
        self._drop_long()
        return ids, count, wrong

    def _numbers(self, data, start, size, line_start, one, two) -> tuple[np.ndarray, np.ndarray]:
        """The number of each different word, and for each word which of these it is."""
        import pandas as pd

        where, different = pd.factorize(one)
        at = np.empty(len(different), np.int64)
        # A word's last place stands for it.
        at[where] = np.arange(len(one))
        known = self.number
        found = np.array([known.get(h, -1) for h in different.tolist()], np.int64)
        if len(known) + (found < 0).sum() > MAX_WORDS:
            # All words of the piece must be known at once.
            self._forget()
            found[:] = -1
        new = np.flatnonzero(found < 0)
        # Long words come last, so that they can be dropped after this piece; among words of one
        # kind those after a space come first, as ``_learn`` has it.
        self.kept = len(self.begin)
        raw = data.tobytes()
        for group in (new[size[at[new]] <= KEPT_BYTES], new[size[at[new]] > KEPT_BYTES]):
            place = at[group]
            words = [raw[a:b].decode() for a, b in zip(start[place].tolist(), (start[place] + size[place]).tolist())]
            starts_line = line_start[place]
            base = len(self.begin)
            self._learn(words, starts_line, two[place])
            found[np.concatenate([group[~starts_line], group[starts_line]])] = np.arange(base, len(self.begin))
            if self.kept == base and len(group) and size[place[0]] <= KEPT_BYTES:
                self.number.update(zip(different[group].tolist(), found[group].tolist()))
                self.kept = len(self.begin)
        return found, where

    def _drop_long(self) -> None:
        if self.kept < len(self.begin):
            self.ids = self.ids[: self.begin[self.kept]].copy()
            self.begin, self.count, self.check = self.begin[: self.kept], self.count[: self.kept], self.check[: self.kept]


def encoder(path: str | None = None) -> Encoder:
    """This process's encoder. Functions arrive anew with each task, so it is kept in a module of
    its own, where the next task in the same worker finds it and the words it has learnt."""
    path = path or tokenizer_path()
    kept = sys.modules.setdefault("_millrace_worker", types.ModuleType("_millrace_worker"))
    if getattr(kept, "encoder_path", None) != path:
        kept.encoder, kept.encoder_path = Encoder(path), path
    return kept.encoder
