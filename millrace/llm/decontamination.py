"""Benchmark decontamination: item-sized windows of every document against every item.

Words are runs of letters and digits, lower-cased. A window or item is a bag of word pairs; its
64-bit fingerprint has, in each bit, what most of its pairs have there. Items are put in classes
of like size (each a tenth longer than the one before), and documents are covered with windows of
each class's size, a twelfth of a window apart. A fingerprint is four blocks of 16 bits. For each
block a table has, for every value, the bits by which it differs from the nearest of the items' in
that class. A window whose four differences add up to more than ``RADIUS`` is farther than that
from every item; only the others are compared, so every pair within the radius is found.

What is found is checked exactly: of all windows about there that have the item's own number of
words, the best is taken by the weighted Jaccard similarity of its five-word shingles (each with
its number of occurrences) with the item's. A pair counts from ``SIMILARITY`` on. The radius decides
how many such pairs are seen at all: of copies at 0.8 to 0.88 whose last words were changed, 2 of
1,200 were missed (82 with a radius of 11).

A leak in a document shorter than the item is compared as a whole. Null and empty texts leak
nothing, and an item without words is never leaked. An item shorter than five words is one
shingle. Repeated rows of a document, and of an item, are each reported.

Items are gone through in blocks of ``BLOCK_ITEMS`` with at most ``BLOCK_CHARS`` characters
each (or one item that is longer); a block is what is sent to every executor.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import map_rows, table, texts

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
BLOCKS, LOW = 4, np.uint64(0xFFFF)  # blocks of 16 bits
RATIO = 1.1
STEPS = 12
WINDOWS = 1 << 13  # fingerprints worked on at once
ITEMS = 32  # items compared at once
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 20_000_000
SCHEMA = "doc_id long, item_id long, similarity double, start_word long, n_words long, distance int"

_WORD = re.compile(r"[^\W_]+")
_ASCII = bytes(c if c < 128 and chr(c).isalnum() else 32 for c in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def letters() -> np.ndarray:
    """Which of the first 65,536 characters are letters or digits."""
    return np.array([chr(c).isalnum() for c in range(1 << 16)])


def split_words(text: str) -> list[str] | list[bytes]:
    """Runs of letters and digits (as bytes if all is ASCII, with the same hashes).

    All else becomes blank, which is quicker than the pattern; that is left to characters of more than 16 bits."""
    text = text.lower()
    if text.isascii():
        return text.encode().translate(_ASCII).split()
    units = np.frombuffer(text.encode("utf-16-le"), "<u2")
    if len(units) > len(text):
        return _WORD.findall(text)
    return np.where(letters()[units], units, ord(" ")).astype("<u2", copy=False).tobytes().decode("utf-16-le").split()


def word_hashes(text: str) -> np.ndarray:
    import xxhash

    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, split_words(text))), ">u8").astype(np.uint64)


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words; of all words if there are fewer."""
    n = min(n, len(hashes))
    if not n:
        return hashes
    last = len(hashes) - n + 1
    h = np.full(last, n, np.uint64)
    for k in range(n):
        h = (h ^ hashes[k : k + last]) * _MULTIPLIER
        h ^= h >> np.uint64(29)
    return h


def size_class(words: int) -> int:
    return round(math.log(words) / math.log(RATIO))


def class_size(number: int) -> int:
    return max(1, round(RATIO**number))


def bits(h: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones per hash."""
    return np.unpackbits(h.astype("<u8").view(np.uint8)).reshape(-1, 64)


def running_sums(rows: np.ndarray, width: type) -> np.ndarray:
    """Sums of all rows before each one and of all, in lanes of ``width`` in 64-bit numbers. What
    outgrows its lane runs over into the next, so that only differences of sums are right: in
    every lane, as long as each of them fits in its own."""
    lanes = rows.astype(width, copy=False).view(np.uint64)
    sums = np.zeros((len(lanes) + 1, lanes.shape[1]), np.uint64)
    for start in range(0, len(lanes), 1024):
        some = sums[start + 1 : start + 1025]
        np.cumsum(lanes[start : start + 1024], axis=0, out=some)
        some += sums[start]
    return sums


def majority(sums: np.ndarray, first: np.ndarray, end: np.ndarray, half: np.ndarray | int, width: type, room: np.ndarray) -> np.ndarray:
    """Fingerprints of the windows from ``first`` to before ``end``: bits that more than ``half`` pairs have.

    ``room`` holds two sums for each window."""
    there, before = room[:, : len(first)]
    sums.take(end, axis=0, out=there, mode="clip")
    sums.take(first, axis=0, out=before, mode="clip")
    there -= before
    return np.packbits((there.view(width) > half).ravel()).view("<u8")


def fingerprint(pairs: np.ndarray) -> np.uint64:
    most = 2 * bits(pairs).sum(0, dtype=np.int64) > len(pairs)
    return np.packbits(most).view("<u8")[0]


def near_values(values: np.ndarray) -> np.ndarray:
    """For each 16-bit value, the bits by which it differs from the nearest of ``values``."""
    bits_off = np.full(1 << 16, 16, np.uint8)
    bits_off[values] = 0
    for k in range(16):
        low, high = bits_off.reshape(-1, 2, 1 << k).swapaxes(0, 1)
        either = np.minimum(low, high) + np.uint8(1)
        np.minimum(low, either, out=low)
        np.minimum(high, either, out=high)
    return bits_off


@dataclass
class Item:
    number: int | None
    words: int
    shingles: Counter

    def best(self, shingles: np.ndarray, first: int, last: int, doc_words: int) -> tuple[float, int]:
        """Largest similarity of the item-sized windows that start in [first, last], and its start.

        The windows are walked one by one, with the counts of the item's shingles in them."""
        size = self.words if doc_words >= SHINGLE else doc_words
        span = max(1, min(size, doc_words) - SHINGLE + 1)
        last = max(first, min(last, len(shingles) - span))
        first = max(0, min(first, len(shingles) - span))
        total = sum(self.shingles.values())
        region = shingles[first : last + span].tolist()
        have: Counter = Counter()
        common, best, at = 0, 0.0, first
        for k, s in enumerate(region):
            if s in self.shingles:
                have[s] += 1
                common += have[s] <= self.shingles[s]
            if k >= span:
                old = region[k - span]
                if old in self.shingles:
                    common -= have[old] <= self.shingles[old]
                    have[old] -= 1
            if k >= span - 1 or k == len(region) - 1:
                value = common / (total + min(span, len(region)) - common)
                if value > best:
                    best, at = value, first + max(0, k - span + 1)
        return best, at


@dataclass
class SizeClass:
    size: int
    prints: np.ndarray
    items: list[Item]
    tables: list[np.ndarray]

    def search(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows, items and distances of all pairs within the radius."""
        out = []
        for start in range(0, len(prints), WINDOWS):
            some = prints[start : start + WINDOWS]
            least = self.tables[0].take((some & LOW).view(np.int64), mode="clip")
            for k in range(1, BLOCKS):
                least += self.tables[k].take((some >> np.uint64(16 * k) & LOW).view(np.int64), mode="clip")
            rows = np.flatnonzero(least <= RADIUS)
            some = some[rows]
            for item in range(0, len(self.prints), ITEMS):
                distance = np.bitwise_count(self.prints[item : item + ITEMS, None] ^ some).ravel()
                near = np.flatnonzero(distance <= RADIUS)
                if len(near):
                    out.append((rows[near % len(rows)] + start, near // len(rows) + item, distance[near]))
        if not out:
            none = np.empty(0, np.int64)
            return none, none, none
        return tuple(np.concatenate(x) for x in zip(*out))


def build(items: list[tuple[int | None, str]]) -> list[SizeClass]:
    by_class: dict[int, list] = {}
    for number, text in items:
        words = word_hashes(text)
        if len(words):
            item = Item(number, len(words), Counter(rolled(words, SHINGLE).tolist()))
            by_class.setdefault(size_class(len(words)), []).append((fingerprint(rolled(words, 2)), item))
    out = []
    for number, members in sorted(by_class.items()):
        prints = np.array([p for p, _ in members], np.uint64)
        parts = prints.astype("<u8").view("<u2").reshape(-1, BLOCKS).astype(np.int64)
        out.append(SizeClass(class_size(number), prints, [i for _, i in members], [near_values(parts[:, k]) for k in range(BLOCKS)]))
    return out


def search(batch: list[str], classes: list[SizeClass]) -> list[tuple[int, Item, float, int, int]]:
    """(place in the batch, item, similarity, first word, distance), best window of each pair."""
    if not classes:
        return []
    grain = max(1, min(4, min(c.size for c in classes) // STEPS))
    words = [word_hashes(t) for t in batch]
    pairs = [rolled(w, 2) for w in words]
    # Blocks of `grain` pairs; a document's last block may be filled up with zeros, which count nothing.
    lengths = np.array([len(p) for p in pairs])
    blocks = -(-lengths // grain)
    first = np.concatenate([[0], np.cumsum(blocks)])
    if not first[-1]:
        return []
    flat = np.zeros(first[-1] * grain, np.uint64)
    for p, at in zip(pairs, first[:-1] * grain):
        flat[at : at + len(p)] = p
    one = bits(flat).reshape(-1, grain, 64)
    summed = one[:, 0]
    for k in range(1, grain):
        summed = summed + one[:, k]
    # A lane holds the pairs of the longest window.
    longest = max(c.size for c in classes) + grain
    width = np.uint8 if longest < 250 else np.uint16 if longest < 60_000 else np.uint64
    sums = running_sums(summed, width)
    del one, summed
    room = np.empty((2, max(WINDOWS, len(batch)), sums.shape[1]), np.uint64)
    found: dict[tuple[int, int, int], list] = {}
    for which, c in enumerate(classes):
        length, stride = max(1, round(c.size / grain)), max(1, c.size // (STEPS * grain))
        # Starts of each document's windows: every stride, and one that ends with the document.
        docs = np.flatnonzero(blocks * grain >= 0.75 * c.size)
        if not len(docs):
            continue
        last = np.maximum(blocks[docs] - length, 0)
        windows = -(-last // stride) + 1
        ends = np.cumsum(windows)
        a = np.arange(0, ends[-1] * stride, stride)
        a += np.repeat(first[docs] - (ends - windows) * stride, windows)
        a[ends - 1] = first[docs] + last
        prints = np.empty(len(a), np.uint64)
        for some in range(0, len(a), WINDOWS):
            part = a[some : some + WINDOWS]
            prints[some : some + WINDOWS] = majority(sums, part, part + length, length * grain // 2, width, room)
        # A document's last window has fewer pairs if the document is shorter or its last block filled up.
        there = lengths[docs] - last * grain
        cut = np.flatnonzero(there < length * grain)
        prints[ends[cut] - 1] = majority(sums, a[ends[cut] - 1], first[docs[cut] + 1], (there[cut] // 2).astype(width)[:, None], width, room)
        for w, item, distance in zip(*(x.tolist() for x in c.search(prints))):
            doc = int(docs[np.searchsorted(ends, w, "right")])
            found.setdefault((doc, which, item), []).append((int(a[w] - first[doc]) * grain, int(distance)))
    out = []
    shingled: dict[int, np.ndarray] = {}
    for (doc, which, item), hits in found.items():
        c = classes[which]
        slack = max(grain, c.size // STEPS) + abs(c.items[item].words - c.size) + grain
        if doc not in shingled:
            shingled[doc] = rolled(words[doc], SHINGLE)
        best = (0.0, 0)
        hits.sort()
        low = high = hits[0][0]
        regions = []
        for start, _ in hits[1:]:
            if start > high + slack:
                regions.append((low, high))
                low = start
            high = start
        regions.append((low, high))
        for low, high in regions:
            best = max(best, c.items[item].best(shingled[doc], max(0, low - slack), high + slack, len(words[doc])), key=lambda x: x[0])
        if best[0] >= SIMILARITY:
            out.append((doc, c.items[item], best[0], best[1], min(d for _, d in hits)))
    return out


def item_blocks(items: DataFrame):
    """The items in blocks of bounded size, dealt by the hash of their text."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    count, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    parts = max(1, -(-2 * count // BLOCK_ITEMS), -(-2 * chars // BLOCK_CHARS)) if count > BLOCK_ITEMS or chars > BLOCK_CHARS else 1
    for k in range(parts):
        block = items if parts == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        yield [(r[0], r[1]) for r in block.toLocalIterator()]


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item that it holds: best similarity and where."""
    spark = docs.sparkSession
    out = None
    for block in item_blocks(items):
        shared = spark.sparkContext.broadcast(build(block))

        def run(columns: list[list], shared=shared) -> list:
            rows = [(columns[0][i], item.number, s, at, item.words, d) for i, item, s, at, d in search(columns[1], shared.value)]
            return [list(c) for c in zip(*rows)] if rows else [[]] * 6

        part = map_rows(texts(docs), SCHEMA, run, 256)
        out = part if out is None else out.unionAll(part)
    return out


def drop_leaking(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they were."""
    spark = docs.sparkSession
    for block in item_blocks(items):
        shared = spark.sparkContext.broadcast(build(block))

        def run(batches, shared=shared):
            import pyarrow as pa

            for batch in batches:
                at = batch.schema.get_field_index("text")
                for start in range(0, batch.num_rows, 256):
                    piece = batch.slice(start, 256)
                    bad = {i for i, *_ in search([t or "" for t in piece.column(at).to_pylist()], shared.value)}
                    yield piece.filter(pa.array([i not in bad for i in range(piece.num_rows)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def query(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
