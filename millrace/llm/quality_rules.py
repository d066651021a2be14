"""Quality rules: how much of a text lies inside repeated word runs and repeated lines.

A document is rejected by the base rules (under 20 words, or over 30 % of the words in 8-word
windows that occur again) or when the characters in *later* copies of an n-gram or of a line
exceed the limit for that length. Later copies are counted, not first ones, so that one line
that stands twice in a short text does not condemn it.

Null and empty texts have no words and are rejected by the base rules. Repeated rows are judged
one by one. Nothing is cut: n-grams run over the whole text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import map_rows, table, texts

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
# Largest share of the characters that later copies may cover, by n-gram length.
LIMITS = {5: 0.30, 6: 0.29, 7: 0.28, 8: 0.27, 10: 0.25}
MAX_LINE_SHARE = 0.35
MIN_DUPLICATE_LINES = 3

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_line_chars long, "
    + ", ".join(f"dup_chars_{n} long" for n in LIMITS)
)


def _mixed(ids: np.ndarray) -> np.ndarray:
    x = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _windows(codes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of the n-word windows inside one document, and their hashes."""
    last = len(codes) - n + 1
    if last <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = _mixed(doc[:last].astype(np.uint64)).copy()
    for k in range(n):
        h = h * np.uint64(0x100000001B3) + codes[k : k + last]
    h ^= h >> np.uint64(31)
    starts = np.flatnonzero(doc[:last] == doc[n - 1 :])
    return starts, h[starts]


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """True for each word inside one of the windows at ``starts``."""
    edge = np.bincount(starts, minlength=size + 1) - np.bincount(starts + n, minlength=size + 1)[: size + 1]
    return np.cumsum(edge[:size]) > 0


def measure(batch: list[str]) -> dict[str, np.ndarray]:
    """The counts for a list of texts."""
    size = len(batch)
    words = [t.encode("utf-8", "surrogatepass").split() for t in batch]
    n_words = np.array([len(w) for w in words], np.int64)
    doc = np.repeat(np.arange(size), n_words)
    ids: dict[bytes, int] = {}
    flat = [ids.setdefault(w, len(ids)) for ws in words for w in ws]
    codes = _mixed(np.array(flat, np.uint64))
    by_id = np.array([len(w.decode("utf-8", "surrogatepass")) for w in ids], np.int64)
    chars = by_id[np.array(flat, np.int64)] if flat else np.empty(0, np.int64)

    def total(of: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=of, minlength=size).astype(np.int64)

    out = {"n_words": n_words, "word_chars": total(chars)}
    out["n_symbols"] = np.array([sum(map(t.count, SYMBOLS)) for t in batch], np.int64)
    lines, line_chars = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for i, text in enumerate(batch):
        seen: set[str] = set()
        for line in text.split("\n"):
            if line in seen:
                lines[i] += 1
                line_chars[i] += sum(map(len, line.encode("utf-8", "surrogatepass").split()))
            elif line.strip(" \t\n\r\x0b\x0c"):
                seen.add(line)
    out["n_dup_lines"], out["dup_line_chars"] = lines, line_chars
    for n in sorted({WINDOW, *LIMITS}):
        starts, h = _windows(codes, doc, n)
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        later = np.sort(starts[order[1:][same]])
        if n == WINDOW:
            both = np.union1d(later, starts[order[:-1][same]])
            out["n_repeat_words"] = total(_covered(both, n, len(doc)))
        if n in LIMITS:
            out[f"dup_chars_{n}"] = total(chars * _covered(later, n, len(doc)))
    return out


def judge(batch: list[str]) -> dict[str, np.ndarray]:
    """Counts with the verdicts ``base_failed`` and ``kept``."""
    out = measure(batch)
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > 30 * out["n_words"])
    most = np.maximum(out["word_chars"], 1)
    bad = out["base_failed"].copy()
    for n, limit in LIMITS.items():
        bad |= out[f"dup_chars_{n}"] > limit * most
    bad |= (out["n_dup_lines"] >= MIN_DUPLICATE_LINES) & (out["dup_line_chars"] > MAX_LINE_SHARE * most)
    out["kept"] = ~bad
    return out


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts, base verdict and verdict."""
    names = [c.split()[0] for c in SCHEMA.split(", ")][1:]

    def run(columns: list[list]) -> list:
        out = judge(columns[1])
        return [columns[0], *(out[n].tolist() for n in names)]

    return map_rows(texts(docs), SCHEMA, run)


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at = batch.schema.get_field_index("text")
            for start in range(0, batch.num_rows, 512):
                piece = batch.slice(start, 512)
                kept = judge([t or "" for t in piece.column(at).to_pylist()])["kept"]
                yield piece.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(table(spark, folder, "documents"))
