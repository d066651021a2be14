"""Language of a text: unigrams of pieces, summed over all ways to segment each word.

The pieces are those of a public vocabulary (a sentencepiece file whose path is a parameter) that
consist of letters, with or without the mark of a word's beginning. Each language has a
probability for every piece. The probability of a word is the sum, over all segmentations of it
into pieces, of the product of their probabilities, which a forward pass over the word's letters
gives; a text is as likely as its words together. The prediction is the language under which it is
likeliest (equal: the smallest name), the score its share among all languages.

Probabilities are learnt by expectation and maximisation: forward and backward passes give each
piece's expected count over all segmentations of the words of a language, and these counts,
smoothed, its next probabilities. Learning takes a bounded sample, ``PER_LANGUAGE`` documents of
each language (those whose doc_id and text have the smallest hash), and passes over its words as a
distributed table; the driver holds the probabilities only, whose number is that of pieces times
languages. Expected counts are summed as whole numbers, so their order does not matter.

Words are runs of letters in lower case; a run of more than ``LONGEST`` letters is scored as
several of that size, so that time and memory grow with the text and not with a word. Letters
that no piece holds have the same small probability under all languages. A text that is null or
has no letter gets ``und`` and the score 0, and so does every text where there is nothing to learn
from. Rows with a null language are not learnt from but predicted. Repeated rows get equal results
and count once in the sample; a null doc_id counts as empty text; further columns are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import fold, table
from millrace.session import store

VOCABULARY = "piece_bpe_32k.model"
BEGIN = "▁"
LONGEST = 64
# Within Spark's limit for ranks that are taken before a shuffle.
PER_LANGUAGE = 1000
SPARE = 3
ROUNDS = 3
SMOOTHING = 0.05
UNKNOWN = -18.0
# Expected counts are summed in units of 2^-20.
UNIT = 1 << 20
UNDETERMINED = "und"

# Words that a worker keeps the values of; beyond, it begins anew.
HELD_WORDS = 300_000
PIECE = 256

_RUN = re.compile(r"[^\W\d_]{1,%d}" % LONGEST)
# Signs that count as parts of words but are no letters, such as superscripts and fractions.
_SIGNS = "".join(c for c in map(chr, range(0x20000)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
_LETTERS = re.compile(f"[^{re.escape(_SIGNS)}]+")


def words_of(text: str) -> list[str]:
    words = _RUN.findall(text.lower())
    if "".join(words).isalpha():
        return words
    # The long class of signs is slow, so only runs that hold some are cut at them.
    return [part for w in words for part in ([w] if w.isalpha() else _LETTERS.findall(w))]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def letter_pieces(path: str) -> list[str]:
    """The pieces of a sentencepiece file that are letters, perhaps after the mark of a beginning."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if p == BEGIN or p.removeprefix(BEGIN).isalpha())


def _step(state: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Hash of a string one letter longer."""
    with np.errstate(over="ignore"):
        x = (state + letter.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


class Lattice:
    """Finds all pieces in many words at once, through a sorted table of the hashes of all
    beginnings of pieces."""

    def __init__(self, pieces: list[str]):
        number = {p: i for i, p in enumerate(pieces)}
        beginnings = sorted({p[:n] for p in pieces for n in range(1, len(p) + 1)}, key=len)
        state: dict[str, int] = {"": 0}
        for size in sorted({len(b) for b in beginnings}):
            of_size = [b for b in beginnings if len(b) == size]
            before = np.array([state[b[:-1]] for b in of_size], np.uint64)
            state.update(zip(of_size, _step(before, np.array([ord(b[-1]) for b in of_size])).tolist()))
        values = np.array([state[b] for b in beginnings], np.uint64)
        order = np.argsort(values)
        self.hashes = values[order]
        # Number of the piece; -1: only the beginning of one.
        self.numbers = np.array([number.get(b, -1) for b in beginnings], np.int64)[order]
        self.size = len(pieces)

    def arcs(self, letters: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(from, to, rows, pieces) for a matrix of words of one length, ordered by from; the
        number ``size`` stands for a letter that is no piece."""
        n, length = letters.shape
        out = []
        for start in range(length):
            rows, state = np.arange(n), np.zeros(n, np.uint64)
            for end in range(start, length):
                state = _step(state, letters[rows, end])
                at = np.minimum(np.searchsorted(self.hashes, state), len(self.hashes) - 1)
                begun = self.hashes[at] == state
                piece = np.where(begun, self.numbers[at], -1)
                if end == start:
                    out.append((start, end + 1, rows, np.where(piece < 0, self.size, piece)))
                elif (piece >= 0).any():
                    out.append((start, end + 1, rows[piece >= 0], piece[piece >= 0]))
                rows, state = rows[begun], state[begun]
                if not len(rows):
                    break
        return out


def by_length(words: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Places of words of one length, and their letters as a matrix after a mark of beginning."""
    sizes: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        sizes.setdefault(len(word), []).append(i)
    for length, places in sizes.items():
        step = max(1, (1 << 18) // (length + 1))
        for first in range(0, len(places), step):
            some = places[first : first + step]
            text = "".join([BEGIN + words[i] for i in some])
            yield some, np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(-1, length + 1)


def forward(arcs: list, n: int, length: int, log_p: np.ndarray) -> np.ndarray:
    """Logarithm of the summed probability of the first ``i`` letters, by row, i and language."""
    ahead = np.full((n, length + 1, log_p.shape[1]), -np.inf)
    ahead[:, 0] = 0
    for start, end, rows, pieces in arcs:
        ahead[rows, end] = np.logaddexp(ahead[rows, end], ahead[rows, start] + log_p[pieces])
    return ahead


def log_words(lattice: Lattice, words: list[str], log_p: np.ndarray) -> np.ndarray:
    """Logarithm of the probability of each word under each language."""
    out = np.empty((len(words), log_p.shape[1]))
    for places, letters in by_length(words):
        out[places] = forward(lattice.arcs(letters), *letters.shape, log_p)[:, -1]
    return out


def expected(lattice: Lattice, words: list[str], counts: np.ndarray, log_p: np.ndarray) -> np.ndarray:
    """Expected count of each piece over all segmentations of all words, in whole units; ``log_p``
    has one column."""
    total = np.zeros(lattice.size + 1, np.int64)
    for places, letters in by_length(words):
        n, length = letters.shape
        arcs = lattice.arcs(letters)
        ahead = forward(arcs, n, length, log_p)[:, :, 0]
        back = np.full((n, length + 1), -np.inf)
        back[:, length] = 0
        for start, end, rows, pieces in reversed(arcs):
            back[rows, start] = np.logaddexp(back[rows, start], log_p[pieces, 0] + back[rows, end])
        for start, end, rows, pieces in arcs:
            share = np.exp(ahead[rows, start] + log_p[pieces, 0] + back[rows, end] - ahead[rows, length])
            np.add.at(total, pieces, np.rint(share * counts[places][rows] * UNIT).astype(np.int64))
    return total


class Model:
    """Languages, and the logarithm of each piece's probability under each of them; the last row
    is that of letters that no piece holds."""

    def __init__(self, pieces: list[str], languages: list[str], counts: np.ndarray | None = None):
        self.lattice, self.languages = Lattice(pieces), languages
        counts = np.ones((len(pieces), len(languages))) if counts is None else counts + SMOOTHING
        self.log_p = np.vstack([np.log(counts / counts.sum(0)), np.full((1, len(languages)), UNKNOWN)])


def learnable_words(docs: DataFrame, learnable: Column, per_language: int = PER_LANGUAGE) -> DataFrame:
    """lang, word, n over the sample of each language."""
    spark = docs.sparkSession
    rows = docs.where(learnable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text").alias("key"), "text"
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    # Only keys below a bound that some ``SPARE`` times as many rows of the language pass are ranked,
    # so that the rows one task ranks do not grow with the input.
    sizes = store(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    low = (F.col("key") + 2.0**63) / 2.0**64 <= SPARE * per_language / F.col("rows")
    near = rows.select("lang", "key").join(sizes, "lang").where(low).select("lang", "key", place.alias("place"))
    # Two short columns; the texts of the few that are picked are fetched by a second scan.
    picked = store(near.where(F.col("place") <= per_language).select("lang", "key").distinct(), "sample")
    sample = rows.join(picked, ["lang", "key"]).groupBy("lang", "key").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.update([(language, word) for word in words_of(text.as_py())])
            if len(held) >= HELD_WORDS:
                yield counted(held)
                held = Counter()
        if held:
            yield counted(held)

    def counted(held: Counter) -> pa.RecordBatch:
        columns = [pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.string()), pa.array(held.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])

    words = sample.select("lang", "text").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # Spread over the tasks of a session whatever its size, as words cost time and not bytes.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return store(words.repartition(tasks, "lang", "word"), "language-words")


def learn(words: DataFrame, pieces: list[str], rounds: int = ROUNDS) -> Model:
    """Probabilities by rounds of expectation and maximisation over a table of lang, word, n."""
    languages = sorted(r[0] for r in words.select("lang").distinct().collect())
    model = Model(pieces, languages)
    for _ in range(rounds if languages else 0):
        counts = np.zeros((len(pieces), len(languages)))
        for r in _expectations(words, model).collect():
            counts[r["piece"], r["number"]] = r["units"] / UNIT
        model = Model(pieces, languages, counts)
    return model


def _expectations(words: DataFrame, model: Model) -> DataFrame:
    """number of the language, piece, units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {name: np.zeros(model.lattice.size + 1, np.int64) for name in model.languages}
        for batch in batches:
            of = np.array(batch.column(0).to_pylist(), object)
            for i, name in enumerate(model.languages):
                mine = batch.filter(pa.array(of == name, pa.bool_()))
                for first in range(0, mine.num_rows, 20_000):
                    some = mine.slice(first, 20_000)
                    totals[name] += expected(model.lattice, some.column(1).to_pylist(), some.column(2).to_numpy(), model.log_p[:, i : i + 1])
        for i, name in enumerate(model.languages):
            pieces = np.flatnonzero(totals[name][:-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pieces), i)), pa.array(pieces), pa.array(totals[name][pieces])], names=["number", "piece", "units"])

    return words.mapInArrow(run, "number long, piece long, units long").groupBy("number", "piece").agg(F.sum("units").alias("units"))


class Scorer:
    """Values of texts under a model, with a bounded memory of words."""

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.values = np.empty((0, len(model.languages)))

    def log_texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Logarithms by text and language, and the number of words of each text."""
        words = [words_of(t) if t else [] for t in texts]
        fresh = {w for of in words for w in of if w not in self.place}
        if len(self.place) + len(fresh) > HELD_WORDS:
            # All words of the batch must be known at once.
            fresh = {w for of in words for w in of}
            self.place, self.values = {}, self.values[:0]
        if fresh:
            new = sorted(fresh)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.values = np.vstack([self.values, log_words(self.model.lattice, new, self.model.log_p)])
        out = np.zeros((len(texts), len(self.model.languages)))
        for i, of in enumerate(words):
            if of:
                out[i] = self.values[np.fromiter(map(self.place.__getitem__, of), np.int64, len(of))].sum(0)
        return out, np.array([len(of) for of in words])


def predict(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        names = np.array([*model.languages, UNDETERMINED], object)
        for batch in batches:
            for first in range(0, batch.num_rows, PIECE):
                piece = batch.slice(first, PIECE)
                likely, words = scorer.log_texts(piece.column(2).to_pylist())
                best = np.full(len(words), len(model.languages))
                score = np.zeros(len(words))
                if model.languages:
                    best = np.where(words > 0, likely.argmax(1), best)
                    score = np.where(words > 0, 1 / np.exp(likely - likely.max(1, keepdims=True)).sum(1), 0.0)
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(names[best].tolist(), pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, held_out: Column, vocabulary: str | None = None) -> DataFrame:
    """Learn from the rows that are not held out and predict all rows."""
    pieces = letter_pieces(vocabulary or vocabulary_path())
    return predict(docs, learn(learnable_words(docs, ~held_out), pieces), held_out)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"), fold("doc_id", 4) == 2)
