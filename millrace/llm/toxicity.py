"""Toxicity: a weighted grammar of finite-state transducers over the words of a clause.

A lexicon turns words into symbols: insult, threat, target, negation, report, announcement or
other. A clause is read twice. From its end to its beginning, the target transducer marks insults
and threats that have a target ahead of them, next to them or further on. From its beginning to
its end run, one feeding the next: negation, which turns insults and threats within its reach into
denied ones; reported speech, which turns those after it into quoted ones; the insult transducer,
which tells insults at a target's side, or in a clause with a target, from bare ones; the threat
transducer, which tells threats aimed ahead ("kill you"), announced ones ("will kill you") and
those whose target stands before them ("you will be killed") from words that threaten no one; and
last the weights. The second five are composed into one machine, so a clause is scored in one
walk each way; a word that merely is in the lexicon counts less where it is denied or quoted, and
more where it is aimed at someone.

Insults are learnt: words and word beginnings that stand in far more toxic than other documents.
The other lists are fixed. Learnt from at most ``MOST`` labelled documents; lang, source, doc_id
and labels are no inputs of a score. Every text is scored whole. Null and empty texts have no
clause. Without labels of both classes the score is the share of toxic labels, or 0.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import fold, map_rows, table, texts
from millrace.llm.learning import class_sizes, fit_logistic, labelled_sample

MOST = {1: 2500, 0: 12_500}
LEXICON = 5000
BEGINNINGS = (4, 5, 6)
LEAST_GAIN = 9.0
LEAST_ODDS = 3.0
THRESHOLD = 0.7
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_clauses long, strongest double"

# Words of the closed classes, in the languages of the table.
THREATS = "kill destroy hurt beat punish attack burn töten zerstören schlagen tuer détruire frapper matar destruir golpear"
TARGETS = "you your yours they them he she him her du dich dein ihr euch sie tu te toi vous ils elle él ella tú ti usted ellos"
NEGATIONS = "not no never nor without nicht kein keine nie ohne pas ne jamais sans nunca jamás sin ni"
REPORTS = "said says called wrote quoted reportedly sagte nannte schrieb dit disait appelé écrit dijo llamó escribió"
ANNOUNCEMENTS = "will shall gonna going werde werden wird wirst vais va allons voy vas vamos"
CLASSES = {"h": THREATS, "f": ANNOUNCEMENTS, "y": TARGETS, "n": NEGATIONS, "r": REPORTS}
# Threats also come inflected: words that begin like one, with an ending of so many letters.
ENDINGS, LEAST_STEM, LONGEST_ENDING = ("en", "er", "re", "ar", "ir"), 4, 4
# What a threat counts, beside insults that count by their odds.
THREAT_STRENGTH = 4.0

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.;:!?\n]+")


@dataclass
class Transducer:
    """Moves (state, symbol) -> (state, symbol, weight); what is not listed passes unchanged."""

    start: object
    moves: dict = field(default_factory=dict)

    def step(self, state, symbol):
        return self.moves.get((state, symbol)) or self.moves.get((state, None), (state, None, 1.0))[:1] + (symbol, 1.0)


def compose(first: Transducer, second: Transducer, symbols: str) -> Transducer:
    """The machine that feeds what ``first`` writes to ``second``; states are pairs."""
    start = (first.start, second.start)
    made, open_ = Transducer(start), [start]
    seen = {start}
    while open_:
        a, b = state = open_.pop()
        for symbol in symbols:
            a2, middle, w = first.step(a, symbol)
            b2, out, v = second.step(b, middle)
            made.moves[state, symbol] = ((a2, b2), out, w * v)
            if (a2, b2) not in seen:
                seen.add((a2, b2))
                open_.append((a2, b2))
    return made


SYMBOLS = "iuvhgynrfo"
INSULTS, THREATENING = "iuv", "hg"
REACH = 3
WEIGHTS = {"i": 1.0, "I": 1.2, "A": 1.5, "j": 0.4, "p": 0.6, "h": 0.0, "b": 0.5, "B": 0.8, "g": 1.0, "G": 1.5, "k": 0.1, "q": 0.3}


def ahead() -> Transducer:
    """Reads from the end: i becomes u with a target right after it, v with one further on; h
    becomes g with one anywhere after it."""
    made = Transducer(0, {(s, "y"): (1, "y", 1.0) for s in range(3)})
    for s in range(3):
        made.moves[s, None] = (min(2, 2 * s), None, 1.0)
    made.moves |= {(1, "i"): (2, "u", 1.0), (2, "i"): (2, "v", 1.0), (1, "h"): (2, "g", 1.0), (2, "h"): (2, "g", 1.0)}
    return made


def negation() -> Transducer:
    made = Transducer(0, {(s, "n"): (REACH, "n", 1.0) for s in range(REACH + 1)})
    for s in range(REACH + 1):
        made.moves[s, None] = (max(0, s - 1), None, 1.0)
        if s:
            made.moves |= {(s, x): (s - 1, "j", 1.0) for x in INSULTS} | {(s, x): (s - 1, "k", 1.0) for x in THREATENING}
    return made


def report() -> Transducer:
    made = Transducer(0, {(s, "r"): (1, "r", 1.0) for s in range(2)})
    made.moves |= {(1, x): (1, "p", 1.0) for x in INSULTS} | {(1, x): (1, "q", 1.0) for x in THREATENING}
    return made


def insult() -> Transducer:
    """State: no target yet, one right before, one further back."""
    made = Transducer(0, {(s, "y"): (1, "y", 1.0) for s in range(3)})
    for s in range(3):
        after = min(2, 2 * s)
        made.moves[s, None] = (after, None, 1.0)
        for x in INSULTS:
            aimed = "A" if s == 1 or x == "u" else "I" if s == 2 or x == "v" else "i"
            made.moves[s, x] = (after, aimed, 1.0)
    return made


def threat() -> Transducer:
    """State: words that an announcement still reaches, and whether a target came before."""
    made = Transducer((0, 0))
    for left in range(REACH + 1):
        for seen in range(2):
            state, after = (left, seen), (max(0, left - 1), seen)
            made.moves[state, None] = (after, None, 1.0)
            made.moves[state, "f"] = ((REACH, seen), "f", 1.0)
            made.moves[state, "y"] = ((max(0, left - 1), 1), "y", 1.0)
            made.moves[state, "g"] = (after, "G" if left else "g", 1.0)
            made.moves[state, "h"] = (after, ("B" if left else "b") if seen else "h", 1.0)
    return made


def scoring() -> Transducer:
    return Transducer(0, {(0, s): (0, s, WEIGHTS.get(s, 0.0)) for s in {*SYMBOLS, *WEIGHTS}})


def grammar() -> Transducer:
    made = negation()
    for machine in (report(), insult(), threat(), scoring()):
        made = compose(made, machine, SYMBOLS)
    return made


def stem(threat_word: str) -> str:
    """What inflected forms of a threat begin with."""
    cut = next((threat_word[: -len(e)] for e in ENDINGS if threat_word.endswith(e)), threat_word)
    return cut if len(cut) >= LEAST_STEM else threat_word


def entries(word: str) -> list[str]:
    """The word itself and its beginnings, as they stand in the lexicon."""
    return [word, *[word[:n] + "-" for n in BEGINNINGS if len(word) > n]]


@dataclass
class Model:
    lexicon: dict[str, float]
    weights: np.ndarray | None
    constant: float = 0.0

    def __post_init__(self):
        self.machine, self.ahead = grammar(), ahead()
        self.fixed = {w: c for c, words in CLASSES.items() for w in words.split()}
        self.stems = tuple({stem(w) for w in THREATS.split() if len(stem(w)) >= LEAST_STEM})

    def symbol(self, word: str) -> tuple[str, float]:
        strength = max((self.lexicon.get(e, 0.0) for e in entries(word)), default=0.0)
        if strength:
            return "i", strength
        kind = self.fixed.get(word)
        if kind is None and word.startswith(self.stems) and any(word.startswith(s) and len(word) - len(s) <= LONGEST_ENDING for s in self.stems):
            kind = "h"
        return kind or "o", THREAT_STRENGTH if kind == "h" else 1.0

    def clause(self, symbols: list[tuple[str, float]]) -> float:
        """The weight of one clause of (symbol, strength)."""
        marked, state = [], self.ahead.start
        for kind, strength in reversed(symbols):
            state, kind, _ = self.ahead.step(state, kind)
            marked.append((kind, strength))
        state, total = self.machine.start, 0.0
        for kind, strength in reversed(marked):
            state, _, weight = self.machine.moves[state, kind]
            total += weight * strength
        return total

    def clauses(self, text: str) -> list[float]:
        """The weight of each clause that has one."""
        low = text.lower()
        words = set(_WORD.findall(low))
        symbols = {w: s for w in words if (s := self.symbol(w))[0] != "o"}
        hot = [w for w, s in symbols.items() if s[0] in "ih"]
        if not hot:
            return []
        out = []
        for clause in _CLAUSE.split(low):
            found = [symbols.get(word, ("o", 1.0)) for word in _WORD.findall(clause)]
            total = self.clause(found) if any(kind in "ih" for kind, _ in found) else 0.0
            if total:
                out.append(total)
        return out

    def features(self, text: str) -> list[float]:
        found = self.clauses(text)
        return [max(found, default=0.0) ** 0.5, math.log1p(sum(found)), math.log1p(len(found))]

    def score(self, features: list[float]) -> float:
        if self.weights is None:
            return self.constant
        return float(1 / (1 + np.exp(-np.clip(np.append(features, 1.0) @ self.weights, -30, 30))))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    learnable = fold("doc_id", 3) != 1
    sizes = class_sizes(labels, "toxic", learnable)
    known = sum(sizes.values())
    if not sizes.get(0) or not sizes.get(1):
        return Model({}, None, sizes.get(1, 0) / known if known else 0.0)
    sample = labelled_sample(docs, labels, "toxic", learnable, MOST)

    def words(columns: list[list]) -> list:
        out: tuple[list, list] = ([], [])
        for text, label in zip(*columns):
            found = {e for w in set(_WORD.findall(text.lower())) for e in entries(w)}
            out[0].extend(found)
            out[1].extend([label] * len(found))
        return list(out)

    distinct = sample.groupBy("label", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"))
    totals = {r[0]: r[1] for r in distinct.groupBy("label").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    counted = map_rows(distinct.select("text", "label"), "entry string, label int", words)
    counted = counted.groupBy("entry").agg(F.sum("label").alias("c1"), F.sum(1 - F.col("label")).alias("c0"))
    c1, c0 = F.col("c1"), F.col("c0")
    share = n1 / max(1, n1 + n0)
    gain = c1 * F.log(c1 / ((c1 + c0) * share)) + F.when(c0 > 0, c0 * F.log(c0 / ((c1 + c0) * (1 - share)))).otherwise(0.0)
    odds = F.log((c1 + 0.05) / (n1 + 0.1)) - F.log((c0 + 0.05) / (n0 + 0.1))
    kept = counted.where((c1 > 0) & (gain >= LEAST_GAIN) & (odds >= LEAST_ODDS)).select("entry", odds.alias("odds"), gain.alias("gain"))
    lexicon = {r[0]: min(8.0, r[1]) for r in kept.orderBy(F.desc("gain"), "entry").limit(LEXICON).collect()}
    model = Model(lexicon, None)

    def measure(columns: list[list]) -> list:
        return [columns[1], [model.features(t) for t in columns[0]]]

    # Sorted, as sums over rows in another order would differ in their last digits.
    rows = sorted(map_rows(sample.select("text", "label"), "label int, features array<double>", measure).collect())
    x, y = np.array([r[1] for r in rows]).reshape(-1, 3), np.array([r[0] for r in rows], float)
    if len(set(y)) < 2:
        return Model(lexicon, None, sizes[1] / known)
    per = {c: sizes[c] / known / (y == c).sum() for c in (0, 1)}
    return Model(lexicon, fit_logistic(x, y, np.where(y == 1, per[1], per[0]), 1e-4))


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    def run(columns: list[list]) -> list:
        found = [model.clauses(t) for t in columns[2]]
        scores = [model.score([max(f, default=0.0) ** 0.5, math.log1p(sum(f)), math.log1p(len(f))]) for f in found]
        return [columns[0], columns[1], scores, [int(s >= THRESHOLD) for s in scores], list(map(len, found)), [max(f, default=0.0) for f in found]]

    df = texts(docs).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "text")
    return map_rows(df, SCHEMA, run)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score_toxicity(docs, learn(docs, table(spark, folder, "labels")))
