"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Each line is good or bad. Its features and those of the lines before and after it speak for
either, and neighbouring lines tend to agree. The forward-backward marginals, weighted by line
length, give the share of the text that is bad; a logistic fit of that share on the labels turns
it into a score.

Only whole documents are labelled, so line labels start as the document's and are mended: lines
of a bad document that the field takes for good become good, unless none would stay bad.

Learnt from at most ``PER_CLASS`` labelled documents of each class with at most ``MAX_LINES``
lines; everything else about a document (lang, source, doc_id, labels) is no input. Every text is
scored whole. Null and empty texts are one empty line. Without labels of both classes the score
is the share of good labels, or 0.5 without any.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import fold, map_rows, table, texts
from millrace.llm.learning import class_sizes, fit_logistic, labelled_sample

PER_CLASS = 1500
MAX_LINES = 400
THRESHOLD = 0.3
ROUNDS = 3

_SYMBOLS = re.compile(r"[#*$%&|<>{}\[\]=_~^\\@]")
_DIGITS = re.compile(r"[0-9]")
OWN = 14
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, bad_share double, n_lines long"


def line_features(line: str) -> list[float]:
    words = line.split()
    n, size = len(words), len(line)
    if not n:
        return [1.0] + [0.0] * (OWN - 1)
    upper = sum(map(str.isupper, words)) / n
    repeats = sum(map(str.__eq__, words, words[1:])) / n
    distinct = len(set(words)) / n
    symbols = len(_SYMBOLS.findall(line)) / size
    last = line.rstrip()[-1]
    return [
        0.0,
        min(n, 200) / 200,
        1.0 if n < 4 else 0.0,
        upper,
        repeats,
        1 - distinct,
        (1 - distinct) * min(1.0, n / 50),
        min(1.0, 10 * symbols),
        1.0 if symbols > 0.05 else 0.0,
        min(1.0, line.count("!") / n),
        min(1.0, line.count("|") / n),
        len(_DIGITS.findall(line)) / size,
        1.0 if last in ".!?\"'" else 0.0,
        min(1.0, size / n / 20),
    ]


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line with those of its neighbours, and the lengths of the lines."""
    lines = text.split("\n")
    own = np.array([line_features(x) for x in lines], np.float32)
    edge = np.zeros((1, OWN), np.float32)
    ends = np.zeros((len(lines), 2), np.float32)
    ends[0, 0], ends[-1, 1] = 1, 1
    joined = np.hstack([own, np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge]), ends, np.ones((len(lines), 1), np.float32)])
    return joined, np.array([max(1, len(x)) for x in lines], np.float64)


def marginals(unary: list[float], pair: np.ndarray) -> tuple[list[float], list[float], float]:
    """P(bad) of each line, P(bad, bad) and so on summed over neighbours, and log Z.

    ``unary`` is the log odds of bad, ``pair`` the 2 x 2 log weights of neighbours."""
    e = np.exp(pair - pair.max())
    g, gb, bg, bb = (float(v) for v in (e[0, 0], e[0, 1], e[1, 0], e[1, 1]))
    odds = [float(np.exp(min(30.0, max(-30.0, u)))) for u in unary]
    forward, scale = [], 0.0
    a0, a1 = 1.0, odds[0]
    for k in range(len(odds)):
        if k:
            a0, a1 = a0 * g + a1 * bg, (a0 * gb + a1 * bb) * odds[k]
        total = a0 + a1
        a0, a1 = a0 / total, a1 / total
        scale += np.log(total)
        forward.append((a0, a1))
    p, joint = [0.0] * len(odds), [0.0] * 4
    b0, b1 = 1.0, 1.0
    for k in range(len(odds) - 1, -1, -1):
        a0, a1 = forward[k]
        total = a0 * b0 + a1 * b1
        p[k] = a1 * b1 / total
        if k:
            f0, f1 = forward[k - 1]
            cells = (f0 * g * b0, f0 * gb * odds[k] * b1, f1 * bg * b0, f1 * bb * odds[k] * b1)
            whole = sum(cells)
            joint = [j + c / whole for j, c in zip(joint, cells)]
            b0, b1 = g * b0 + gb * odds[k] * b1, bg * b0 + bb * odds[k] * b1
            whole = b0 + b1
            b0, b1 = b0 / whole, b1 / whole
    return p, joint, scale


@dataclass
class Field:
    """The learnt model: weights of the features for bad, of neighbours, and of the share."""

    weights: np.ndarray
    pair: np.ndarray
    share: np.ndarray
    constant: float | None = None

    def bad(self, features: np.ndarray) -> list[float]:
        return marginals((features @ self.weights).tolist(), self.pair)[0]

    def bad_share(self, text: str) -> tuple[float, int]:
        features, lengths = text_features(text)
        return float(np.dot(self.bad(features), lengths) / lengths.sum()), len(lengths)

    def score(self, share: float) -> float:
        if self.constant is not None:
            return self.constant
        x = np.append(aggregate(np.array([share]))[0], 1.0)
        return float(1 / (1 + np.exp(-np.clip(x @ self.share, -30, 30))))


def aggregate(share: np.ndarray) -> np.ndarray:
    return np.column_stack([share, np.log(share + 0.01)])


def _batched_gradient(xs, ys, weights, pair):
    """Gradient of the mean log likelihood; documents are padded to the longest."""
    x, y, mask = xs, ys, ys >= 0
    unary = np.clip(np.einsum("dlf,f->dl", x, weights), -30, 30)
    docs, length = y.shape
    alpha, beta = np.zeros((length, docs, 2)), np.zeros((length, docs, 2))
    node = np.stack([np.zeros_like(unary), unary], -1)
    alpha[0] = node[:, 0]
    for k in range(1, length):
        step = np.logaddexp(alpha[k - 1][:, :1] + pair[0], alpha[k - 1][:, 1:] + pair[1]) + node[:, k]
        alpha[k] = np.where(mask[:, k, None], step, alpha[k - 1])
    z = np.logaddexp(alpha[-1][:, 0], alpha[-1][:, 1])
    joint = np.zeros((2, 2))
    for k in range(length - 2, -1, -1):
        ahead = node[:, k + 1] + beta[k + 1]
        both = pair[None] + ahead[:, None, :]
        step = np.logaddexp(both[:, :, 0], both[:, :, 1])
        beta[k] = np.where(mask[:, k + 1, None], step, beta[k + 1])
        cells = np.exp(alpha[k][:, :, None] + both - z[:, None, None])
        joint += (cells * mask[:, k + 1, None, None]).sum(0)
    p = np.exp(alpha[:, :, 1] + beta[:, :, 1] - z).T * mask
    diff = (y == 1) * mask - p
    grad = np.einsum("dl,dlf->f", diff, x)
    seen = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            seen[a, b] = ((y[:, :-1] == a) & (y[:, 1:] == b)).sum()
    return grad / docs, (seen - joint) / docs, p


def train(documents: list[tuple[np.ndarray, np.ndarray, int]], sizes: dict[int, int]) -> Field:
    """``documents``: features, line lengths and label (1 good) of each."""
    good = sum(label for _, _, label in documents)
    if not 0 < good < len(documents):
        known = sum(sizes.values())
        constant = sizes.get(1, 0) / known if known else 0.5
        return Field(np.zeros(3 * OWN + 3), np.zeros((2, 2)), np.zeros(3), constant)
    length = max(len(f) for f, _, _ in documents)
    width = documents[0][0].shape[1]
    x = np.zeros((len(documents), length, width), np.float32)
    y = np.full((len(documents), length), -1)
    for i, (features, _, label) in enumerate(documents):
        x[i, : len(features)] = features
        y[i, : len(features)] = 1 - label
    bad_documents = np.array([label == 0 for _, _, label in documents])
    weights, pair = np.zeros(width), np.zeros((2, 2))
    for round_ in range(ROUNDS):
        speed = [np.zeros(width), np.zeros(width), np.zeros((2, 2)), np.zeros((2, 2))]
        for step in range(1, 41):
            g, gp, p = _batched_gradient(x, y, weights, pair)
            g, gp = g - 2e-3 * weights, gp - 2e-3 * pair
            for value, grad, m, v in ((weights, g, 0, 1), (pair, gp, 2, 3)):
                speed[m] = 0.8 * speed[m] + 0.2 * grad
                speed[v] = 0.95 * speed[v] + 0.05 * grad**2
                value += 0.25 * (speed[m] / (1 - 0.8**step)) / (np.sqrt(speed[v] / (1 - 0.95**step)) + 1e-6)
        if round_ < ROUNDS - 1:
            worst = p.argmax(1)
            mended = (p >= 0.5).astype(int)
            mended[np.arange(len(p)), worst] = 1
            y = np.where((y >= 0) & bad_documents[:, None], mended, y)
    model = Field(weights, pair, np.zeros(3))
    share = np.array([np.dot(model.bad(f), n) / n.sum() for f, n, _ in documents])
    label = np.array([d[2] for d in documents], float)
    whole = sizes.get(0, 0) + sizes.get(1, 0)
    per = {c: sizes.get(c, 0) / whole / max(1, int((label == c).sum())) for c in (0, 1)}
    model.share = fit_logistic(aggregate(share), label, np.where(label == 1, per[1], per[0]))
    return model


def learn(docs: DataFrame, labels: DataFrame) -> Field:
    learnable = fold("doc_id", 5) != 0
    sizes = class_sizes(labels, "quality", learnable)
    sample = labelled_sample(docs, labels, "quality", learnable, {0: PER_CLASS, 1: PER_CLASS})

    def run(columns: list[list]) -> list:
        rows = [(i, label, *text_features(text)) for i, text, label in zip(*columns) if text.count("\n") < MAX_LINES]
        return [[r[0] for r in rows], [r[1] for r in rows], [r[2].tobytes() for r in rows], [r[3].tobytes() for r in rows]]

    rows = map_rows(sample.select("doc_id", "text", "label"), "doc_id long, label int, features binary, lengths binary", run)
    rows = rows.groupBy("doc_id").agg(*[F.first(c).alias(c) for c in rows.columns[1:]]).collect()
    width = 3 * OWN + 3
    rows.sort(key=lambda r: r[0])
    return train([(np.frombuffer(f, np.float32).reshape(-1, width), np.frombuffer(n), label) for _, label, f, n in rows], sizes)


def score_quality(docs: DataFrame, model: Field) -> DataFrame:
    def run(columns: list[list]) -> list:
        shares = [model.bad_share(t) for t in columns[2]]
        scores = [model.score(s) for s, _ in shares]
        return [columns[0], columns[1], scores, [int(s >= THRESHOLD) for s in scores], *map(list, zip(*shares))]

    df = texts(docs).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text")
    return map_rows(df, SCHEMA, run)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score_quality(docs, learn(docs, table(spark, folder, "labels")))
