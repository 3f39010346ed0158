"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features are its own and those of the lines before and after it. Labels are known of documents
only: all lines of a good document are good, those of a bad one are found by fitting and relabelling in turn. The
forward-backward marginals of the lines, weighted by their length, give the quality of the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotally.llm.common import fold, label_sample

#: Bounds of the sample the model learns from: documents, and lines of one. Sampled documents are learned from whole; a longer one
#: is not in the sample.
SAMPLE_DOCS, SAMPLE_LINES = 4000, 400
ROUNDS, STEPS, RATE, RIDGE = 3, 120, 0.05, 1e-3
#: Classes of bytes whose share in a line is a feature.
_KINDS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:'\"()-?", " \t\r\x0b\f", "|", "!"]
_KIND_OF = np.full(256, len(_KINDS), np.int64)  # the rest: other signs
for _k, _chars in enumerate(_KINDS):
    _KIND_OF[list(_chars.encode())] = _k
_KIND_OF[0x80:] = 0
OWN = len(_KINDS) + 1 + 8
WIDTH = 1 + 3 * OWN + 2


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, lengths in bytes) of all lines of a text; null is one empty line."""
    raw = (text or "").encode()
    lines = raw.split(b"\n")
    n = len(lines)
    sizes = np.fromiter(map(len, lines), np.int64, n)
    starts = np.cumsum(sizes + 1) - sizes - 1
    kinds = _KIND_OF[np.frombuffer(raw + b"\n", np.uint8)]
    owner = np.repeat(np.arange(n), sizes + 1)
    inside = np.ones(len(kinds), bool)
    inside[starts + sizes] = False
    counts = np.bincount(owner[inside] * (len(_KINDS) + 1) + kinds[inside], minlength=n * (len(_KINDS) + 1)).reshape(n, -1)
    own = np.zeros((n, OWN), np.float32)
    own[:, : len(_KINDS) + 1] = counts / np.maximum(sizes, 1)[:, None]
    at = len(_KINDS) + 1
    seen: set[bytes] = set()
    before = b""
    for k, line in enumerate(lines):
        w = line.split()
        many = len(w)
        own[k, at : at + 8] = (
            np.log1p(many) / 4,
            1 - len(set(w)) / many if many else 0,
            sum(map(bytes.__eq__, w, w[1:])) / many if many else 0,
            (sizes[k] / many if many else 0) / 10,
            line == before,
            line in seen,
            line[-1:] in b".!?" if line else 0,
            many == 0,
        )
        seen.add(line)
        before = line
    x = np.zeros((n, WIDTH), np.float32)
    x[:, 0] = 1
    x[:, 1 : 1 + OWN] = own
    x[1:, 1 + OWN : 1 + 2 * OWN] = own[:-1]
    x[:-1, 1 + 2 * OWN : 1 + 3 * OWN] = own[1:]
    x[0, -2] = x[-1, -1] = 1
    return x, sizes


@dataclass
class LineCrf:
    """Weight vector of "good", log-weights of the four transitions, and the curve from line marginals to a document's score."""

    weights: np.ndarray
    steps: np.ndarray
    curve: tuple[float, float] = (1.0, 0.0)

    def marginals(self, scores: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """P(good) of each line of each document, and the expected transitions of all; ``scores`` are of "good" against "bad".

        Documents advance side by side, the longest first, so that those still going are always the first ones.
        """
        order = sorted(range(len(scores)), key=lambda d: -len(scores[d]))
        sizes = np.array([len(scores[d]) for d in order])
        firsts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        flat = np.concatenate([scores[d] for d in order]) if len(order) else np.zeros(0)
        move = np.exp(self.steps)
        emit = np.stack([np.ones(len(flat)), np.exp(np.clip(flat, -30, 30))], 1)
        fore, back = np.zeros_like(emit), np.ones_like(emit)
        going = [int((sizes > t).sum()) for t in range(int(sizes.max(initial=0)))]
        for t, g in enumerate(going):
            at = firsts[:g] + t
            fore[at] = emit[at] if t == 0 else (fore[at - 1] @ move) * emit[at]
            fore[at] /= fore[at].sum(1, keepdims=True)
        expected = np.zeros((2, 2))
        for t in range(len(going) - 2, -1, -1):
            at = firsts[: going[t + 1]] + t
            ahead = emit[at + 1] * back[at + 1]
            both = fore[at][:, :, None] * move * ahead[:, None, :]
            expected += (both / both.sum((1, 2), keepdims=True)).sum(0)
            b = ahead @ move.T
            back[at] = b / b.sum(1, keepdims=True)
        good = fore * back
        good = good[:, 1] / np.maximum(good.sum(1), 1e-300)
        out: list[np.ndarray] = [good] * len(order)
        for k, d in enumerate(order):
            out[d] = good[firsts[k] : firsts[k] + sizes[k]]
        return out, expected

    def bad_share(self, lines: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Of each document, the share of its bytes that are expected in bad lines (an empty line counts as one byte)."""
        good, _ = self.marginals([x @ self.weights for x, _ in lines])
        return np.array([np.dot(1 - g, s + 1) / (s + 1).sum() for g, (_, s) in zip(good, lines, strict=True)])

    def scores(self, lines: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(np.clip(a * np.log(self.bad_share(lines) + 1e-4) + b, -30, 30)))

    def fit(self, lines: list[np.ndarray], labels: list[np.ndarray]) -> LineCrf:
        """Gradient ascent (Adam) on the likelihood of the line labels."""
        x, y = np.concatenate(lines), np.concatenate(labels)
        met = np.zeros((2, 2))
        for lab in labels:
            np.add.at(met, (lab[:-1], lab[1:]), 1)
        theta = np.concatenate([self.weights, self.steps.ravel()])
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for t in range(1, STEPS + 1):
            self.weights, self.steps = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
            good, expected = self.marginals([z @ self.weights for z in lines])
            grad = np.concatenate([x.T @ (y - np.concatenate(good)), (met - expected).ravel()]) / len(y) - RIDGE * theta
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            theta = theta + RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        self.weights, self.steps = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
        return self


def fitted(lines: list[tuple[np.ndarray, np.ndarray]], quality: np.ndarray) -> LineCrf:
    """A model of documents given as lines with their 0/1 quality; one that finds all documents good if there are none."""
    model = LineCrf(np.zeros(WIDTH), np.zeros((2, 2)), (1.0, -10.0))
    if not len(quality) or quality.min() == quality.max():
        model.curve = (0.0, 10.0 if len(quality) and quality.max() == 0 else -10.0)
        return model
    x = [a for a, _ in lines]
    labels = [np.full(len(a), q) for a, q in zip(x, quality, strict=True)]
    for _ in range(ROUNDS):
        model.fit(x, labels)
        good, _ = model.marginals([a @ model.weights for a in x])
        for d in np.flatnonzero(quality == 0):  # the worst line of a bad document stays bad
            labels[d] = ((good[d] > 0.5) & (good[d] > good[d].min())).astype(int)
    z = np.log(model.bad_share(lines) + 1e-4)
    a, b = 1.0, 0.0
    design = np.stack([z, np.ones_like(z)], 1)
    for _ in range(30):  # Newton steps of a logistic curve
        p = 1 / (1 + np.exp(-np.clip(design @ [a, b], -30, 30)))
        hess = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        a, b = np.array([a, b]) + np.linalg.solve(hess, design.T @ ((1 - quality) - p) - 1e-3 * np.array([a, b]))
    model.curve = (float(a), float(b))
    return model


def trained(docs: DataFrame, labels: DataFrame, of: int = 3, held: int = 1, id_col: str = "doc_id", text_col: str = "text") -> LineCrf:
    """Model of at most SAMPLE_DOCS whole labelled documents of up to SAMPLE_LINES lines; labels of fold ``held`` are not read."""
    sample = label_sample(labels, "quality", of, held, SAMPLE_DOCS)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # SAMPLE_DOCS rows of two numbers. Ids are carried as text, whatever their type.
    chosen = rows.join(F.broadcast(sample), "doc_id").withColumn("doc_id", F.col("doc_id").cast("string"))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, t, q in zip(b["doc_id"], b["text"], b["label"], strict=True):
                x, s = line_features(t)
                if len(s) <= SAMPLE_LINES:
                    out.append((i, q, x.astype(np.float32).tobytes(), s.tobytes()))
            yield pd.DataFrame(out, columns=["doc_id", "quality", "x", "sizes"])

    got = sorted(chosen.mapInPandas(each, "doc_id string, quality int, x binary, sizes binary").collect(), key=lambda r: r[:3])
    lines = [(np.frombuffer(r.x, np.float32).reshape(-1, WIDTH).astype(float), np.frombuffer(r.sizes, np.int64)) for r in got]
    return fitted(lines, np.array([min(1, max(0, r.quality)) for r in got], int))


def score(model: LineCrf, text: Column, at_once: int = 256) -> Column:
    """Quality of each whole text, 0 to 1."""

    @F.pandas_udf("double")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            parts = [model.scores([line_features(t) for t in b[at : at + at_once]]) for at in range(0, len(b), at_once)]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype=float)

    return each(text)


def quality(docs: DataFrame, labels: DataFrame, of: int = 3, held: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted), one row per row of ``docs``.

    Learns from labels of rows whose fold (crc32 of the id as text, modulo ``of``) is not ``held``. Null and empty texts
    are one empty line. Without labels, or with one kind of label, all documents get the same score (without any, a good one).
    """
    found = docs.select(
        id_col,
        F.coalesce(fold(F.col(id_col), of) == held, F.lit(False)).alias("held_out"),
        score(trained(docs, labels, of, held, id_col, text_col), F.col(text_col)).alias("score"),
    )
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
