"""Language identification by a byte convolutional network.

Bytes of fixed-length windows are embedded, filters of several widths slide over them, the largest answer of each filter in
a window counts, and a softmax layer gives the language. The network is trained in numpy on a sample of labelled windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotally.llm.common import fold, ids_and_texts, with_ids

#: Bytes of a window; widths of the filters and filters of each width; size of a byte's embedding.
WINDOW, WIDTHS, FILTERS, EMBEDDING = 256, (2, 3, 4, 5), 8, 8
#: Bounds of the sample the network learns from: documents of a language (on average), and windows of a document.
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC = 600, 4
EPOCHS, BATCH, RATE = 5, 64, 0.01
UNKNOWN = "und"


def windows(text: str) -> np.ndarray:
    """All bytes of the lower-cased text in rows of fixed length, the last one filled up with zeros."""
    raw = text.lower().encode()
    n = max(1, -(-len(raw) // WINDOW))
    return np.frombuffer(raw.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


class ByteConvNet:
    """Weights and passes of the network; the filters of all widths share one matrix, narrow ones end in zeros."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        widest, n = max(WIDTHS), FILTERS * len(WIDTHS)
        self.mask = np.zeros((widest * EMBEDDING, n), np.float32)
        for k, w in enumerate(WIDTHS):
            self.mask[: w * EMBEDDING, k * FILTERS : (k + 1) * FILTERS] = 1
        self.p = {
            "embedding": rng.normal(0, 0.3, (256, EMBEDDING)).astype(np.float32),
            "filters": (rng.normal(0, 0.2, self.mask.shape) * self.mask).astype(np.float32),
            "bias": np.zeros(n, np.float32),
            "dense": rng.normal(0, 0.1, (n, len(languages))).astype(np.float32),
            "out": np.zeros(len(languages), np.float32),
        }

    def _patches(self, x: np.ndarray) -> np.ndarray:
        """What the filters see at each position, (rows, positions, widest * embedding)."""
        widest = max(WIDTHS)
        padded = np.zeros((len(x), x.shape[1] + widest - 1), np.uint8)
        padded[:, : x.shape[1]] = x
        e = self.p["embedding"][padded]
        seen = np.lib.stride_tricks.sliding_window_view(e, widest, axis=1)  # (rows, positions, embedding, widest)
        return np.ascontiguousarray(seen.swapaxes(2, 3)).reshape(len(x), x.shape[1], -1)

    def _softmax(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled, 0) @ self.p["dense"] + self.p["out"]
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = [np.zeros((0, len(self.languages)), np.float32)]
        for at in range(0, len(x), 128):
            seen = self._patches(x[at : at + 128])
            out.append(self._softmax((seen @ self.p["filters"]).max(1) + self.p["bias"]))
        return np.concatenate(out)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        seen = self._patches(x)
        answer = seen @ self.p["filters"]
        where = answer.argmax(1)  # (rows, filters): only the largest answer learns
        pooled = np.take_along_axis(answer, where[:, None, :], 1)[:, 0] + self.p["bias"]
        z = self._softmax(pooled)
        z[np.arange(len(y)), y] -= 1
        z /= len(y)
        hidden = (z @ self.p["dense"].T) * (pooled > 0)
        patch = seen[np.arange(len(x))[:, None], where]  # (rows, filters, widest * embedding)
        filters = np.einsum("nf,nfk->kf", hidden, patch) * self.mask
        spread = (hidden[:, :, None] * self.p["filters"].T[None]).reshape(-1, EMBEDDING)
        reach = where[:, :, None] + np.arange(max(WIDTHS))
        padded = np.zeros((len(x), x.shape[1] + max(WIDTHS) - 1), np.uint8)
        padded[:, : x.shape[1]] = x
        embedding = np.zeros_like(self.p["embedding"])
        np.add.at(embedding, padded[np.arange(len(x))[:, None, None], reach].ravel(), spread)
        return {
            "embedding": embedding,
            "filters": filters,
            "bias": hidden.sum(0),
            "dense": np.maximum(pooled, 0).T @ z,
            "out": z.sum(0),
        }

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> ByteConvNet:
        """Adam over shuffled batches."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                t += 1
                take = order[at : at + BATCH]
                for k, g in self.gradients(x[take], y[take]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    step = RATE / (1 + epoch) * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-6)
                    self.p[k] = (self.p[k] - step).astype(np.float32)
        return self


def trained(docs: DataFrame) -> ByteConvNet | None:
    """A network for the languages of the learnable rows of ``docs`` (id, text, lang, learnable); None if there are none.

    Learns from about DOCS_PER_LANGUAGE documents of each language, drawn by a hash of the id, and WINDOWS_PER_DOC
    windows of each, spread over the whole text.
    """
    usable = docs.where(F.col("learnable") & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return None
    draw, share = F.pmod(F.xxhash64("id"), F.lit(1_000_003)), F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, int(min(1, DOCS_PER_LANGUAGE / n) * 1_000_003) + 1).otherwise(share)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, t, lang in zip(b["id"], b["text"], b["lang"], strict=True):
                w = windows(t)
                for k in sorted({len(w) * j // WINDOWS_PER_DOC for j in range(WINDOWS_PER_DOC)}):
                    out.append((str(i), k, lang, w[k].tobytes()))
            yield pd.DataFrame(out, columns=["id", "k", "lang", "window"])

    drawn = usable.where(draw < share).select("id", "text", "lang")
    rows = sorted((r.lang, r.id, r.k, bytes(r.window)) for r in drawn.mapInPandas(cut, "id string, k int, lang string, window binary").collect())
    languages = sorted({r[0] for r in rows})
    if not rows:
        return None
    x = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(-1, WINDOW)
    return ByteConvNet(languages).train(x, np.array([languages.index(r[0]) for r in rows]))


def predicted(docs: DataFrame, network: ByteConvNet | None) -> DataFrame:
    """``docs`` (id, text, held_out) with lang_pred and score in place of the text."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            langs, scores = [], []
            for at in range(0, len(b), 256):
                cuts = [windows(t) if ok else None for t, ok in zip(b["text"][at : at + 256], b["ok"][at : at + 256], strict=True)]
                kept = [c for c in cuts if c is not None]
                found = network.predict(np.concatenate(kept)) if kept else np.zeros((0, 0))
                first = 0
                for c in cuts:
                    if c is None:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    weight = (c != 0).sum(1)
                    mean = weight @ found[first : first + len(c)].astype(float) / max(1, weight.sum())
                    first += len(c)
                    langs.append(network.languages[int(mean.argmax())])
                    scores.append(min(1.0, float(mean.max())))
            yield pd.DataFrame({"id": b["id"], "held_out": b["held_out"], "lang_pred": langs, "score": scores})

    known = F.lit(network is not None) & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("id", "text", "held_out", known.alias("ok"))
    return rows.mapInPandas(each, "id string, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", of: int = 3, held: int = 1) -> DataFrame:
    """(id, held_out, lang_pred, score), one row per row of ``docs``.

    Learns from text and language of rows whose fold (crc32 of the id as text, modulo ``of``) is not ``held``; rows without
    id are neither held out nor learned from. A text that is null or has no letter is ``und`` with score 0, and so is
    every text if no row has a language. The score is the mean probability of the language over the text's bytes.
    """
    out = F.coalesce(fold(F.col(id_col), of) == held, F.lit(False))
    rows = ids_and_texts(docs, id_col, text_col, F.col(lang_col).alias("lang"), out.alias("held_out"))
    rows = rows.withColumn("learnable", ~F.col("held_out") & F.col("id").isNotNull())
    return with_ids(predicted(rows, trained(rows)), docs, id_col, id_col)
