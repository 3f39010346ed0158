"""Toxicity after noisy-channel deobfuscation.

A disguised word is a lattice: each character stands for itself, for the letters it looks like, for a repetition or for
nothing. Viterbi decoding finds the likeliest letters under a character language model that is counted over all documents.
Restored words are scored by how much more often labelled toxic documents have them, or words that begin like them.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from math import exp, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotally.llm.common import fold, ids_and_texts, label_sample, with_ids, written

#: Bounds of the sample the scores are learned from, and of the word features that the model keeps.
SAMPLE_DOCS = 12_000
#: Letters a character may stand for in disguise.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
#: Signs that may hide any letter.
HIDES = "*#"
#: Costs (negative logarithms) of the channel: a look-alike, a hidden letter, a dropped separator, one that does part two words, a
#: dropped repetition, a dropped other sign.
LOOK, HIDE, SPACE, PART, REPEAT, DROP = 1.0, 3.0, 0.3, 1.0, 1.2, 2.5
SEPARATORS = " ._-"
PREFIXES = (4, 5, 6)
#: Documents that stand behind a feature at least, smoothing in documents, and log-odds that make it worth keeping.
LEAST_DOCS, SMOOTHING, LEAST_ODDS = 3, 4.0, 1.5
TOP = 5
#: Words a task remembers.
REMEMBERED = 400_000

_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_][ ._*\-]){2,}[^\W\d_](?!\S)")
_SOFT = ".,;:?!\"'`)]}>"
_TAIL = re.compile(r"(?:([*#$@&%|+~^=])\1{2,}|[%&~^=])+$")


def is_latin(letter: str) -> bool:
    return letter < "ɐ"


class CharModel:
    """Character trigrams within words; a blank stands before and after a word."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        self.before: Counter[str] = Counter()
        letters: Counter[str] = Counter()
        for t, n in counts.items():
            self.before[t[:2]] += n
            letters[t[2]] += n
        self.letters = sorted(c for c in letters if c != " ")
        self.known: dict[str, float] = {}

    def cost(self, trigram: str) -> float:
        found = self.known.get(trigram)
        if found is None:
            found = -log((self.counts.get(trigram, 0) + 0.05) / (self.before.get(trigram[:2], 0) + 0.05 * (len(self.letters) + 1)))
            self.known[trigram] = found
        return found

    def restored(self, seen: str) -> str:
        """The likeliest letters behind ``seen``; blanks between words."""
        states = {"  ": (0.0, "")}
        last = ""
        for c in seen:
            ways: list[tuple[str, float]] = []
            if c.isalpha():
                ways.append((c, 0.0))
                if c == last:
                    ways.append(("", REPEAT))
            else:
                ways += [(x, LOOK) for x in LOOKS_LIKE.get(c, "")]
                if c in HIDES:
                    ways += [(x, HIDE) for x in self.letters]
                ways.append(("", SPACE if c in SEPARATORS + HIDES + "'" else REPEAT if c == last else DROP))
                if c in SEPARATORS:
                    ways.append((" ", PART))
            last = c
            then: dict[str, tuple[float, str]] = {}
            for state, (cost, path) in states.items():
                for letter, price in ways:
                    total = cost + price + (self.cost(state + letter) if letter else 0)
                    key = "  " if letter == " " else state[1] + letter if letter else state
                    if key not in then or (total, path) < then[key]:
                        then[key] = (total, path + letter)
            states = then
        return min((cost + self.cost(state + " "), path) for state, (cost, path) in states.items())[1]


def word_forms(token: str, model: CharModel) -> list[str]:
    """The words behind a lower-cased token: its letters as they stand, and what its disguise hides."""
    core = _TAIL.sub("", token.rstrip(_SOFT)).strip(_SOFT + "([{<")
    bare = core.strip("*#$@&%|+~^=-_")
    if bare.isalpha() and (bare == core or len(core) - len(bare) > 2):
        return [bare, *model.restored(bare).split()] if _TRIPLE.search(bare) else [bare]
    if not any(c.isalpha() for c in core):
        return []
    plain = "".join(c for c in core if c.isalpha())
    restored = model.restored(core).split()
    return list(dict.fromkeys([plain, *restored] if len(restored) < 2 else restored))


def tokens(text: str | None) -> set[str]:
    """The different tokens of a text, and its runs of single letters."""
    low = (text or "").lower()
    found = set(low.split())
    if sum(len(t) == 1 for t in found) > 1:
        found.update(m.group() for m in _SPACED.finditer(low))
    return found


def features(word: str) -> list[str]:
    return [f"={word}", *(f"{k}{word[:k]}" for k in PREFIXES if len(word) >= k)] if word else []


def char_model(docs: DataFrame, text_col: str = "text") -> CharModel:
    """Trigrams of the words of all documents; only Latin letters count, so their number is bounded by the alphabet."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[str] = Counter()
        for b in batches:
            met: Counter[str] = Counter()
            for t in b["text"]:
                met.update((t or "").lower().split())
            for token, n in met.items():
                w = token.strip(_SOFT + "([{<")
                if w.isalpha():
                    w = f"  {w} "
                    for k in range(len(w) - 2):
                        total[w[k : k + 3]] += n
        kept = [(t, n) for t, n in total.items() if all(map(is_latin, t))]
        yield pd.DataFrame(kept, columns=["trigram", "n"])

    rows = docs.select(F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    counts = rows.mapInPandas(each, "trigram string, n long").groupBy("trigram").agg(F.sum("n").alias("n"))
    return CharModel({r.trigram: r.n for r in counts.collect()})


@dataclass
class ToxicModel:
    """Log-odds of features, and a logistic curve over the largest scores of a document's words."""

    chars: CharModel
    odds: dict[str, float]
    curve: np.ndarray = field(default_factory=lambda: np.array([0.0] * (TOP + 1) + [-3.0]))
    _known: dict[str, list[float]] = field(default_factory=dict, repr=False)

    def word_scores(self, token: str) -> list[float]:
        """Scores of the words behind a token that speak for toxicity; of the forms of one word only the best counts."""
        found = self._known.get(token)
        if found is None:
            if len(self._known) > REMEMBERED:
                self._known.clear()
            forms = word_forms(token, self.chars) if self.odds else []
            found = [s for s in (max((self.odds.get(f, 0.0) for f in features(w)), default=0.0) for w in forms) if s]
            found = [max(found)] if found and token.isalpha() else found
            self._known[token] = found
        return found

    def evidence(self, text: str | None) -> list[float]:
        """The largest word scores, and how many different words there are."""
        found = tokens(text)
        best = sorted(chain.from_iterable(map(self.word_scores, found)), reverse=True)[:TOP]
        return [*best, *[0.0] * (TOP - len(best)), log(1 + len(found)), 1.0]

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.evidence(text), self.curve), -30, 30))))


def _fitted_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    ridge = 1e-2 * np.eye(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
    return w


def trained(docs: DataFrame, labels: DataFrame, of: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text") -> ToxicModel:
    """Model of at most SAMPLE_DOCS labelled documents; labels of fold ``held`` are not read.

    One half of the sample gives the scores of the words from which the curve is learned on the other half; the scores
    that stay come from both.
    """
    chars = char_model(docs, text_col)
    sample = label_sample(labels, "toxic", of, held, SAMPLE_DOCS)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int").alias("half")
    chosen = rows.join(F.broadcast(sample), "doc_id").select("text", (F.col("label") > 0).cast("int").alias("toxic"), half)
    sent = docs.sparkSession.sparkContext.broadcast(chars)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: dict[tuple[str, int], list[int]] = defaultdict(lambda: [0, 0])
        for b in batches:
            for text, toxic, part in zip(b["text"], b["toxic"], b["half"], strict=True):
                for f in {f for t in tokens(text) for w in word_forms(t, sent.value) for f in features(w)} | {""}:
                    at = met[f, part]
                    at[0] += toxic
                    at[1] += 1
        yield pd.DataFrame([(f, h, t, n) for (f, h), (t, n) in met.items()], columns=["feature", "half", "toxic", "n"])

    both = [F.sum(F.when(F.col("half") == h, F.col(c)).otherwise(0)).alias(f"{c}{h}") for h in (0, 1) for c in ("toxic", "n")]
    counts = written(chosen.mapInPandas(counted, "feature string, half int, toxic long, n long").groupBy("feature").agg(*both), "features")
    all_toxic, all_n = F.col("toxic0") + F.col("toxic1"), F.col("n0") + F.col("n1")
    total = counts.where("feature = ''").first()
    if total is None or not 0 < total.toxic0 + total.toxic1 < total.n0 + total.n1:
        return ToxicModel(chars, {})

    def odds(toxic: int, n: int, of_all: float) -> float:
        return log((toxic + of_all * SMOOTHING) / (n - toxic + (1 - of_all) * SMOOTHING)) - log(of_all / (1 - of_all))

    share = (total.toxic0 + total.toxic1) / (total.n0 + total.n1)
    # Every feature of high odds in half or all of the sample, which bounds them. Odds are monotone in the smoothed share, to be sure by half.
    likely = [(t + share * SMOOTHING) / (n - t + (1 - share) * SMOOTHING) for t, n in ((F.col("toxic0"), F.col("n0")), (all_toxic, all_n))]
    worth = counts.where((F.col("feature") != "") & (all_n >= LEAST_DOCS) & (all_toxic * 4 >= all_n))
    got = worth.where(F.greatest(*likely) >= share / (1 - share) * exp(LEAST_ODDS) * 0.99).collect()
    first = {r.feature: odds(r.toxic0, r.n0, share) for r in got if r.feature and r.n0 >= LEAST_DOCS - 1}
    final = {r.feature: odds(r.toxic0 + r.toxic1, r.n0 + r.n1, share) for r in got if r.feature}
    draft = ToxicModel(chars, {f: s for f, s in first.items() if s >= LEAST_ODDS})
    sent_draft = docs.sparkSession.sparkContext.broadcast(draft)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"toxic": b["toxic"], "x": [sent_draft.value.evidence(t) for t in b["text"]]})

    seen = sorted((r.toxic, *r.x) for r in chosen.where("half = 1").mapInPandas(judged, "toxic int, x array<double>").collect())
    if not seen:
        return ToxicModel(chars, {})
    data = np.array(seen)
    return ToxicModel(chars, {f: s for f, s in final.items() if s >= LEAST_ODDS}, _fitted_curve(data[:, 1:], data[:, 0]))


def toxicity(docs: DataFrame, labels: DataFrame, of: int = 4, held: int = 2, least: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted), one row per row of ``docs``; predicted is 1 if the score is at least ``least``.

    Learns from labels of rows whose fold (crc32 of the id as text, modulo ``of``) is not ``held``. Null and empty texts
    have no words. Without labels of both kinds every document has the same low score.
    """
    sent = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, of, held, id_col, text_col))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "score": [sent.value.score(t) for t in b["text"]]})

    out = F.coalesce(fold(F.col(id_col), of) == held, F.lit(False))
    found = with_ids(ids_and_texts(docs, id_col, text_col).mapInPandas(each, "id string, score double"), docs, id_col, id_col)
    return found.select(id_col, out.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
