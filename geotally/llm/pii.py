"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities: e-mail and IP addresses, payment cards, phone numbers. Other words of the documents that
mention one may reveal it as well. How much a word tells about an entity is their pointwise mutual information over the documents
of the corpus; a word that tells nearly all there is to know, in several documents, is generalised or removed wherever it stands, in
documents without a mention too.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotally.llm.common import ids_and_texts, with_ids, written

KINDS = ("email", "ip", "card", "phone", "term")
#: Letters of a term at least.
LEAST_LETTERS = 3
#: Documents that stand behind a word and its entity at least; share of the entity's information that a word may give away
#: before it is generalised, and before it is removed.
LEAST_DOCS, GENERALISE, REMOVE = 3, 0.9, 0.98
#: Different words a task counts before it hands them on, and documents it works on at once.
COUNTED_AT_ONCE, AT_ONCE = 200_000, 500
#: Telling terms that are sent to every task at most; beyond that they are joined with the occurrences of all words.
SENT_TERMS = 200_000

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
# A run of digits is tried from its first digit only; from a later one it fails just the same.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(free, at + 1))


def luhn(digits: str) -> bool:
    """Whether the check digit at the end is right."""
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, entity) of all mentions, leftmost and without overlap within a kind; the entity is their plain value."""
    text = text or ""
    found = [("email", a, z, text[a:z].lower()) for a, z in _emails(text)]
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            found.append(("ip", *m.span(), m.group()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span(), digits))
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = "".join(_DIGIT.findall(m.group()))
            if 9 <= len(digits) <= 15:
                found.append(("phone", *m.span(), digits))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def free_words(text: str, spans: list[tuple[str, int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, term) of the words outside all mentions; a term is the word in lower case."""
    taken, z = [], 0
    for _, a, b, _ in sorted(spans, key=lambda s: s[1]):
        if a >= z:
            taken.append([a, b])
        z = max(z, b)
        taken[-1][1] = z
    starts = [a for a, _ in taken]
    out = []
    for m in _WORD.finditer(text):
        a, b = m.span()
        if b - a >= LEAST_LETTERS:
            k = bisect_left(starts, b) - 1
            if k < 0 or taken[k][1] <= a:
                out.append((a, b, m.group().lower()))
    return out


def terms_of(text: str, spans: list[tuple[str, int, int, str]]) -> set[str]:
    """The different terms of a text outside all mentions."""
    if spans:
        return {t for *_, t in free_words(text, spans)}
    return {w.lower() for w in set(_WORD.findall(text)) if len(w) >= LEAST_LETTERS}


def _some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield from (b.iloc[first : first + AT_ONCE] for first in range(0, len(b), AT_ONCE))


def counted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """What the estimate needs, from one pass over the texts, in two kinds of rows.

    Documents with mentions have their ``entities`` and ``terms``, each once; other rows have a ``term`` and in how many ``docs`` of
    a task it is, the null term being all documents.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["entities", "terms", "term", "docs"]
        met: Counter[str | None] = Counter()

        def counts() -> pd.DataFrame:
            found = pd.DataFrame([(None, None, t, n) for t, n in met.items()], columns=columns)
            met.clear()
            return found

        for b in _some(batches):
            mentioned = []
            for t in b["text"]:
                text = t or ""
                spans = base_spans(text)
                terms = terms_of(text, spans)
                met.update(terms)
                if spans:
                    mentioned.append((sorted({f"{kind}:{e}" for kind, _, _, e in spans}), list(terms), None, 0))
            met[None] += len(b)
            yield pd.DataFrame(mentioned, columns=columns)
            if len(met) > COUNTED_AT_ONCE:
                yield counts()
        yield counts()

    return docs.select(F.col(text_col).alias("text")).mapInPandas(each, "entities array<string>, terms array<string>, term string, docs long")


def disclosing(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, entity, told): pairs whose term tells at least GENERALISE of the entity's information.

    told = PMI(term, entity) / -log p(entity), all counted in whole documents; it is 1 if the term is met with the entity only.
    Entities in fewer than LEAST_DOCS documents have no pair in as many, so their documents are not paired with their terms.
    """
    found = written(counted(docs, text_col), "counted")
    mentioned = found.where("entities IS NOT NULL").select("entities", "terms")
    n = found.where("entities IS NULL AND term IS NULL").agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    entities = mentioned.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    often = written(entities.where(F.col("n_entity") >= LEAST_DOCS), "entities")
    paired = mentioned.select("terms", F.explode("entities").alias("entity")).join(often.select("entity"), "entity", "left_semi")
    pairs = paired.select("entity", F.explode("terms").alias("term")).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both"))
    shared = written(pairs.where(F.col("n_both") >= LEAST_DOCS), "pairs")
    every = found.where("term IS NOT NULL").groupBy("term").agg(F.sum("docs").alias("docs"))
    known = shared.join(every, "term").join(often, "entity")
    # An entity that every document has gives nothing to tell.
    told = F.log(F.col("n_both") * F.lit(n) / (F.col("docs") * F.col("n_entity"))) / -F.log(F.col("n_entity") / F.lit(n))
    return known.where(F.col("n_entity") < n).select("term", "entity", told.alias("told")).where(F.col("told") >= GENERALISE)


def _shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in sorted(spans))


ROWS = "id string, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, terms array<struct<start: int, end: int, told: double>>"


def _row(own, text: str, terms: list[tuple[int, int, float]]) -> tuple:
    base = [(a, KINDS.index(kind), z) for kind, a, z, _ in base_spans(text)]
    counts = [sum(k == kind for _, k, _ in base) for kind in range(4)]
    added = [(a, KINDS.index("term"), z) for a, z, _ in terms]
    digest = hashlib.sha256(_shown(base).encode()).hexdigest()
    return (own, *counts, digest, _shown(base + added), [{"start": a, "end": z, "told": t} for a, z, t in terms])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_sent: int | None = None) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, terms), one row per row of ``docs``.

    spans are kind:start:end in code points, the end exclusive, by start and then kind; terms are (start, end, told) of
    the words that the method adds, with the most that they tell of any entity. Null texts are empty; words inside a mention are
    never terms; null ids are kept; repeated rows count each; an empty table gives no rows.
    """
    telling = written(disclosing(docs, text_col).groupBy("term").agg(F.max("told").alias("told")), "telling")
    rows = ids_and_texts(docs, id_col, text_col)
    columns = [c.split()[0] for c in ROWS.split(", ")[:7]] + ["terms"]
    if telling.count() <= (SENT_TERMS if most_sent is None else most_sent):
        sent = docs.sparkSession.sparkContext.broadcast({r.term: r.told for r in telling.toLocalIterator()})

        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            told = sent.value
            for b in _some(batches):
                out = []
                for own, t in zip(b["id"], b["text"], strict=True):
                    text = t or ""
                    met = told and not told.keys().isdisjoint(w.lower() for w in set(_WORD.findall(text)))
                    words = free_words(text, base_spans(text)) if met else []
                    out.append(_row(own, text, [(a, z, told[w]) for a, z, w in words if w in told]))
                yield pd.DataFrame(out, columns=columns)

        return with_ids(rows.mapInPandas(each, ROWS), docs, id_col, id_col)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row = TaskContext.get().partitionId() << 36
        for b in _some(batches):
            words = [free_words(t or "", base_spans(t)) for t in b["text"]]
            lists = [[{"start": a, "end": z, "term": w} for a, z, w in ws] for ws in words]
            yield pd.DataFrame({"row": range(row, row + len(b)), "id": b["id"], "text": b["text"], "words": lists})
            row += len(b)

    # Written, because rows are numbered as they come.
    words = written(rows.mapInPandas(placed, "row long, id string, text string, words array<struct<start: int, end: int, term: string>>"), "words")
    found = words.select("row", F.explode("words").alias("w")).select("row", "w.*").join(telling, "term")
    lists = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "told"))).alias("terms"))

    def shown(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _some(batches):
            out = []
            for own, t, terms in zip(b["id"], b["text"], b["terms"], strict=True):
                out.append(_row(own, t or "", [(x["start"], x["end"], x["told"]) for x in terms] if terms is not None else []))
            yield pd.DataFrame(out, columns=columns)

    return with_ids(words.select("row", "id", "text").join(lists, "row", "left").mapInPandas(shown, ROWS), docs, id_col, id_col)


def sanitised(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with mentions replaced by their kind, disclosing terms by ``[TERM]``, and the most telling ones removed.

    ``found`` is the result of ``personal_data``; ids have to be unique.
    """

    def clean(text: str | None, spans: str, terms: list) -> str:
        told = {(t["start"], t["end"]): t["told"] for t in terms}
        out, at = [], 0
        for kind, a, z in (s.split(":") for s in spans.split(",") if s):
            a, z = int(a), int(z)
            if a >= at:
                out += [(text or "")[at:a], "" if told.get((a, z), 0) >= REMOVE else f"[{kind.upper()}]"]
            at = max(at, z)
        return "".join(out) + (text or "")[at:]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "text": [clean(*r) for r in zip(b["text"], b["spans"], b["terms"], strict=True)]})

    spans = found.select(F.col(id_col).cast("string").alias("id"), "spans", "terms")
    clean_rows = ids_and_texts(docs, id_col, text_col).join(spans, "id").mapInPandas(each, "id string, text string")
    return with_ids(clean_rows, docs, id_col).toDF(id_col, text_col)
