import hashlib
import re

import pytest

from geotally.llm.pii import base_spans, luhn, personal_data, sanitised
from tests.llm.helpers import ODD_TEXTS, clashing, docs

TEXTS = [
    *ODD_TEXTS,
    "write to a.b+c@mail-x.example.com, or @nobody.com or x@y or a@b.c.",
    "x@y@z.com a@@b.com me@host.org@other.org %%%@q.w é@é.com d.@e.f",
    "at 1.2.3.4 and 256.1.1.1 and 1.2.3.4.5.6.7.8 and 0000255.1.1.01 " + "9" * 5000 + ".1.1.1",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and 4316522678525456 or 411111111111111111111111",
    "call +1 (555) 010-9999 or +49.30.1234567 or +1 or ++123456789 +12345678",
    "4" * 20000 + " " + "a" * 20000 + "@b.com",
]
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(p.strip("0") == "" or (len(p.lstrip("0")) < 4 and int(p) < 256) for p in m.group().split(".")),
                "card": lambda d=digits: 12 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]
            if ok():
                out.append((m.start(), k, m.end(), kind))
    return [f"{kind}:{a}:{z}" for a, _, z, kind in sorted(out)]


@pytest.mark.parametrize("text", [t for t in TEXTS if len(t or "") < 15000])
def test_base_spans_equal_the_patterns(text):
    assert [f"{k}:{a}:{z}" for k, a, z, _ in base_spans(text)] == brute(text)


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_result_of_each_text(spark):
    got = {r.doc_id: r for r in personal_data(clashing(docs(spark, TEXTS))).collect()}
    for k, t in enumerate(TEXTS):
        spans = [f"{kind}:{a}:{z}" for kind, a, z, _ in base_spans(t)]
        assert got[k].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert (got[k].n_email, got[k].n_ip, got[k].n_card, got[k].n_phone) == tuple(sum(s.startswith(kind) for s in spans) for kind in PATTERNS)
        assert [s for s in got[k].spans.split(",") if s and not s.startswith("term")] == spans


def corpus():
    told = ["Agent Kestrel met boss@acme.example today", "we saw Kestrel write boss@acme.example again", "boss@acme.example is Kestrel they say"]
    return [*told, *(f"the weather of day {k} is fine they say today again" for k in range(60)), "Kestrel boss@acme.example"]


def test_terms_that_tell_an_entity(spark):
    texts = corpus()
    got = {r.doc_id: r for r in personal_data(docs(spark, texts)).collect()}
    for k in (0, 1, 2, 63):
        a = texts[k].index("Kestrel")
        assert f"term:{a}:{a + 7}" in got[k].spans.split(",")
    assert all(not got[k].spans for k in range(3, 63))
    # "they" is with the entity too, but says nothing about it.
    assert "term" not in got[2].spans.replace(f"term:{texts[2].index('Kestrel')}", "")


def test_told_information_is_counted_in_documents(spark):
    from math import log

    texts = corpus()
    r = next(r for r in personal_data(docs(spark, texts)).collect() if r.doc_id == 0)
    n, both, term, entity = len(texts), 4, 4, 4
    assert abs(r.terms[0].told - log(both * n / (term * entity)) / -log(entity / n)) < 1e-9


def test_sanitised_text(spark):
    df = docs(spark, corpus())
    got = {r.doc_id: r.text for r in sanitised(df, personal_data(df)).collect()}
    assert got[63] == " [EMAIL]" and got[3] == corpus()[3]


def test_empty_table_and_repeated_rows(spark):
    assert personal_data(docs(spark, [])).collect() == []
    df = spark.createDataFrame([(1, "a@b.co"), (1, "a@b.co"), (None, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.spans) for r in personal_data(df).collect()) == [("1", "email:0:6"), ("1", "email:0:6"), ("None", "")]


def brute_terms(texts):
    from collections import Counter
    from math import log

    def words(text):
        inside = [(a, z) for _, a, z, _ in base_spans(text)]
        return [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W\d_]+", text) if len(m.group()) >= 3 and all(m.end() <= a or m.start() >= z for a, z in inside)]

    n = len(texts)
    terms = [{w for *_, w in words(t or "")} for t in texts]
    entities = [{f"{kind}:{e}" for kind, _, _, e in base_spans(t)} for t in texts]
    of_term, of_entity = Counter(w for ws in terms for w in ws), Counter(e for es in entities for e in es)
    both = Counter((w, e) for ws, es in zip(terms, entities) for w in ws for e in es)
    told = {}
    for (w, e), k in both.items():
        if k >= 3 and of_entity[e] < n:
            x = log(k * n / (of_term[w] * of_entity[e])) / -log(of_entity[e] / n)
            if x >= 0.9 - 1e-12:
                told[w] = max(told.get(w, 0), x)
    return [[(a, z, round(told[w], 9)) for a, z, w in words(t or "") if w in told] for t in texts]


def long_corpus():
    fill = "then there were many words between one thing and another on that day of the year in town"
    near = [f"report {k} {fill} kestrel {fill} sent to boss@acme.example {'seen' if k else ''}" for k in range(3)]
    other = [f"{fill} number {k} of all" for k in range(120)]
    return [*near, "a letter that kestrel wrote, with KESTREL twice", *other, *ODD_TEXTS, "call 10.0.0.1 heron", "ping 10.0.0.1 heron", "10.0.0.1 heron heron"]


@pytest.mark.parametrize("most_sent", [None, 0])
def test_terms_equal_counting_over_whole_documents(spark, most_sent):
    texts = long_corpus()
    want = brute_terms(texts)
    got = {r.doc_id: r for r in personal_data(clashing(docs(spark, texts)), most_sent=most_sent).collect()}
    assert {k: [(t.start, t.end, round(t.told, 9)) for t in r.terms] for k, r in got.items()} == dict(enumerate(want))
    # Far from the mention, and in a document that has none.
    assert [texts[3][a:z] for a, z, _ in want[3]] == ["kestrel", "KESTREL"]
    assert any(texts[0][a:z] == "kestrel" for a, z, _ in want[0])
    base = [f"{kind}:{a}:{z}" for kind, a, z, _ in base_spans(texts[0])]
    assert [s for s in got[0].spans.split(",") if not s.startswith("term")] == base
