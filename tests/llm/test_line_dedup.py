import random

from geotally.llm.line_dedup import repeated_units, units, without_repeats
from tests.llm.helpers import ODD_TEXTS, clashing, docs


def brute(texts, least):
    seen, out = {}, set()
    for i, t in enumerate(texts):
        t, at = t or "", 0
        cuts = [k + 1 for k, c in enumerate(t) if c == "\n" or (c == " " and k and t[k - 1] in ".!?")]
        for z in [*cuts, len(t) + 1]:
            words = "".join(c.lower() if "A" <= c <= "Z" else c for c in t[at : z - 1]).split()
            if len(words) >= least:
                first = seen.setdefault(tuple(words), (i, at))
                if first != (i, at):
                    out.add((i, at, z - 1, len(words), *first))
            at = z
    return out


def sample():
    rng = random.Random(2)
    shared = [" ".join(rng.choices("alpha Beta gamma délta eps".split(), k=k)) for k in (3, 8, 9, 20, 60)]
    texts = [*ODD_TEXTS]
    for _ in range(60):
        parts = [rng.choice([*shared, f"own {rng.random()} line with words of its own here now"]) for _ in range(rng.randint(0, 8))]
        texts.append("".join(p + rng.choice(["\n", ". ", "! ", "?\n", " \n"]) for p in parts))
    return texts


def test_equals_brute_force(spark):
    texts = sample()
    got = {tuple(r) for r in repeated_units(clashing(docs(spark, texts))).collect()}
    assert got == brute(texts, 8) and got


def test_original_places_and_what_is_left(spark):
    texts = sample()
    df = docs(spark, texts)
    removed = repeated_units(df)
    left = {r.doc_id: (r.text, r.removed_spans) for r in without_repeats(df, removed).collect()}
    assert len(left) == len(texts)
    for i, t in enumerate(texts):
        text, spans = left[i]
        for a, z in sorted(spans or [], reverse=True):
            t = t[:a] + t[z:]
        assert text == t
    assert not {tuple(w) for t, _ in left.values() for _, _, w in units(t) if len(w) >= 8 and sum(w == v for u, _ in left.values() for _, _, v in units(u)) > 1}


def test_passage_in_many_documents_is_found_and_others_are_left_alone(spark):
    passage = " ".join(f"word{k}" for k in range(55)) + "."
    texts = [f"Intro number {k}.\n{passage}\nOutro {k} of its own." for k in range(30)] + ["clean text number one has nine words in it"]
    got = repeated_units(docs(spark, texts)).collect()
    assert {r.doc_id for r in got} == set(range(1, 30)) and {r.keep_doc_id for r in got} == {0}


def test_empty_table(spark):
    assert repeated_units(docs(spark, [])).collect() == []


def test_cutting_keeps_columns_of_any_name(spark):
    text = "one two three four five six seven eight nine. Else"
    df = docs(spark, [text, text]).selectExpr("*", "'mine' AS _id", "'old' AS removed_spans")
    cut = without_repeats(df, repeated_units(df))
    got = {r.doc_id: (r.text, r._id, r.removed_spans) for r in cut.collect()}
    assert got[0] == (text, "mine", None) and got[1][:2] == (" Else", "mine") and got[1][2]
