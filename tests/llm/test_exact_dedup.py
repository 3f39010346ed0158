import hashlib
import re

from geotally.llm import exact_dedup as module
from geotally.llm.exact_dedup import equal_text_classes, exact_dedup
from tests.llm.helpers import ODD_TEXTS, clashing, docs


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    out = set()
    for norm, members in groups.items():
        keep = min(members)[1]
        out |= {(i, keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for _, i in members}
    return out


def test_equals_brute_force(spark):
    texts = [*ODD_TEXTS, *["hot  copy", "hotcopy", "hot copy   "] * 40, "HOT copy"]
    found = exact_dedup(clashing(docs(spark, texts)))
    assert {tuple(r) for r in found.collect()} == brute(list(enumerate(texts)))


def test_empty_table(spark):
    assert exact_dedup(docs(spark, [])).collect() == []


def test_null_id_stays_last_and_repeated_rows_stay_together(spark):
    df = spark.createDataFrame([(None, "a b"), (7, "ab "), (7, "ab "), (3, "x")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(df).collect()), key=str)
    assert got == sorted([(None, 7, 3, False), (7, 7, 3, True), (7, 7, 3, True), (3, 3, 1, True)], key=str)


def test_plan_sorts_content_over_sampled_ranges(spark):
    plan = equal_text_classes(docs(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "SortAggregate" in plan
    assert "Python" not in plan and "Arrow" not in plan


def test_a_hot_text_is_dealt_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(module, "HOT_ROWS", 20)
    texts = [["hot  text", "hot text ", "hottext"][k % 3] for k in range(400)] + [f"t{k // 2}" for k in range(300)] + ODD_TEXTS
    rows = list(enumerate(texts))
    got = sorted(tuple(r) for r in exact_dedup(docs(spark, texts)).collect())
    assert got == sorted(brute(rows))


def test_texts_are_exchanged_once(spark):
    classes = equal_text_classes(docs(spark, [f"text {k % 50}" for k in range(200)]))
    plan = classes._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert sum("rangepartitioning(head" in line for line in moved) == 1
    # The other exchanges are of hashes, of one total and of digests.
    others = [line for line in moved if "rangepartitioning(head" not in line]
    assert others and all("hashpartitioning(hash" in x or "SinglePartition" in x or "hashpartitioning(text_sha256" in x for x in others)


def test_rows_that_stay_by_text(spark):
    rows = [(None, "a b"), (7, "ab  "), (7, "ab  "), (7, "other"), (3, "x"), (None, "x"), (None, None), (None, ""), (4, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS digest", "2 AS group", "3 AS rank_")
    got = module.one_of_each(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(7, "ab  "), (7, "other"), (3, "x"), (4, " ")], key=str)
    assert module.one_of_each(df.limit(0)).collect() == []
