import random

from geotally.llm import chat

EVENTS = "conv_id long, seq long, kind string, turn long, role string, text string"
MEAN = ["", "<s>", "</s>", "[INST]", "[/INST]", "<*s>", "[**/INST]", "a<s", "s>", "[[INST]", "é\n\n", "</s>[INST] ok [/INST]", "\\", "$1"]


def brute_fold(events):
    convs = {}
    for conv, seq, kind, turn, role, text in sorted(events, key=lambda e: (e[0], e[1])):
        turns = convs.setdefault(conv, {})
        names = convs.setdefault(("role", conv), {})
        if role is not None:
            names[turn] = role
        if kind == "regenerate":
            for t in [t for t in turns if t >= turn]:
                del turns[t]
        elif kind == "delta":
            turns[turn] = turns.get(turn, "") + (text or "")
        else:
            turns[turn] = text or ""
    return {
        (c, t): (convs["role", c].get(t, ""), text) for c, turns in convs.items() if not isinstance(c, tuple) for t, text in turns.items()
    }


def test_fold_equals_replay(spark):
    rng = random.Random(3)
    events = []
    for conv in range(25):
        for seq in range(rng.randint(1, 40)):
            kind = rng.choice(["message", "delta", "delta", "edit", "regenerate"])
            role = rng.choice([None, "user", "assistant"])
            events.append((conv, seq, kind, rng.randint(0, 4), role, rng.choice([None, *MEAN])))
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in chat.final_messages(spark.createDataFrame(events, EVENTS)).collect()}
    assert got == brute_fold(events)


def test_read_back_gives_what_went_in(spark):
    rows = [(k, t, role, text) for k, role in enumerate(["user", "assistant", "<s>x", None]) for t, text in enumerate([*MEAN, None])]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    read = {r.conv_id: r for r in chat.read_back(chat.chats_from_events(chat.events_of_rows(table))).collect()}
    for k, role in enumerate(["user", "assistant", "<s>x", None]):
        assert [tuple(t) for t in read[k].turns] == [(role or "", text) for text in MEAN] + [(role or "", "")]
        assert read[k].learned == ("".join(MEAN) if role == "assistant" else "")
        assert read[k].formatted.count("</s>") == len(MEAN) + 1


def test_ties_repeats_nulls_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, None, "assistant", None)]
    read = {r.conv_id: r for r in chat.read_back(chat.chats_from_events(chat.events_of_rows(spark.createDataFrame(rows, schema)))).collect()}
    assert [t.text for t in read[1].turns] == ["a", "a", "b"]
    assert [tuple(t) for t in read[None].turns] == [("assistant", "")]
    assert chat.chats_from_events(chat.events_of_rows(spark.createDataFrame([], schema))).collect() == []


def test_mask_counts_code_points(spark):
    rows = [(1, 0, "user", "\U0001f600\U0001f600"), (1, 1, "assistant", "\U0001f600 <s>!")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = chat.formatted(chat.final_messages(chat.events_of_rows(table))).first()
    (start, length), = r.loss
    assert r.formatted[start : start + length] == "\U0001f600 <*s>!"


def test_no_python_in_the_plan(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat.read_back(chat.chats_from_events(chat.events_of_rows(rows)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_events_of_one_seq_are_applied_in_order(spark):
    events = [
        (1, 5, "message", 0, "user", "x"), (1, 5, "message", 0, "user", "x"),
        (2, 1, "edit", 0, "user", "b"), (2, 1, "edit", 0, "user", "a"), (2, 2, "delta", 0, None, "!"), (2, 2, "delta", 0, None, "!"),
        (3, 1, "message", 0, "user", "set"), (3, 1, "delta", 0, None, "before"),
        (4, 1, "message", 0, "user", "kept"), (4, 2, "regenerate", 0, None, None), (4, 2, "delta", 0, None, "gone"), (4, 3, "delta", 0, None, "new"),
        (5, 1, "delta", 0, "user", "only"), (5, 1, "regenerate", 0, None, None),
    ]
    got = {r.conv_id: r.text for r in chat.final_messages(spark.createDataFrame(events, EVENTS)).collect()}
    assert got == {1: "x", 2: "b!!", 3: "set", 4: "new"}
