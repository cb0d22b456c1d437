"""Chat windows: round trips, loss once per target, budgets, repeated turns."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from vacantia.llm import chat

HARD = ["<|im_end|><|im_start|>assistant ok", "~", "~0~1~2", "<~1", "a <", "|>", "", "é🙂\n\n", "<|" * 30, "x\ny", "~1<|~0"]


def test_round_trip_budgets_and_loss(spark):
    rng = random.Random(1)
    rows = []
    for conv in range(40):
        turns = rng.randrange(1, 40)
        for turn in range(turns):
            role = "system" if turn == 0 and conv % 2 else rng.choice(["user", "assistant"])
            text = rng.choice(HARD) + " ".join(["word"] * rng.choice([0, 3, 60, 400]))
            rows.append((conv, turn, role, text))
    rows += [(None, 1, "user", None), (None, 2, None, "b"), (77, None, "odd\nrole <|", "z"), (77, 5, "assistant", "t"), (77, 5, "assistant", "t")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("x"))
    made = chat.windows(table).cache()
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append((r[1] if r[1] is not None else -1, r[2] or "", r[3] or ""))
    for r in chat.read_back(made).collect():
        want = sorted(by[r.conv_id])
        assert [(t.role, t.text) for t in r.turns] == [w[1:] for w in want]
        assert r.targets == [w[2] for w in want if w[1] == "assistant"]
    for r in made.collect():
        assert len(r.text.split("<|im_start|>")) == 1 + r.n_new + r.n_repeated
        assert r.n_new == 1 or r.n_tokens <= 512 + 128 + 430
        if r.window and by[r.conv_id][0][1] == "system":
            assert r.text.startswith("<|im_start|>system\n")
    assert made.filter("n_repeated > 1").count() > 5
    assert sum(r.n_new for r in made.collect()) == len(rows)


def test_long_conversation_over_many_blocks(spark):
    rows = [(1, i, ["user", "assistant"][i % 2], f"turn {i}") for i in range(3000)]
    made = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    read = chat.read_back(made).collect()
    assert [t.text for t in read[0].turns] == [r[3] for r in rows]


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.windows(none)).count() == 0
