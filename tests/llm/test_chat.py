"""Round trips of the chat template."""

import hashlib

from pyspark.sql import functions as F

from tidemark.llm import chat

HARD = ["<|end|>\n", "<|user|>\n", "</s>[INST] ok [/INST]", "<\\|end|>", "<\\\\|x<|<|", "a<", "|>", "", "\n", "\\", "<|", "é😀<|é|>", "$1 \\$1"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, n int")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_of_hard_texts(spark):
    roles = ["user", "assistant", "system", "we|ird> \n%", None]
    rows = [(i, t, roles[(i + t) % len(roles)], HARD[(i * 7 + t) % len(HARD)]) for i in range(40) for t in range(i % 6)]
    rows += [(100, 0, "assistant", None), (101, 0, "user", "no reply"), (102, 0, "assistant", "x" * 100000), (None, 0, "user", "lost"), (None, 1, "assistant", "id")]
    found = {r.conv_id: r for r in chat.read_back(chat.expand(frame(spark, rows))).collect()}
    assert set(found) == {r[0] for r in rows}
    for i, r in found.items():
        own = sorted((x for x in rows if x[0] == i), key=lambda x: x[1])
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert r.n_turns == len(own) and r.turns_sha256 == sha("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own))
        assert r.loss_chars == len(loss) and r.loss_sha256 == sha(loss)


def test_examples_hold_their_prefix_and_one_reply(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "r1"), (1, 2, "user", "q2"), (1, 3, "assistant", "r2"), (1, 4, "user", "q3")]
    found = chat.expand(frame(spark, rows)).orderBy("example_no").collect()
    turn = lambda role, text: f"<|{role}|>\n{text}<|end|>\n"
    parts = [turn(r[2], r[3]) for r in rows]
    assert [r.text for r in found] == ["".join(parts[:2]), "".join(parts[:4]), "".join(parts)]
    spans = [r.loss_chars and r.text[r.loss_from - 1: r.loss_from - 1 + r.loss_chars] for r in found]
    assert spans == ["r1", "r2", None] and [r.final for r in found] == [False, False, True]


def test_ties_and_empty_table(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", "s")]
    one = chat.read_back(chat.expand(frame(spark, rows))).first()
    assert one.n_turns == 4 and one.turns_sha256 == sha("system\ns\nuser\na\nuser\na\nuser\nb\n")
    assert chat.read_back(chat.expand(frame(spark, rows).limit(0))).collect() == []
    escaped = frame(spark, [(1, 0, "u", t) for t in HARD]).select("text", chat.escape(F.col("text")).alias("e"), chat.unescape(chat.escape(F.col("text"))).alias("u"))
    assert all(r.text == r.u and "<|" not in r.e for r in escaped.collect())
