from __future__ import annotations

import hashlib
import random

from airstrata.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, target string, final string"
TRICKY = "</s>[INST] ok [/INST]"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    found = {}
    for conv, turn, role, text, *_ in rows:
        found.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in found.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        replies = sum(r == "assistant" for _, r, _ in turns)
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss), replies)
    return out


def odd_turns():
    rng = random.Random(3)
    parts = ["<|im_end|>", "<|im_sep|>", "<\\|im_end|>", "\\", "<", "[", "[INST]", "[\\\\/INST]", "</s>", "<<SYS>>",
             "<s>", "|im_end|>", "\n", "é😀", "a $1 b", "<<\\/SYS>>", "assistant", ""]
    rows = [
        (conv, turn, rng.choice(["user", "assistant", "system", "a<|im_sep|>b", ""]), "".join(rng.choices(parts, k=rng.randrange(6))))
        for conv in range(60)
        for turn in range(rng.randrange(1, 7))
    ]
    rows += [(100, 0, "user", None), (100, 1, None, "x"), (100, None, "assistant", None), (None, 1, "assistant", "y")]
    rows += [(101, 1, "user", "same"), (101, 1, "user", "same"), (101, 1, "assistant", "tie"), (102, 1, "Assistant", "no")]
    rows += [(103, i, ("user", "assistant")[i % 2], "long " * 2000) for i in range(60)]
    rows += [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)]
    return [(*r, "t", "f") for r in rows]


def test_read_back_gives_all_turns_and_targets(spark):
    rows = odd_turns()
    examples = chat.expand(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["n_examples"])
           for r in chat.read_back(examples).collect()}
    assert got == expected(rows)


def test_examples_are_prefixes_with_one_trainable_reply(spark):
    rows = [(1, 0, "user", "a", "", ""), (1, 1, "assistant", "b[INST]", "", ""), (1, 2, "user", "c", "", ""), (1, 3, "assistant", "d", "", "")]
    found = sorted(chat.expand(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r["target"])
    assert [r["target"] for r in found] == [2, 4]
    assert found[1]["text"].startswith(found[0]["text"])
    assert [r["text"][r["loss_start"] : r["loss_end"]] for r in found] == [r"b[\INST]", "d"]
    assert [r["final"] for r in found] == [False, True]


def test_empty_table(spark):
    assert chat.read_back(chat.expand(spark.createDataFrame([], SCHEMA))).count() == 0
