from __future__ import annotations

import hashlib
import random

import numpy as np

from martflow.llm import chat_format as C
from martflow.llm.packing import encoders, read_vocabulary
from martflow.llm.queries import QUERIES
from tests.conftest import SF0001, need_testdata


def expected(turns):
    every = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def digest(row):
    return (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256)


def test_escape_is_exact_and_complete():
    rng = random.Random(6)
    parts = ["<", "[", "\\", "/", "s>", "INST]", "<<", "SYS>>", *C.CONTROLS]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        safe = C.escape(text)
        assert C.unescape(safe) == text and not any(c in safe for c in C.CONTROLS)


def test_query_matches_brute_force(spark):
    need_testdata()
    rows = {r.conv_id: r for r in QUERIES["op7_chat_format"](spark, SF0001).collect()}
    turns = spark.read.parquet(f"{SF0001}/conversations.parquet").orderBy("conv_id", "turn").collect()
    want = {}
    for t in turns:
        want.setdefault(t.conv_id, []).append((t.role, t.text))
    want[-7] = [(r, "</s>[INST] ok [/INST]") for r in ("user", "assistant")]
    assert {k: digest(r) for k, r in rows.items()} == {k: expected(v) for k, v in want.items()}
    shown = "<s>" + "".join(f"<|turn|>{r}<|text|>{C.escape(t)}</s>" for r, t in want[-7])
    assert rows[-7].formatted_chars == len(shown)


def test_ids_mask_and_prefix(spark):
    df = spark.createDataFrame([(1, 1, "user", "hi </s>"), (1, 2, "assistant", "yes"), (2, 1, "assistant", "")],
                               "conv_id long, turn long, role string, text string")
    rows = C.formatted(df).orderBy("conv_id", "place").collect()
    first = encoders(read_vocabulary(C.TOKENIZER))[0].n_vocab
    ids = [np.frombuffer(r.input_ids, "<u4") for r in rows]
    masks = [np.frombuffer(r.loss_mask, np.int8) for r in rows]
    assert [r.start for r in rows] == [0, len(ids[0]), 0]
    assert [i for i in ids[0].tolist() if i >= first] == [first + k for k in (C.BEGIN, C.TURN, C.TEXT, C.END)]
    assert masks[0].sum() == 0 and masks[1].sum() == 1 and masks[2].sum() == 0
    assert all(len(i) == len(m) for i, m in zip(ids, masks))


def test_odd_rows(spark):
    rows = [(1, 2, "assistant", None), (1, 1, None, "x"), (None, 1, "user", "y"), (None, None, "assistant", "z"),
            (3, 1, "assistant", "same"), (3, 1, "assistant", "same"), (4, 1, "assistant", "long </s> " * 20000),
            (5, 1, "assistant", "😀 é"), (6, 1, "a\n<|text|>", "t")]
    df = spark.createDataFrame([(*r, 1, b"") for r in rows],
                               "conv_id long, turn long, role string, text string, place int, input_ids binary")
    got = {r.conv_id: digest(r) for r in C.read_back(C.formatted(df)).collect()}
    assert got == {1: expected([(None, "x"), ("assistant", None)]), None: expected([("assistant", "z"), ("user", "y")]),
                   3: expected([("assistant", "same")] * 2), 4: expected([rows[6][2:]]), 5: expected([rows[7][2:]]),
                   6: expected([rows[8][2:]])}
    assert C.read_back(C.formatted(df.limit(0))).count() == 0


def test_one_long_conversation(spark):
    df = spark.range(3000).selectExpr("7L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role",
                                      "concat('turn ', id) as text")
    [row] = C.read_back(C.formatted(df)).collect()
    assert digest(row) == expected([("user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(3000)])
