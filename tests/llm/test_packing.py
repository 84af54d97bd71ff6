from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
import tiktoken

from martflow.llm import packing as P
from martflow.llm.queries import QUERIES
from tests.conftest import SF0001, need_testdata


def slow_rooms(lengths, size):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        room = min(fits) if fits else size
        if fits:
            rooms.remove(room)
        rooms.append(room - n)
    return sorted(rooms)


def test_best_fit_matches_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        size = rng.randint(1, 40)
        lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 60))]
        rows = P.best_fit_decreasing(lengths, size)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        assert sorted(size - sum(lengths[i] for i in r) for r in rows) == slow_rooms(lengths, size)


def test_fast_pattern_gives_the_same_ids():
    codes = P.encoders(P.read_vocabulary(P.TOKENIZER))
    rng = random.Random(4)
    for _ in range(20000):
        text = "".join(rng.choice(" ab1.'\n\té 　s\u0085\x1c") for _ in range(rng.randint(0, 9)))
        assert P.encode(text, codes) == codes[0].encode_ordinary(text)


def read_back(rows, size):
    got = defaultdict(dict)
    for r in rows:
        ids, where = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(where) == size and r.cu_seqlens[-1] == r.n_tokens <= size
        for doc, first, a, b in zip(r.doc_ids, r.offsets, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            assert where[a:b].tolist() == list(range(b - a))
            assert first not in got[doc]
            got[doc][first] = ids[a:b].tolist()
        assert (ids[r.n_tokens :] == 50256).all() and not where[r.n_tokens :].any()
    out = {}
    for doc, parts in got.items():
        whole = []
        for first in sorted(parts):
            assert first == len(whole)
            whole += parts[first]
        out[doc] = whole
    return out


def test_query_round_trip(spark):
    need_testdata()
    got = read_back(QUERIES["op2_packed_tokens"](spark, SF0001).collect(), P.ROW_TOKENS)
    code = P.encoders(P.read_vocabulary(P.TOKENIZER))[0]
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").collect()
    assert got == {d.doc_id: [*code.encode_ordinary(d.text), 50256] for d in docs}
    assert code.decode(got[docs[0].doc_id][:-1]) == docs[0].text


def test_small_rows_and_batches(spark, tmp_path):
    rows = [(1, None, "x"), (2, "", "x"), (None, "no id here", "x"), (3, "word " * 5000, "x"), (4, "tie", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, input_ids string")
    out = P.packed(df, row_tokens=16, batch_tokens=64).collect()
    got = read_back(out, 16)
    assert set(got) == {1, 2, 3, 4, None} and got[1] == got[2] == [50256]
    code = P.encoders(P.read_vocabulary(P.TOKENIZER))[0]
    assert got[3] == [*code.encode_ordinary("word " * 5000), 50256]
    P.write_packed(df.union(df), str(tmp_path / "packed"), row_tokens=16)
    again = spark.read.parquet(str(tmp_path / "packed"))
    assert sum(r.n_tokens for r in again.collect()) == 2 * sum(map(len, got.values()))
    assert P.packed(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        P.packed(df, row_tokens=0)


def test_tokenizer_is_the_public_one():
    code = P.encoders(P.read_vocabulary(P.TOKENIZER))[0]
    assert isinstance(code, tiktoken.Encoding) and code.n_vocab == 50256
