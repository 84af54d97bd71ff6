from __future__ import annotations

import hashlib
import random
import re

from martflow.llm import pii_bootstrap as B
from martflow.llm.queries import QUERIES
from tests.conftest import SF0001, need_testdata

# The base patterns as stated.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return True


def base(text):
    return [(k, m.start(), m.end()) for k, p in STATED.items() for m in re.finditer(p, text or "") if good(k, m.group())]


def check(rows, texts):
    for r in rows:
        spans = base(texts[r.doc_id])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest(), (r, line)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in STATED]
        assert set(line.split(",")) <= set(r.spans.split(",")) or not spans


def test_query_matches_brute_force(spark):
    need_testdata()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    rows = QUERIES["op9_pii_bootstrap"](spark, SF0001).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_base_spans_of_random_and_odd_texts(spark, tmp_path):
    rng = random.Random(8)
    bits = ["4111111111111111", "1.2.3.4", "a@b.c", "+1 (234) 555-1234", "256", "4644348398010899", "001.02.3.255", "_%"]
    texts = {i: "".join(rng.choice("12+ .-()@a%_😀4é\n") if rng.random() < 0.7 else rng.choice(bits)
                        for _ in range(rng.randint(0, 40))) for i in range(1500)}
    texts |= {5000: None, 5001: "1 " * 20000, 5002: "9" * 100000, 5003: "a" * 100000 + "@", 5004: "", 5005: "é" * 9 + "a@b.c"}
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in texts.items()], "doc_id long, text string, email string, row int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    rows = QUERIES["op9_pii_bootstrap"](spark, str(tmp_path)).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"text number {i} customer mail: u{i}@x.example.com end") for i in range(12)]
    rows += [(100 + i, f"other words customer mail: user{i}000x_at_host end") for i in range(3)]
    rows += [(200, "elsewhere 123456 words"), (201, "customer mail: word"), (201, "customer mail: word"), (None, "u1@x.example.com")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in B.personal_data(df).collect()}
    for i in range(3):
        assert [(e.kind, e.value) for e in got[100 + i].extra] == [(0, f"user{i}000x_at_host")]
    assert not got[200].extra and not got[201].extra and not got[1].extra and len(got[None].base) == 1


def test_believed_identifiers_teach_further_contexts(spark):
    ids = [f"id{i}77x{i}" for i in range(24)]
    rows = [(i, f"text {i} customer mail: u{i}@x.example.com end") for i in range(24)]
    rows += [(100 + i, f"note customer mail: {v} end") for i, v in enumerate(ids[:16])]
    rows += [(200 + i, f"then account ref: {v} end") for i, v in enumerate(ids[2:])]  # no seed here
    rows += [(300 + i, f"also ticket owner: {v} end") for i, v in enumerate(ids[16:])]  # nor here, two hops away
    rows += [(400, "also ticket owner: zz9zz9zz end"), (401, "but other place: zz8zz8zz end")]
    got = {r.doc_id: r for r in B.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, v in enumerate(ids[:16]):
        assert [(e.kind, e.value) for e in got[100 + i].extra] == [(0, v)]
    for i, v in enumerate(ids[2:]):
        assert [(e.kind, e.value) for e in got[200 + i].extra] == [(0, v)]
    for i, v in enumerate(ids[16:]):
        assert [(e.kind, e.value) for e in got[300 + i].extra] == [(0, v)]
    assert [(e.kind, e.value) for e in got[400].extra] == [(0, "zz9zz9zz")] and not got[401].extra


def test_secrets_and_long_identifiers(spark):
    long = "k" * 300 + "7" * 400  # identifiers and context words of any length
    word = "w" * 200 + ":"
    rows = [(i, f'word{i} token = "{i:04x}abcdef{i:030x}" end') for i in range(8)]
    rows += [(100 + i, f"pre{i} password=pass{i}word{i} and more") for i in range(3)]
    rows += [(200, f'other token = "{long}" x'), (201, "plain words token = short"), (202, "the token is 12345678ab")]
    rows += [(300 + i, f"then {word} u{i}@x.example.com") for i in range(8)] + [(400, f"then {word} {long}x")]
    rows += [(500 + i, f"vault ref: {i:04x}abcdef{i:030x}") for i in range(8)] + [(600, "vault ref: zz12345zz")]
    rows += [(700, 'TOKEN: "a1b2c3d4e5@x.example.com"'), (701, "password=" + "9" * 50), (702, "x=password=" * 3000 + "a1b2c3d4")]
    got = {r.doc_id: r for r in B.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    for r in got.values():
        assert all(texts[r.doc_id][e.start : e.end] == e.value for e in [*r.base, *r.extra])
    extra = {i: [(B.ALL_KINDS[e.kind], e.value) for e in r.extra] for i, r in got.items() if r.extra}
    for i in range(8):
        assert extra[i] == [("secret", f"{i:04x}abcdef{i:030x}")] == extra[500 + i]
    for i in range(3):
        assert extra[100 + i] == [("secret", f"pass{i}word{i}")]
    assert extra[200] == [("secret", long)] and extra[400] == [("email", long + "x")]
    assert extra[600] == [("secret", "zz12345zz")]  # learned from values that other documents show as secrets
    assert 201 not in extra and 202 not in extra and 700 not in extra and extra[702][-1] == ("secret", "a1b2c3d4")


def test_query_finds_the_secrets_of_the_table(spark):
    need_testdata()
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    planted = {(r.doc_id, m.start(1), m.end(1)) for r in docs
               for m in re.finditer(r'(?:token = "|password=)([0-9a-f]{18,40})', r.text or "")}
    found = {(r.doc_id, *map(int, s.split(":")[1:])) for r in QUERIES["op9_pii_bootstrap"](spark, sf).collect()
             for s in r.spans.split(",") if s.startswith("secret:")}
    assert planted and found == planted


def test_few_or_mixed_seeds_teach_nothing(spark):
    rows = [(i, f"see mail: u{i}@x.example.com") for i in range(2)] + [(9, "see mail: a1b2c3d4")]
    rows += [(20 + i, f"random place: {i}{i}{i}{i}{i}{i}z") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(not r.extra for r in B.personal_data(df).collect())
    assert B.personal_data(df.limit(0)).count() == 0
