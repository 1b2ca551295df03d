"""Conversation repair, fingerprints and runs on small tables with nulls, empty
and long texts, repeated rows, ties, extra columns and no rows, against SQL and
brute force."""

import hashlib
import random
from collections import Counter
from itertools import product

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from aulaframe.llm import conversations, fingerprints, periodic_runs
from aulaframe.llm.common import ship


def _rows(table):
    cols = sorted(table.column_names)
    return Counter(zip(*[table.column(c).to_pylist() for c in cols]))


def _conversations():
    r = random.Random(3)
    texts = ["Yes.", "No", "Why?", " ", "", None, "a. b", "é!", "so\n", "...", "?", "1 2"]
    rows = []
    for conv in range(60):
        roles = r.choice([["user", "assistant"], ["user"], ["assistant", "user"], ["system", "user", "assistant"], ["tool", "user", None, "assistant"]])
        for turn in range(r.randrange(9)):
            rows.append((conv, turn + (turn > 4) * 3, roles[turn % len(roles)], r.choice(texts) or f"t{r.randrange(30)}.", "x", 1))
    # one conversation with a third of all rows, most of them one user's; repeated and null turns and ids
    rows += [(77, None if k % 50 == 0 else k // 2, "user" if k % 7 else "system", r.choice(texts) if k % 5 else f"n{k}", "x", 1) for k in range(150)]
    rows += [(None, k, "user", "same.", None, None) for k in range(6)] + [(88, 1, "assistant", "same", "x", 2)] * 40
    return rows


CONVERSATIONS = "conv_id long, turn long, role string, text string, conv string, n int"


@pytest.mark.parametrize("partitions", [1, 2, 9, 40])
def test_conversation_repair(spark, tmp_path, partitions, monkeypatch):
    ship(spark)
    spark.createDataFrame(_conversations(), CONVERSATIONS).write.parquet(f"{tmp_path}/conversations.parquet")
    want = duckdb.sql(conversations.OP11_SQL.replace("FROM conversations", f"FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")).to_arrow_table()
    plain = conversations.plan_repairs
    monkeypatch.setattr(conversations, "plan_repairs", lambda *a, **k: plain(*a, **k, partitions=partitions))
    got = conversations.op11_conversation_repair(spark, str(tmp_path)).toArrow()
    assert got.num_rows == len({x[0] for x in _conversations()})
    assert _rows(got) == _rows(want)


def test_conversation_repair_tries_all_edits():
    """Every string of edits on short conversations."""
    r = random.Random(5)
    for _ in range(150):
        rows = [(r.choice("suat"), r.random() < 0.2, r.random() < 0.3) for _ in range(r.randrange(5))]
        found = []
        for edits in product("DKR", repeat=len(rows)):
            for gaps in product(range(3), repeat=len(rows) + 1):
                word = "".join("I" * g + e for g, e in zip(gaps, edits)) + "I" * gaps[-1]
                cost, out, at, ok = 0, "", 0, True
                for e in word:
                    if e == "I":
                        cost, out = cost + 3, out + ("a" if out[-1:] == "u" else "u")
                        continue
                    initial, faulty, cut = rows[at]
                    at += 1
                    if e == "D":
                        cost += 4
                        continue
                    new = initial if e == "K" else "a" if out[-1:] == "u" else "u"
                    ok &= not faulty
                    cost, out = cost + 3 * (e == "R") + 3 * cut, out + new
                body = out.removeprefix("s")
                if ok and (not out or body and body == "ua" * (len(body) // 2)):
                    found.append((cost, word))
        way = conversations.Survivors(conversations.START)
        for initial, faulty, cut in rows:
            way.step(conversations._MOVES[initial if initial != "t" else "", faulty, cut])
        assert conversations._best(way.ends()) == min(found), rows


def test_conversation_repair_holds_the_unresolved_part_alone():
    way = conversations.Survivors(conversations.START)
    deepest = 0
    for k in range(5000):
        way.step(conversations._MOVES["ua"[k % 2], k % 9 == 5, k % 11 == 3])
        deepest = max(deepest, len(way.done) and k + 1 - len(way.done))
    assert deepest < 60


def test_no_conversations(spark, tmp_path):
    spark.createDataFrame([], CONVERSATIONS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert conversations.op11_conversation_repair(spark, str(tmp_path)).count() == 0


def test_repaired_rows_are_whole_conversations(spark):
    ship(spark)
    rows = spark.createDataFrame(_conversations(), CONVERSATIONS)
    out = conversations.repaired_rows(rows, conversations.plan_repairs(rows)).collect()
    by = {}
    for r in sorted(out, key=lambda r: (str(r.conv_id), r.place)):
        by.setdefault(r.conv_id, []).append(r)
    for conv, xs in by.items():
        shape = "".join(x.role[0] for x in xs)
        assert [x.place for x in xs] == list(range(len(xs)))
        assert shape.removeprefix("s") == "ua" * (len(shape.removeprefix("s")) // 2), conv


DOCS = "doc_id long, text string, words string, digest string"


def _run_docs():
    r = random.Random(9)
    base = [str(r.randrange(10**6)) for _ in range(3000)]
    long = [str(r.randrange(400)) for _ in range(700)] + base * 5 + base[:1234] + ["end"] * 50  # periods of two sets of tiles
    texts = [None, "", " \t\n", "one", "a " * 5, "a " * 6, "a\tb\n" * 4, "a b " * 3 + "a", " x  y\x0bz\r" * 30 + "x q", " ".join(long), "w " * 9000,
             "É é " * 20, "a a b " * 9 + "a a c " * 9, "u v w x " * 4 + "u v w x y " * 4]
    for _ in range(60):
        words = []
        for _ in range(r.randrange(1, 6)):
            x = [r.choice("abc") for _ in range(r.choice([1, 2, 3, 5, 8, 20]))]
            words += (x * 12)[:int(len(x) * r.uniform(1, 11))]
        texts.append(" ".join(words))
    rows = [(i, t, "x", None) for i, t in enumerate(texts)]
    return rows + [rows[8], (8, "other text", "x", None), (None, "n o " * 8, "x", None), (None, None, None, None)]


def test_periodic_runs(spark, tmp_path):
    ship(spark)
    spark.createDataFrame(_run_docs(), DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic_runs.op13_periodic_runs(spark, str(tmp_path)).toArrow()
    want = duckdb.sql(periodic_runs.OP13_SQL.replace("FROM documents", f"FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")).to_arrow_table()
    assert got.num_rows == len(_run_docs())
    assert _rows(got) == _rows(want)
    assert max(x or 0 for x in got.column("period").to_pylist()) > 2000


def test_tile_runs_by_all_places_and_periods():
    r = random.Random(2)
    for _ in range(120):
        words = []
        for _ in range(r.randrange(1, 9)):
            x = [r.randrange(3) for _ in range(r.choice([1, 1, 2, 3, 4, 7, 8, 15, 16, 17, 40]))]
            words += (x * 30)[:int(len(x) * r.choice([0.5, 2, 5, 9, 25]))]
        want = {}
        for q in range(1, len(words) // 4 + 1):
            i = 0
            while i + q < len(words):
                j = i
                while j + q < len(words) and words[j] == words[j + q]:
                    j += 1
                if j - i + q >= max(6, 4 * q) and j > i:
                    want.setdefault((i, j - i + q), q)
                i = max(j, i + 1)
        found = periodic_runs.tile_runs(np.array(words), np.array([0, len(words)]), [1 << k for k in range(9)]) if words else []
        assert sorted((a, z - a, q) for _, q, a, z in found) == sorted((*k, q) for k, q in want.items())


def test_z_function():
    r = random.Random(4)
    for _ in range(200):
        s = [r.randrange(2) for _ in range(r.randrange(1, 200))] * r.randrange(1, 3)
        want = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert periodic_runs.z_function(s, len(s) - 1) == want


def test_no_documents_have_no_runs(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert periodic_runs.op13_periodic_runs(spark, str(tmp_path)).count() == 0


def _fingerprint_docs():
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(1, 7)))
    para = lambda n: " ".join(word() for _ in range(n))
    texts = [None, "", " \n\t", "é", "one", "two\nlines", "𝄞 é ü", para(5000), "\n".join(para(r.randrange(1, 60)) for _ in range(400))]
    texts += ["\n".join(para(r.randrange(1, 50)) for _ in range(r.randrange(1, 30))) for _ in range(60)]
    texts += ["same paragraph\n" * 50, texts[9]]
    rows = [(i * 7 % 71, t, "x", None) for i, t in enumerate(texts)]
    return rows + [rows[8], rows[8], (rows[8][0], "other", "x", None), (None, "null id", None, None), (None, None, None, None), (-2**63, "first", "x", None), (2**63 - 1, "last", "x", None)]


@pytest.mark.parametrize("partitions", [1, 8])
def test_fingerprints(spark, tmp_path, partitions):
    ship(spark)
    spark.createDataFrame(_fingerprint_docs(), DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = fingerprints.op12_bloom_fingerprints(spark, str(tmp_path)).toArrow()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = duckdb.sql(fingerprints.OP12_SQL.replace("FROM documents", f"FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")).to_arrow_table()
    assert got.num_rows == len(_fingerprint_docs())
    assert _rows(got) == _rows(want)


def test_differences_are_recovered(spark):
    """Few and many differing digests, whether the first sketch holds them or not."""
    r = random.Random(8)
    rows = []
    for n, d in [(0, 0), (0, 3), (5, 0), (100, 1), (100, 5), (100, 12), (100, 90), (2000, 3), (2000, 1500)]:
        both = [r.getrandbits(60) for _ in range(n)]
        a, b = ([r.getrandbits(60) for _ in range(d)] for _ in range(2))
        rows.append((both + a, b + both, a, b))
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>, x array<bigint>, y array<bigint>")
    for row in df.select(fingerprints.difference(F.col("a"), F.col("b")).alias("d"), "x", "y").collect():
        assert sorted(row.d.a) == sorted(row.x) and sorted(row.d.b) == sorted(row.y)


def test_one_and_no_document(spark, tmp_path):
    ship(spark)
    spark.createDataFrame([(3, "abcd", None, None)], DOCS).write.parquet(f"{tmp_path}/1/documents.parquet")
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/0/documents.parquet")
    row, = fingerprints.op12_bloom_fingerprints(spark, f"{tmp_path}/1").collect()
    assert (row.n_chars, row.near_next, row.edited_sha256) == (4, 1.0, hashlib.sha256(b"abab").hexdigest())
    assert fingerprints.op12_bloom_fingerprints(spark, f"{tmp_path}/0").count() == 0
