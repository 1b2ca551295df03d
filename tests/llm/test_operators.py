"""Operators of aulaframe.llm against brute force, on small tables with nulls,
empty and long texts, repeated rows, ties, extra columns and no rows."""

import hashlib
import io
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aulaframe.llm import common, exact_dedup, licenses, lm_scoring, mixing, ngram_join, packing, token_files, topk, toxicity, warc
from aulaframe.llm.common import connected_components, shared_folder, ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, row string"
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _rows():
    r = random.Random(7)
    words = ["ba", "co", "Dé", "fu", "the", "of", "x1", "MIT", "idiot"]
    long = " ".join(r.choice(words) + str(r.randrange(40)) for _ in range(3000))
    mid = [r.choice(words) + str(r.randrange(200)) for _ in range(120)]
    near = mid[:60] + ["changed"] + mid[61:]
    texts = [None, "", " \t\n", "one", "one two", "one two", "One two", long, long, " ".join(mid), " ".join(near),
             "x under the MIT license y\nunder the mit LICENSE", "Released under the MIT License.", "you idiot scum", "naïve Straße <|endoftext|> 'S it's"]
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 3}", None, "s", "r") for i, t in enumerate(texts)]
    return rows + [rows[5], (None, "null id", "en", None, 1, "s", "r")]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.createDataFrame(_rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    ship(spark)
    return spark.createDataFrame([], DOCS)


def _ids(text):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return tok.encode(text or "", add_special_tokens=False).ids


def test_packing(docs, none):
    rows = packing.pack(docs, window=256).collect()
    whole = Counter((d, zlib.crc32(np.array(_ids(t) + [1], "<u4").tobytes())) for d, t, *_ in _rows() if len(_ids(t)) < 256)
    assert Counter((r.doc_id, r.ids_crc32) for r in rows if r.length == r.doc_tokens and r.start == 0 and r.length < 256) == whole
    assert sum(r.length for r in rows) == sum(len(_ids(t)) + 1 for _, t, *_ in _rows())
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(none).count() == 0


def test_best_fit_is_best_fit_decreasing():
    r = random.Random(1)
    for _ in range(20):
        sizes = sorted((r.randint(1, 40) for _ in range(r.randint(0, 60))), reverse=True)
        rooms = []
        for s in sizes:
            fit = min((x for x in rooms if x >= s), default=None)
            if fit is None:
                rooms.append(40 - s)
            else:
                rooms[rooms.index(fit)] = fit - s
        used = Counter()
        for length, _, n, first, offset in packing.best_fit(Counter(sizes), 40):
            for w in range(first, first + n):
                assert used[w] == offset
                used[w] += length
        assert sorted(40 - u for u in used.values()) == sorted(rooms)


def test_mixing(docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(_rows())
    total = sum(len((t or "").encode().split()) for _, t, *_ in _rows())
    assert sum({(r.source_size, r.target) for r in rows} and [r.size for r in rows]) == total
    targets = {}
    for r, (_, _, _, source, *_) in zip(sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0)), sorted(_rows(), key=lambda x: (x[0] is None, x[0] or 0))):
        targets[source] = (r.source_size, r.target)
    assert math.isclose(sum(t for _, t in targets.values()), 1.5 * total)
    assert all(t <= 2 * s + 1e-9 for s, t in targets.values())
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter((r.doc_id, r.taken) for r in rows) == Counter((r.doc_id, r.taken) for r in again)
    assert mixing.mix(none).count() == 0


def _brute_components(rows, n, percent):
    """Per (doc_id, set size) the smallest known id reachable, by all pairs."""
    sets = []
    for d, t in rows:
        w = (t or "").encode().translate(_LOWER).split()
        sets.append((d, frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()))
    root = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root[i], root[j]
                root = [min(x, y) if z in (x, y) else z for z in root]
    out = {}
    for i, (d, s) in enumerate(sets):
        ids = [sets[j][0] for j in range(len(sets)) if root[j] == root[i] and sets[j][0] is not None]
        out[d, len(s)] = min(ids) if ids else None
    return out


def test_ngram_join(docs, none):
    rows = ngram_join.jaccard_components(docs).collect()
    assert len(rows) == len(_rows())
    assert {(r.doc_id, r.n_shingles): r.component_id for r in rows} == _brute_components([x[:2] for x in _rows()], 3, 90)
    assert ngram_join.jaccard_components(none).count() == 0


def test_ngram_join_of_clusters_of_many_blocks(spark, monkeypatch):
    """Small blocks: pivots, and the round of what didn't join the largest group."""
    ship(spark)
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 4)
    r = random.Random(11)
    rows = []
    for family in range(3):
        base = [f"w{family}x{k}" for k in range(150)]
        for _ in range(40):
            words = list(base)
            for k in r.sample(range(150), r.choice([1, 2, 2, 3, 4, 5, 6])):
                words[k] = f"z{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    r.shuffle(rows)
    want = _brute_components(rows, 3, 90)
    assert 3 < len(set(want.values())) < len(rows)
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(x.doc_id, x.n_shingles): x.component_id for x in got} == want


def test_signatures_meet_for_linked_sets():
    r = np.random.default_rng(3)
    for frequent in (0, 10**6):
        counters = np.zeros(ngram_join.COUNTERS, np.int64)
        counters[: ngram_join.COUNTERS // 2 if frequent else 0] = frequent
        sig = ngram_join.Signatures(counters, 90)
        for n in (1, 2, 9, 15, 16, 31, 63, 64, 127, 128, 300, 1000):
            for _ in range(10):
                a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
                m = r.integers(0, max(1, n // 10) + 1)
                b = np.unique(np.concatenate([a[: len(a) - m], r.integers(0, 1 << 63, m // 2, dtype=np.uint64)]))
                both = len(np.intersect1d(a, b))
                if 100 * both >= 90 * (len(a) + len(b) - both) and len(b):
                    assert len(np.intersect1d(sig.of(a), sig.of(b)))


@pytest.mark.parametrize("rows", [5, 200_000])
def test_connected_components(spark, monkeypatch, rows):
    monkeypatch.setattr(common, "ROWS_A_PARTITION", rows)
    ship(spark)
    r = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)]
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == root


@pytest.mark.parametrize("keep", ["max", "min"])
def test_exact_dedup(docs, none, keep):
    rows = exact_dedup.exact_groups(docs, keep=keep, partitions=6).collect()
    groups = {}
    for d, t, *_ in _rows():
        groups.setdefault(t or "", []).append(d)
    want = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        stays = (max if keep == "max" else min)(known) if known else None
        want.update((d, stays, len(ids), hashlib.sha256(t.encode()).hexdigest()) for d in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == want
    assert Counter(r.text_sha256 for r in rows if r.kept) == Counter(hashlib.sha256(t.encode()).hexdigest() for t in groups)
    assert exact_dedup.exact_groups(none).count() == 0


def test_warc(spark):
    ship(spark)
    html = ["a" * 300_000, "short", None, "b" * 99, "b" * 99, "c" * 100, "c" * 100, "c" * 100, "é\r\n\r\n" * 50]
    pages = spark.createDataFrame([(i, None if i == 3 else f"http://x/{i}", h, "z") for i, h in enumerate(html)] + [(None, "u", "c" * 100, "z")],
                                  "page_id long, url string, html string, digest string")
    folder = shared_folder(spark, "warc-test")
    rows = warc.read_warc(spark, folder, warc.write_warc(pages, folder)).collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == 10 and got[None].record_type == "response"
    for i, h in enumerate(html):
        first = html.index(h)
        if i != first and len((h or "").encode()) >= 100:
            assert (got[i].record_type, got[i].refers_to, got[i].payload) == ("revisit", first, None)
        else:
            assert (got[i].record_type, got[i].refers_to, bytes(got[i].payload)) == ("response", None, (h or "").encode())
        assert got[i].payload_digest == hashlib.sha256((h or "").encode()).hexdigest()


def test_chunked_framing_and_segments():
    for n in (0, 1, 16, 17, 1000):
        data = bytes(range(256)) * 4
        assert warc.dechunked(warc.chunked(data[:n], 16)) == data[:n]
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc\r\n0\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.parse_warc(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")))


def test_lm_scores(docs, none):
    rows = lm_scoring.lm_scores(docs).collect()
    counts = Counter()
    tokens = [((d, t), (t or "").encode().translate(_LOWER).split() + [b""]) for d, t, *_ in _rows()]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    for (d, _), w in tokens:
        if not held(d):
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(d), len(w), sum(counts[x] > 0 for x in w), round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)) for (d, _), w in tokens)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == want
    assert {r.train_tokens for r in rows} == {n} and all(r.held_out == held(r.doc_id) and r.score < 0 for r in rows)
    assert lm_scoring.lm_scores(none).count() == 0


def test_class_probabilities_sum_to_one():
    w = np.random.default_rng(0).normal(size=(lm_scoring.FEATURES, lm_scoring.CLASSES)).astype(np.float32)
    p = np.exp(lm_scoring.log_softmax(w, np.arange(50)))
    assert np.allclose(p.sum(1), 1, atol=1e-4)


def test_token_files(spark, docs, none):
    folder = shared_folder(spark, "tokens-test")
    manifest = token_files.write_token_files(docs, folder, shards=3)
    rows = token_files.read_token_files(manifest, folder).orderBy("start").collect()
    order = sorted(_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in rows] == [r[0] for r in order]
    at = 0
    for r, (_, t, *_) in zip(rows, order):
        assert r.ids == _ids(t) + [2] and r.start == at
        at += r.n_tokens
    empty = shared_folder(spark, "tokens-none")
    assert token_files.read_token_files(token_files.write_token_files(none, empty), empty).count() == 0


def test_top_k(spark):
    ship(spark)
    r = random.Random(2)
    vectors = [[r.choice([-0.5, 0.25, 0.5, 1.0]) for _ in range(4)] for _ in range(60)]
    rows = [(i, v, "q") for i, v in enumerate(vectors)] + [(100, None, "q"), (120, [1.0, None, 0.0, 0.0], "q"), (140, [float("nan")] * 4, "q"), (60, [1.0], "q")]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string"), lambda i: i % 20 == 0, k=7, pivots=5).collect()
    ok = {i: [math.floor(64 * x) for x in v] for i, v, _ in rows[:60]} | {60: [64]}
    for q in (0, 20, 40, 60):
        want = sorted((-sum(a * b for a, b in zip(ok[q], c)), i) for i, c in ok.items() if i != q)[:7]
        assert [(x.rank, x.vec_id, x.score) for x in sorted((x for x in got if x.query_id == q), key=lambda x: x.rank)] == [(k + 1, i, -s) for k, (s, i) in enumerate(want)]
    assert {x.query_id for x in got} == {0, 20, 40, 60}


@pytest.mark.parametrize("start", [2**53 - 40, 2**62, -2**62])
def test_top_k_of_large_ids(spark, start):
    ship(spark)
    r = random.Random(5)
    ids = [start + i for i in range(60)] + [None]
    vectors = [[r.choice([-0.5, 0.5]) for _ in range(3)] for _ in ids]
    rows = spark.createDataFrame(list(zip(ids, vectors)), "vec_id long, embedding array<float>")
    got = topk.top_k(rows, lambda i: i % 20 == 0, k=25, pivots=5).collect()
    floored = [[math.floor(64 * x) for x in v] for v in vectors]
    queries = [i for i in ids[:-1] if i % 20 == 0]
    for q in queries:
        want = sorted((-sum(a * b for a, b in zip(floored[ids.index(q)], v)), i is None, i or 0) for i, v in zip(ids, floored) if i != q)[:25]
        mine = sorted((x for x in got if x.query_id == q), key=lambda x: x.rank)
        assert [(x.vec_id, x.score) for x in mine] == [(None if n else i, -s) for s, n, i in want]
    assert queries and {x.query_id for x in got} == set(queries)


@pytest.mark.parametrize("size", [1.0, 1e6, 1e9, 1e30])
def test_top_k_of_rows_that_repeat_ids_and_of_large_components(spark, size):
    ship(spark)
    r = random.Random(7)
    rows = [(i % 50, [r.choice([-0.5, 0.25, 1.0, 3.1]) * size for _ in range(3)]) for i in range(70)]
    rows += [rows[0], rows[20], rows[21], (20, [size, 0.0, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 20 == 0, k=9, pivots=5).collect()
    ints = [[math.floor(64 * x) for x in v] for _, v in rows]
    long = 2 ** 63 - 1
    dot = lambda a, b: max(-long, min(long, sum(x * y for x, y in zip(a, b))))
    want = []
    for n, (q, _) in enumerate(rows):
        if q % 20 == 0:  # each row is a query, and only it isn't its own candidate
            best = sorted((-dot(ints[n], c), i) for m, ((i, _), c) in enumerate(zip(rows, ints)) if m != n)[:9]
            want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_toxicity(spark, docs, none):
    r = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    text = lambda bad: " ".join(r.choice(words) for _ in range(40)) + (" idiot scum" if bad else "")
    train = [(i, text(i % 4 == 0), None, None, None, None, None) for i in range(1000, 1600)]
    marks = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, *_ in train] + [(5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    both = docs.union(spark.createDataFrame(train, DOCS))
    rows = toxicity.score(both, toxicity.fit(both, marks)).collect()
    assert len(rows) == len(_rows()) + len(train) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in rows)
    held = [x for x in rows if x.held_out and x.doc_id >= 1000]
    assert sum((x.doc_id % 4 == 0) == bool(x.predicted) for x in held) >= 0.95 * len(held)
    assert {x.score for x in toxicity.score(docs, toxicity.fit(docs, marks.limit(0))).collect()} == {0.0}
    assert toxicity.score(none, None).count() == 0


def test_licenses(docs, none):
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert (got[11].n_base, got[11].first_word, got[11].last_word, got[11].labels) == (2, 1, 6, "mit")
    assert (got[12].base_labels, got[12].labels, got[12].score) == ("mit", "mit", 1.0)
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].labels, got[0].score) == (0, 0, None, "", 0.0)
    assert licenses.scan(docs).count() == len(_rows()) and licenses.scan(none).count() == 0


def test_text_filter_lets_every_wanted_text_through(spark):
    edges = [0, 1, 32767, 32768, 32769, ngram_join.FILTER_BITS - 1]
    wanted = spark.range(3000).select(F.xxhash64("id").alias("th")).union(spark.createDataFrame([(x,) for x in edges], "th long"))
    has = ngram_join._wanted(wanted)
    assert wanted.filter(~has("th")).count() == 0
    assert spark.range(10_000, 110_000).select(F.xxhash64("id").alias("th")).filter(has("th")).count() < 50
    assert spark.createDataFrame([(2,), (32766,), (32770,)], "th long").filter(has("th")).count() == 0
    assert wanted.filter(ngram_join._wanted(wanted.limit(0))("th")).count() == 0


def test_license_blocks_tell_similar_statements_apart(spark, tmp_path):
    import duckdb

    bsd = "Redistribution and use in source and binary forms, with or without\n   modification, are permitted provided that"
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy"
    work = "This work is licensed under the GNU {}General Public License version {}."
    texts = {"Released under the Apache License.": "", "Licensed under CC BY 4.0.": "cc-by", "licensed under cc-by-nc 4.0": "cc-by-nc",
             work.format("", 2): "gpl-2", work.format("", 3): "gpl-3", work.format("Lesser ", 3): "", bsd: "bsd", mpl: "mpl-2",
             "x " * 5000 + bsd.replace(" ", "\n"): "bsd", "mit " * 3000 + "released under the": "mit", "mit " + "y " * 9 + "released under the license": ""}
    r = random.Random(5)
    words = sorted({w for _, t, *_ in licenses.TEMPLATES for w in t.split()}) + ["nc", "lesser", "zz"]
    rows = list(texts)
    for _, t, *_ in licenses.TEMPLATES * 6:  # statements with words dropped, changed and put in
        w = t.split()
        for _ in range(r.randrange(5)):
            w[r.randrange(len(w))] = r.choice([r.choice(words), "", "zz zz"])
        rows.append(" ".join(r.choices(words, k=r.randrange(9)) + w + r.choices(words, k=r.randrange(9))))
    ship(spark)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {x.doc_id: x for x in licenses.scan(docs).collect()}
    assert {t: got[i].labels for i, t in enumerate(texts)} == texts
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = con.execute(licenses.OP10_SQL).fetchall()
    assert len(want) == len(rows) and [tuple(got[x[0]]) for x in want] == want


def test_tables_of_nodes_are_never_broadcast(spark):
    ship(spark)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*words[i % 7:200 + i % 7], f"x{i % 20}"])) for i in range(60)]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.component_id for r in got.collect()} == {0}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
