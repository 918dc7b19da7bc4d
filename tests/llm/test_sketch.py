import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from voxelflow.llm import queries, sketch


def brute_sketch(text, scale=8):
    w = (text or "").encode().lower().split()
    h = {xxhash.xxh64_intdigest(b" ".join(w[i:i + 5]), seed=42) for i in range(max(1, len(w) - 4))} if w else set()
    return sorted(x for x in h if x < 2 ** 64 // scale) or sorted(h)[:1]


def brute(rows):
    """Rows in descending id order, nulls last; equal rows once; ties are checked by the caller."""
    out = []
    for i, (_, text) in enumerate(rows):
        text, nxt = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        new = text[:len(text) - half] + nxt[:half]
        a, e, n = (set(brute_sketch(t)) for t in (text, new, nxt))

        def like(x, y):
            return len(x & y) / min(len(x), len(y)) if x and y else float(x == y)
        out.append((len(text), hashlib.sha256(new.encode()).hexdigest(), like(a, e), like(a, n)))
    return out


def check(df, rows):
    """``rows`` of distinct ids in order."""
    got = {r.doc_id: r for r in df.collect()}
    assert len(got) == len(rows)
    for (i, text), want in zip(rows, brute(rows)):
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) == want
        assert sketch.from_name(r.fingerprint).tolist() == brute_sketch(text)


def test_sketch_and_merge():
    rng = random.Random(1)
    texts = ["", None, " \n", "a", "A b c", "one two three four five", "x " * 300,
             " ".join(rng.choice(["ab", "cd", "é", "Zz"]) + str(rng.randrange(90)) for _ in range(4000))]
    for t in texts:
        assert sketch.sketch(t).tolist() == brute_sketch(t)
    for a in texts:
        for b in texts:
            both = sorted(set(brute_sketch(a, 4)) | set(brute_sketch(b, 4)))
            low = [x for x in both if x < 2 ** 64 // 4] or both[:1]
            assert sketch.merge(sketch.sketch(a, scale=4), sketch.sketch(b, scale=4), 4).tolist() == low


def test_containment_of_unequal_texts():
    rng = random.Random(2)
    whole = [f"w{rng.randrange(9000)}" for _ in range(20_000)]
    part = whole[3000:5000] + [f"v{i}" for i in range(2000)]
    a, b = sketch.sketch(" ".join(whole)), sketch.sketch(" ".join(part))
    assert abs(sketch.likeness(a, b)[0] - 0.5) < 0.06 and sketch.likeness(a, b) == sketch.likeness(b, a)
    assert sketch.likeness(a, sketch.sketch(" ".join(part[:2000])))[0] == 1


@pytest.mark.parametrize("range_bytes", [1 << 23, 2000, 100])
def test_next_document_across_ranges(spark, range_bytes, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "日本", "🙂", "é"]) for _ in range(rng.randrange(40)))) for i in rng.sample(range(-50, 900), 150)]
    rows += [(1000, None), (None, "no id at all here"), (-(1 << 63), "least id"), ((1 << 63) - 1, "largest id " * 400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    monkeypatch.setattr(sketch, "RANGE_BYTES", range_bytes)
    one = sketch.in_turn(docs, lambda t, n, c: ((t, n), n), "text string, following string", range_bytes)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(
        [(i, t or "", order[(k + 1) % len(order)][1] or "") for k, (i, t) in enumerate(order)], key=str)
    if range_bytes == 2000:
        check(sketch.compare_next(docs), order)


def test_odd_rows(spark, odd_docs, no_docs):
    clash = odd_docs.withColumns({c: F.lit(1) for c in ("a", "b", "part", "copy", "key", "size", "hash", "near_next")})
    got = sketch.compare_next(clash).collect()
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    order = sorted(set(rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = dict(zip(order, brute(order)))
    for r in got:
        options = [v for (i, t), v in want.items() if i == r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) in options
    # rows 6, 6 and 7 hold one text: equal fingerprints, and 7's next text equals its own
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[6]) == 2 and by[6][0] == by[6][1] and by[6][0].fingerprint == by[7][0].fingerprint and by[7][0].near_next == 1
    assert sketch.compare_next(no_docs).count() == 0
    one = sketch.compare_next(spark.createDataFrame([(4, "a b c d e f g h")], "doc_id int, text string")).collect()
    assert [(r.doc_id, r.near_next, r.n_chars) for r in one] == [(4, 1.0, 15)]


def test_union_sketches_by_group(spark):
    rng = random.Random(4)
    rows = [(i, f"s{i % 3}", " ".join(f"t{rng.randrange(50)}" for _ in range(rng.choice([0, 3, 6, 200])))) for i in range(60)]
    rows += [(60, "lone", "only one"), (61, "empty", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    sk = sketch.sketches(docs).join(docs.select("doc_id", "source"), "doc_id")
    got = {}
    for r in sketch.merged(sk, "source").collect():
        got.setdefault(r.source, set()).add(r.hash % (1 << 64))
    for s in ("s0", "s1", "s2", "lone", "empty"):
        hashes = set()
        for _, own, t in rows:
            if own == s:
                w = t.encode().split()
                hashes |= {xxhash.xxh64_intdigest(b" ".join(w[i:i + 5]), seed=42) for i in range(max(1, len(w) - 4))} if w else set()
        low = {x for x in hashes if x < 2 ** 61}
        assert got.get(s, set()) == (low or set(sorted(hashes)[:1])), s
    pairs = sk.alias("x").join(sk.alias("y"), F.col("y.doc_id") == F.col("x.doc_id") + 1)
    for r in pairs.select(F.col("x.hashes").alias("p"), F.col("y.hashes").alias("q"), sketch.contained(F.col("x.hashes"), F.col("y.hashes")).alias("c")).collect():
        p, q = (np.sort(np.array(v, np.int64).view(np.uint64)) for v in (r.p, r.q))
        assert r.c == sketch.likeness(p, q)[0]


def test_query(spark):
    got = queries.QUERIES["op11_fingerprint"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    check(got, sorted(map(tuple, docs.collect()), key=lambda r: -r[0]))
