import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from voxelflow.llm import queries, spelling

LETTERS = "abcdé"


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(rows, least=5):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= least and n >= 3}
    out = {}
    for w, n in words.items():
        own = sorted((-words[v], v) for v in words if near(w, v))
        form = own[0][1] if own and -own[0][0] >= 2 * n else None
        out[w] = (n, len(own), form, words[form] if form else None)
    for w in out:
        r = w
        while out[r][2]:
            r = out[r][2]
        out[w] += (r,)
    return sorted((w, *v) for w, v in out.items())


def rows_of(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect())


@pytest.fixture(scope="module")
def words():
    rng = random.Random(5)
    stem = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(3, 9))) for _ in range(60)]
    out = []
    for doc in range(60):
        text = []
        for _ in range(120):
            w = stem[min(int(rng.expovariate(0.08)), 59)]
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", rng.choice(LETTERS), w[k] + rng.choice(LETTERS)]) + w[k + 1:]
            text.append(w.upper() if rng.random() < 0.2 else w)
        out.append((doc if doc % 9 else None, rng.choice([" ", ", ", "-", "_", "×1"]).join(text)))
    return out


@pytest.mark.parametrize("most_bytes", [1 << 20, 64])
def test_against_brute_force(spark, words, most_bytes):
    docs = spark.createDataFrame(words, "doc_id bigint, text string").repartition(5)
    want = brute(words)
    assert rows_of(spelling.variants(docs, most_bytes=most_bytes)) == want
    assert any(form and root != form for _, _, _, form, _, root in want) and len(want) > 100


def test_oracle_sql(spark, words):
    docs = spark.createDataFrame(words, "doc_id bigint, text string")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    rel = con.sql(queries.ORACLES["op13_spelling"])
    at = [rel.columns.index(c) for c in ("word", "n", "n_near", "form", "form_n", "root")]
    assert sorted(tuple(r[i] for i in at) for r in rel.fetchall()) == brute(words)


def test_odd_and_empty(spark, odd_docs, no_docs):
    clash = odd_docs.withColumns({c: spelling.F.lit("x") for c in ("word", "run", "h", "other", "root", "m", "id")})
    assert rows_of(spelling.variants(clash)) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert spelling.variants(no_docs).count() == 0
    long = "ab" * 30_000
    rows = [(1, f"{long} {long}, {long}"), (2, f"{long[:-1]}c " * 7), (3, "aaaaaa " * 9 + "aaaaa " * 3), (3, "aaaaa")]
    got = rows_of(spelling.variants(spark.createDataFrame(rows, "doc_id bigint, text string"), drop_every=0))
    assert got == sorted([(long, 3, 1, long[:-1] + "c", 7, long[:-1] + "c"), (long[:-1] + "c", 7, 1, None, None, long[:-1] + "c"),
                          ("aaaaa", 4, 1, "aaaaaa", 9, "aaaaaa"), ("aaaaaa", 9, 1, None, None, "aaaaaa")])


def test_filter_has_no_false_negative_and_few_false_positives():
    rng = np.random.default_rng(2)
    h, other = rng.integers(0, 1 << 63, 50_000).astype(np.uint64), rng.integers(0, 1 << 63, 200_000).astype(np.uint64)
    n = spelling.blocks_for(len(h))
    f = spelling.build(h, n)
    # the same from segments
    block = spelling._probes(h, n)[0]
    parts = [spelling.build(h[block // 100 == s], n, s * 100, min(100, n - s * 100)) for s in range(-(-n // 100))]
    assert (np.concatenate(parts) == f).all()
    assert len(spelling.probe(f, h)) == len(h) and len(spelling.probe(f, other)) < 0.02 * len(other)


def test_rounds_stay_within_the_bound(spark):
    words = spark.createDataFrame([("abcdefgh"[:k] + chr(97 + i % 26) * 9 + str(i),) for i in range(3000) for k in (1, 2)], "word string")
    for most in (1 << 20, 2048, 256):
        rounds = spelling.shards(words, most)
        assert all(sum(spelling.blocks_for(n) * 64 for *_, n in r) <= most for r in rounds)
        assert sum(n for r in rounds for *_, n in r) >= 6000
