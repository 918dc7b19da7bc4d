import random

import numpy as np
import xxhash

from voxelflow.llm import simhash


def brute_fp(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, radius=3):
    p = list(range(len(fps)))

    def find(a):
        while p[a] != a:
            a = p[a]
        return a
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                p[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(fps))]


def test_fingerprint():
    for t in ["", None, "A b", "one two three", "ONE two\tthree four\x0bfive " * 40, "é É ß"]:
        assert simhash.fingerprint(t) == brute_fp(t)


def linked(fps, radius=3):
    fps = np.unique(np.array(fps, np.uint64))
    p = {int(f): int(f) for f in fps}

    def find(a):
        while p[a] != a:
            a = p[a]
        return a
    for m in simhash.key_masks(radius):
        key = fps & np.uint64(m)
        order = np.argsort(key, kind="stable")
        own = fps[order]
        for a, b in simhash.link_groups(key[order], own, radius):
            for x, y in zip(own[a], own[b]):
                p[find(int(x))] = find(int(y))
    return {f: find(f) for f in p}


def test_bit_sliced_links_small_large_and_split_groups(monkeypatch):
    rng = random.Random(7)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(500):
        f = rng.choice(fps)
        for _ in range(rng.randrange(1, 5)):
            f ^= 1 << rng.randrange(64)
        fps.append(f)
    base = rng.getrandbits(64)
    fps += [base ^ (i << 3) for i in range(150)]        # one crowded group
    fps = sorted(set(fps))
    want = brute_components(fps, fps)
    for split in (8192, 70):
        monkeypatch.setattr(simhash, "SPLIT", split)
        got = linked(fps)
        by_want, by_got = {}, {}
        for f, w in zip(fps, want):
            by_want.setdefault(w, set()).add(f)
            by_got.setdefault(got[f], set()).add(f)
        assert sorted(map(sorted, by_want.values())) == sorted(map(sorted, by_got.values()))


def test_rows(spark, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    fps = [brute_fp(r.text) for r in rows]
    comp = brute_components(fps, [r.doc_id for r in rows])
    got = simhash.digest(simhash.near_duplicates(odd_docs)).collect()
    assert sorted(map(str, ((r.doc_id, r.fingerprint, r.component_id) for r in got))) == \
        sorted(map(str, ((r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, comp))))
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_row_of_each_component_stays(spark, odd_docs, no_docs):
    """Repeated ids, null ids, exact copies and equal rows: no text that has no copy goes."""
    a, b, c = ("alpha beta gamma delta epsilon " * 9, "one two three four five six " * 9, "red green blue black white " * 9)
    rows = [(1, a, "x"), (1, b, "x"), (5, b, "x"), (None, c, "x"), (None, c, "x"), (None, a, "y"), (7, c, None), (None, None, "z"),
            (None, "q r s", "z"), (None, "q r s", "w")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumns(
        {k: __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1) for k in ("_row", "row", "a", "b", "n", "stays")})
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(1, a), (1, b), (7, c), (None, None), (None, "q r s")], key=str)
    for df in (odd_docs, no_docs):
        rows = df.select("doc_id", "text").collect()
        fps = [brute_fp(r.text) for r in rows]
        comp = brute_components(fps, list(range(len(rows))))
        kept = simhash.representatives(df)
        assert kept.columns == df.columns
        left = kept.select("doc_id", "text").collect()
        assert len(left) == len(set(comp))
        assert {comp[i] for i, r in enumerate(rows) if (r.doc_id, r.text) in {(k.doc_id, k.text) for k in left}} == set(comp)


def test_hot_keys_are_dealt_again(spark):
    """Keys over ``split`` members, over many small batches: the components stay those of all pairs."""
    rng = random.Random(11)
    base = rng.getrandbits(64)
    fps = {base ^ (i << 20) for i in range(120)} | {base ^ rng.getrandbits(12) for _ in range(120)}     # two crowds
    for f in [rng.getrandbits(64) for _ in range(40)]:
        fps |= {f, f ^ 1 << rng.randrange(64), f ^ 3 << rng.randrange(62)}
    fps = sorted(fps)
    want = brute_components(fps, fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(size)
    try:
        for split, batch in ((10, 7), (10, 10_000), (50, 3), (10 ** 6, 7)):
            spark.conf.set(size, str(batch))
            p = {f: f for f in fps}

            def find(a):
                while p[a] != a:
                    a = p[a]
                return a
            for a, b in simhash.link_forest(df, 3, split).collect():
                a, b = find(a % (1 << 64)), find(b % (1 << 64))
                p[max(a, b)] = min(a, b)
            assert [find(f) for f in fps] == want, (split, batch)
    finally:
        spark.conf.set(size, old)


def test_put_off_groups_hold_no_more_than_split_and_a_batch():
    import pyarrow as pa

    def batches():
        for lo in range(0, 1000, 10):
            k = [0 if i < 5 else 1 if i < 905 else 2 for i in range(lo, lo + 10)]
            yield pa.RecordBatch.from_pydict({"k": k, "v": [7] * 10, "fp": list(range(lo, lo + 10))})
    out = [b.to_pydict() for b in simhash._linked(batches(), ["k", "v"], 3, 100)]
    late = [(f, k) for b in out for f, k in zip(b["a"], b["k"]) if k is not None]
    assert sorted(late) == [(i, 1) for i in range(5, 905)]
    assert max(len(b["a"]) for b in out) <= 110
    linked = {f for b in out for f, k in zip(b["a"], b["k"]) if k is None}
    assert linked and linked <= set(range(5)) | set(range(905, 1000))
