"""Trained models and their verdicts against plain sequential versions."""

import math
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P

from voxelflow.llm import langid, licenses, quality, secret_scan, toxicity

# ------------------------------------------------------------------- secrets (2)


def markov(pairs_of):
    """Log ratio per pair of characters from labelled tokens, add-half smoothed per row."""
    ab = secret_scan.ALPHABET
    n = [{(a, b): 0.5 for a in ab for b in ab} for _ in range(2)]
    for label, token in pairs_of:
        for a, b in zip(token, token[1:]):
            if (a, b) in n[label]:
                n[label][a, b] += 1
    sums = [{a: sum(c[a, b] for b in ab) for a in ab} for c in n]
    return {(a, b): math.log(n[1][a, b] / sums[1][a]) - math.log(n[0][a, b] / sums[0][a]) for a in ab for b in ab}


def test_markov_models_and_spans_equal_brute_force(spark):
    rng = random.Random(8)
    words = ["configuration", "identifier", "the", "connection", "python3", "utf-8", "result2", "camelCaseName"]
    secret = lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    rows = [(i, " ".join(rng.choice(words) for _ in range(30)) + f" token={secret(24)} end") for i in range(120)]
    planted = {1000 + n: secret(n) for n in (8, 10, 13, 16, 19, 30)}
    rows += [(i, f"see ({s}) and kX9 here") for i, s in planted.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = secret_scan.train(docs.filter("doc_id < 1000"))
    tokens = []
    for _, x in rows[:120]:
        base = [m for m in re.finditer(r"token=([A-Za-z0-9+/_.=-]+)", x)]
        tokens += [(1, m[1]) for m in base]
        tokens += [(0, m[0]) for m in re.finditer(r"[A-Za-z0-9+/_=-]{6,}", x)
                   if not any(b.start() < m.end() and b.end() > m.start() for b in base)]
    want = markov(tokens)
    side, ab = secret_scan.SIDE, secret_scan.ALPHABET
    for a in ab:
        for b in ab:
            assert abs(model[(ab.index(a) + 1) * side + ab.index(b) + 1] - want[a, b]) < 1e-9
    got = {r.doc_id: r.spans for r in secret_scan.digest(secret_scan.find(docs, model)).collect()}
    run = "[A-Za-z0-9+/_=-]"
    for i, x in rows:
        if i < 1000:
            assert "random" not in got[i]
            continue
        named = []
        for m in re.finditer(f"(?<!{run}){run}{{6,}}", x):
            t = m[0]
            mixed = re.search("[0-9]", t) and re.search("[A-Za-z]", t) or re.search("[a-z][A-Z]+[a-z]+[A-Z]", t)
            total = sum(want[p] for p in zip(t, t[1:]))
            if (mixed or len(t) >= 20) and (total >= 16 or len(t) >= 20 and total >= 0.75 * (len(t) - 1)):
                named.append(f"random:{m.start()}:{m.end()}")
        assert got[i] == ",".join(named)
    assert sum("random:5:" in got[i] for i in planted) >= 4


# ------------------------------------------------------------------- language (6)

def test_letters_and_marks():
    find = langid.WORD.findall
    assert find("½ ² ① Ⅷ ³ 12 _ --") == [] and find("हिन्दी") == ["हिन्दी"] and find("été a1b") == ["été", "a", "b"]


def test_texts_without_letters_are_undetermined(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([("the and of that", "aa"), ("der und nicht", "bb")] * 20)]
    rows += [(900, "½ ² ①", None), (901, "Ⅷ ³", None), (902, "हिन्दी", None), (903, "٣ ४", None)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict_all(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert got[900] == got[901] == got[903] == ("und", 0.0) and got[902][0] in ("aa", "bb")


def test_word_scores_equal_counted_ngrams(spark):
    rng = random.Random(4)
    lex = {"aa": ["the", "andy", "of", "été"], "bb": ["der", "und", "nicht", "это"]}
    rows = [(i, " ".join(rng.choice(lex[g]) for _ in range(12)), g) for i, g in enumerate(["aa", "bb"] * 30)]
    m = langid.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))

    def cells(w):
        c, out = [ord(x) for x in f"<{w}>"], []
        for n in (1, 2, 3):
            for i in range(len(c) - n + 1):
                h = c[i]
                for x in c[i + 1:i + n]:
                    h = (h * 0x100000001B3 + x) % (1 << 64)
                out.append((h + n) * 0x9E3779B97F4A7C15 % (1 << 64) >> 48)
        return out + [zlib.crc32(w.encode()) & 0xFFFF]
    count = {g: Counter(k for _, t, lang in rows if lang == g for w in t.split() for k in cells(w)) for g in lex}
    total = {g: sum(c.values()) + 0.1 * langid.CELLS for g, c in count.items()}
    words = ["the", "nicht", "andy", "unseen", "été"]
    s = langid.Scorer(m)
    got = s.rows[s.words(words)]
    for w, r in zip(words, got):
        want = np.array([sum(math.log((count[g][k] + 0.1) / total[g]) for k in cells(w)) for g in ("aa", "bb")])
        assert np.allclose(r, want - want.max(), atol=1e-3)


# ------------------------------------------------------------------- toxicity (10)

def test_ftrl_equals_a_sequential_version(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["a", "b", "cc", "dd", "vile", "x1"]) for _ in range(rng.randrange(0, 9)))) for i in range(80)]
    labels = [(i, int("vile" in t and rng.random() < 0.9)) for i, t in rows[:60]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(
        docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), rounds=2, shards=3, epochs=2)).collect()}
    shard = {r[0]: r[1] for r in docs.selectExpr("doc_id", "cast(pmod(xxhash64(doc_id, 1), 3) as int)").collect()}

    def features(t):
        w = t.split()
        h = [zlib.crc32(x.encode()) for x in w]
        keys = h + [a * 1_000_003 + b + 1 for a, b in zip(h, h[1:])] + [a * 1_000_033 + b + 2 for a, b in zip(h, h[2:])]
        out = set()
        for k in keys:
            x = k * 0x9E3779B97F4A7C15 % (1 << 64)
            out.add(((x ^ x >> 31) * 0xD6E8FEB86659FD93 % (1 << 64)) >> 46)
        return out | {"bias"}

    def weight(z, n, k):
        l1 = 0.0 if k == "bias" else 4.0
        v = z.get(k, 0.0)
        return 0.0 if abs(v) <= l1 else -(v - math.copysign(l1, v)) / (1.0 + math.sqrt(n.get(k, 0.0)) + 0.1)

    def sigmoid(x):
        return 1 / (1 + math.exp(-x))
    z, n = {}, {}
    for _ in range(2):
        sums: dict = {}
        for s in range(3):
            zs, ns = dict(z), dict(n)
            own = [(i, features(rows[i][1]), y) for i, y in labels if shard[i] == s]
            for e in range(2):
                for i, f, y in sorted(own, key=lambda r: zlib.crc32(f"{e} {r[0]}".encode())):
                    w = {k: weight(zs, ns, k) for k in f}
                    g = sigmoid(sum(w.values())) - y
                    for k in f:
                        old = ns.get(k, 0.0)
                        zs[k] = zs.get(k, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) * w[k]
                        ns[k] = old + g * g
            for k in ns:
                if ns[k]:
                    sums.setdefault(k, []).append((zs[k], ns[k]))
        z = {k: sum(a for a, _ in v) / len(v) for k, v in sums.items()}
        n = {k: sum(b for _, b in v) / len(v) for k, v in sums.items()}
    for i, t in rows:
        assert abs(got[i] - sigmoid(sum(weight(z, n, k) for k in features(t)))) < 1e-9


# ------------------------------------------------------------------- quality (3)

def test_band_verdicts_equal_brute_force(spark):
    rng = random.Random(6)
    parts = {"en": ["ta", "re", "ing", "the", "on"], "fr": ["que", "les", "ment", "é"], "ru": ["при", "вет", "мир"], "xx": ["zq", "vv"]}
    rows = []
    for i in range(260):
        g = rng.choice(["en"] * 6 + ["fr"] * 3 + ["ru"] * 2 + ["xx"])
        w = ["".join(rng.choice(parts[g]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.choice([40, 60, 130, 300, 700]))]
        if rng.random() < 0.06:
            w = [x + "%#$"[:rng.randrange(1, 4)] for x in w]
        rows.append((i, " ".join(w), None if g == "ru" else g))
    vocabulary = P.path("piece_bpe_32k.model")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in quality.assess(docs, vocabulary).collect()}
    m = quality.meter(vocabulary)
    doc = {}
    for i, t, g in rows:
        x = dict(zip(quality.NAMES, quality.measure(t, m)))
        s = quality.script_of(t)
        doc[i] = x | {"script": s, "group": g or s, "size": x["n_tokens"].bit_length(),
                      "base": x["n_words"] < 50 or 100 * x["n_repeat_words"] > 50 * x["n_words"]}

    def meets(d):
        """Every band that a document counts in: kind and key, centre, reach."""
        keys = [("language", d["group"]), ("script", d["script"]), ("all", "")]
        return [(k, d["size"] + step, r) for k in keys for r in (0, 1, 2) for step in range(-r, r + 1)] + ["all"]
    good = [d for d in doc.values() if not d["base"]]
    members: dict = {}
    for d in good:
        for b in meets(d):
            members.setdefault(b, []).append(d)

    def own(d):
        keys = [("language", d["group"]), ("script", d["script"]), ("all", "")]
        return next((b for b in [(k, d["size"], r) for k in keys for r in (0, 1, 2)] + ["all"] if len(members.get(b, ())) >= 30), None)

    def median(v):
        return sorted(v)[math.ceil(len(v) / 2) - 1]
    kept = {}
    for i, d in doc.items():
        bad = d["base"] or d["chars_per_token"] < 1.0 or d["byte_share"] > 0.3
        band = None if d["base"] else own(d)
        if band:
            for c, least in zip(quality.BANDED, (0.015, 0.005, 0.05)):
                mid = median([x[c] for x in members[band]])
                dev = median([abs(x[c] - mid) for x in members[band]])
                bad = bad or abs(d[c] - mid) > 5.0 * max(1.4826 * dev, least)
        kept[i] = not bad
    assert {i: r.kept for i, r in got.items()} == kept
    assert 0 < sum(not k for i, k in kept.items() if not doc[i]["base"]) < 60


# ------------------------------------------------------------------- licences (8)

def test_cosines_equal_brute_force(spark):
    rng = random.Random(2)
    prose = [f"word{i}" for i in range(60)]
    variants = [t for _, t in licenses.VARIANTS]
    texts = []
    for i in range(60):
        lines = [" ".join(rng.choice(prose) for _ in range(rng.randrange(1, 9))) for _ in range(3)]
        if rng.random() < 0.8:
            w = licenses._words(rng.choice(variants))
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = rng.choice(prose)
            cut = rng.randrange(1, len(w) + 1) if rng.random() < 0.5 else len(w)
            lines[1] = " ".join(w[:cut]) + "\n" * (rng.random() < 0.5) + " ".join(w[cut:])
        texts.append((i, f"src/f{i}.c", "\n".join(lines)))
    files = spark.createDataFrame(texts, "id int, path string, text string")
    cue = re.compile(licenses.CUE)
    passages = {x: licenses._words(x) for _, _, t in texts if cue.search(t) for x in t.split("\n") if cue.search(x)}
    total = len(passages) + len(variants)
    df = Counter(t for w in list(passages.values()) + [licenses._words(v) for v in variants] for t in set(w))

    def vector(words):
        return {t: (1 + math.log(n)) * (math.log((1.0 + total) / (1 + df.get(t, 0))) + 1) for t, n in Counter(words).items()}
    wanted = [(name, vector(licenses._words(t))) for name, t in licenses.VARIANTS]

    def best(words):
        v = vector(words)
        size = math.sqrt(sum(x * x for x in v.values()))
        return max(((round(sum(v.get(t, 0) * x for t, x in u.items()) / size / math.sqrt(sum(x * x for x in u.values())), 9), name)
                    for name, u in wanted), key=lambda r: (r[0], [-ord(c) for c in r[1]])) if size else (0, None)

    def has_cue(w, i):
        return bool(re.search(licenses.CUE_TERM, w[i])) or tuple(w[i:i + 2]) in licenses.CUE_TERMS
    got = {r.id: (r.own, r.cosine) for r in licenses.assign(files).collect()}
    hits = 0
    for i, _, t in texts:
        w = licenses._words(t)
        tried = [licenses._words(x) for x in t.split("\n") if cue.search(x)]
        # a window laid for a template is compared when its words make up enough of that template
        tried += [x for at in range(len(w)) if has_cue(w, at) for v, b, n in licenses._layouts()
                  for x in [w[max(0, at - b):max(0, at - b + n)]]
                  if sum(wanted[v][1][t] ** 2 for t in set(x) & set(wanted[v][1])) >= 0.36 * (1 - 1e-6) * sum(u * u for u in wanted[v][1].values())]
        found = max((best(x) for x in tried if x), default=(0, None), key=lambda r: r[0])
        if found[0] < 0.6:
            assert got[i] == (None, None)
        else:
            hits += 1
            assert abs(got[i][1] - found[0]) < 1e-8, (i, got[i], found)
    assert hits > 20
