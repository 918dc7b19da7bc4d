"""Secret scans with built-in SQL functions only.

Base rules are regular expressions; their matches get offsets without a UDF by
splitting the text at the same expression: the lengths of the pieces between
matches and of the matches add up to the starts.

The method finds what no rule names.  Candidates are runs of six or more token
characters that mix letters with digits or change case twice, and all runs of
20 or more.  Two first-order Markov models of characters, one of random strings
and one of ordinary identifiers, are compared by their log-likelihood ratio.  A
candidate that overlaps no base span is added as kind ``random`` when its total
ratio reaches ``least_total``, the evidence that outweighs how rare secrets are: a
short run needs more of it per character than a long one.  A run of 20 or
more is also added when its mean ratio per character reaches ``least_ratio``.

The models are trained on labelled samples: the values of base matches are the
random class, other token runs the ordinary class, both taken from at most
about ``sample_rows`` documents chosen by a hash of the id (a documented bound;
the scan itself covers every row).  A model is one number per pair of
characters, so the trained table has a fixed size and becomes a literal.

Offsets count code points, ends are exclusive.  Nulls, blanks: a null text is
scanned as the empty text and has no spans.  Rows with a null id, repeated rows
and very long texts are scanned like any other (nothing is shuffled); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
LONG = 20
RUN = "[A-Za-z0-9+/_=-]"
CANDIDATE = (f"(?<!{RUN})(?:(?={RUN}*[0-9])(?={RUN}*[A-Za-z])|(?={RUN}*[a-z][A-Z]+[a-z]+[A-Z])|(?={RUN}{{{LONG}}}))"
             f"{RUN}{{6,}}")
ORDINARY = r"[A-Za-z0-9+/_=-]{6,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
KINDS = ("assign", "access", "hex", "random")
SIDE = len(ALPHABET) + 1
#: Log odds against a candidate before its characters are seen.
LEAST_TOTAL = 16.0
SPANS = "array<struct<start:bigint,kind:int,stop:bigint>>"


def scan(items: Column, zero: Column, step, kind: str, block: int = 256) -> Column:
    """Running accumulators of ``items``: [step(zero, x1), step(that, x2), ...].

    Appending to an array copies it, so results are gathered in blocks.
    """
    none = F.array().cast(f"array<{kind}>")
    last = F.floor((F.size(items) - 1) / block).cast("int")

    def one(acc, x):
        new = step(acc["s"], x)
        return F.struct(new.alias("s"), F.concat(acc["o"], F.array(new)).alias("o"))

    def some(acc, b):
        got = F.aggregate(F.slice(items, b * block + 1, F.lit(block)), F.struct(acc["s"].alias("s"), none.alias("o")), one)
        return F.struct(got["s"].alias("s"), F.concat(acc["o"], F.array(got["o"])).alias("o"))
    start = F.struct(zero.cast(kind).alias("s"), F.array().cast(f"array<array<{kind}>>").alias("o"))
    blocks = F.when(F.size(items) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(blocks, start, some, lambda acc: F.flatten(acc["o"]))


def _matches(text: Column, pattern: str, kind: int, ok=None, group: int = 0) -> Column:
    """Spans of the matches of ``pattern`` with the matched string (and a group) for further tests."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, m: F.struct(
        F.length(g).cast("bigint").alias("g"), F.length(m).cast("bigint").alias("m")))
    ends = scan(steps, F.lit(0), lambda s, x: s + x["g"] + x["m"], "bigint")
    found = F.transform(F.arrays_zip(ends.alias("e"), steps.alias("x"), part.alias("p")), lambda z: F.struct(
        (z["e"] - z["x"]["m"]).alias("start"), F.lit(kind).alias("kind"), z["e"].alias("stop"), z["p"].alias("part")))
    if ok is not None:
        found = F.filter(found, lambda s: ok(s["part"]))
    none = F.array().cast("array<struct<start:bigint,kind:int,stop:bigint,part:string>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def base_matches(text: Column) -> Column:
    return F.concat(_matches(text, ASSIGN, 0, lambda p: F.length(p) >= 6, 2),
                    _matches(text, ACCESS, 1, lambda p: F.length(p) >= 20),
                    _matches(text, HEX, 2))


def _bounds(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["stop"])).cast(SPANS)


def _overlaps(s, base: Column) -> Column:
    return F.exists(base, lambda b: (b["start"] < s["stop"]) & (b["stop"] > s["start"]))


def _positions(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.expr("0") + F.instr(F.lit(ALPHABET), c))


def train(docs: DataFrame, sample_rows: int = 20_000, alpha: float = 0.5) -> list[float]:
    """Log-likelihood ratios, random over ordinary, by (character before, character); row and column 0 are unused."""
    d = common.doc_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    rows = d.count()
    share = min(1.0, sample_rows / max(rows, 1))
    d = d.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    d = d.select("text", base_matches(F.col("text")).alias("base"))
    bounds = _bounds(F.col("base"))
    words = F.filter(_matches(F.col("text"), ORDINARY, 3), lambda s: ~_overlaps(s, bounds))
    tokens = d.select(F.explode(F.concat(
        F.transform("base", lambda s: F.struct(F.lit(1).alias("label"), s["part"].alias("token"))),
        F.transform(words, lambda s: F.struct(F.lit(0).alias("label"), s["part"].alias("token"))))).alias("t"))
    # a token is cut into pairs once, however often it occurs
    tokens = tokens.groupBy("t.label", "t.token").agg(F.count(F.lit(1)).alias("n"))
    at = tokens.select("label", "n", _positions(F.col("token")).alias("p"))
    pairs = at.select("label", "n", F.explode(F.zip_with(F.slice("p", 1, F.size("p") - 1), F.slice("p", 2, F.size("p") - 1),
                                                         lambda a, b: a * SIDE + b)).alias("cell"))
    counts = pairs.groupBy("label", "cell").agg(F.sum("n").alias("count")).collect()   # at most 2 * SIDE * SIDE rows
    n = [[alpha] * (SIDE * SIDE) for _ in range(2)]
    for r in counts:
        n[r["label"]][r["cell"]] += r["count"]
    out = [0.0] * (SIDE * SIDE)
    for a in range(1, SIDE):
        rows2 = [c[a * SIDE + 1:(a + 1) * SIDE] for c in n]
        sums = [sum(x) for x in rows2]
        for b in range(1, SIDE):
            out[a * SIDE + b] = math.log(rows2[1][b - 1] / sums[1]) - math.log(rows2[0][b - 1] / sums[0])
    return out


def ratio(token: Column, model: list[float]) -> Column:
    """Total log-likelihood ratio over the transitions of a token."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    p = _positions(token)
    cells = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), lambda a, b: a * SIDE + b)
    return F.aggregate(cells, F.lit(0.0), lambda s, c: s + table[c])


def find(docs: DataFrame, model: list[float], least_ratio: float = 0.75, least_total: float = LEAST_TOTAL) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, kind, stop) in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.array_sort(_bounds(base_matches(text)))
    with_base = docs.withColumn("base", base)
    free = F.filter(_matches(text, CANDIDATE, 3), lambda s: ~_overlaps(s, F.col("base")))
    scored = F.transform(free, lambda s: F.struct(s["start"], s["kind"], s["stop"], ratio(s["part"], model).alias("r")))
    size = lambda s: s["stop"] - s["start"]     # noqa: E731
    more = F.filter(scored, lambda s: (s["r"] >= least_total) | ((size(s) >= LONG) & (s["r"] >= least_ratio * (size(s) - 1))))
    return with_base.withColumn("spans", F.array_sort(F.concat("base", _bounds(more))))


def _named(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    def n(k):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(_named(F.col("base")), 256).alias("base_sha256"), _named(F.col("spans")).alias("spans"))


def scan_documents(docs: DataFrame, sample_rows: int = 20_000, least_ratio: float = 0.75) -> DataFrame:
    """``(doc_id, text, base, spans)`` of every row, with models trained on ``docs``."""
    return find(common.doc_text(docs), train(docs, sample_rows), least_ratio)


def redact(docs: DataFrame, mark: str = "[SECRET]", sample_rows: int = 20_000, least_ratio: float = 0.75) -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans once); ``n_chars`` follows where it exists.

    A null text stays null.
    """
    found = find(docs.select("doc_id", "text", F.struct(*docs.columns).alias("row")),
                 train(docs, sample_rows), least_ratio)
    spans, text = F.col("spans"), F.col("text")
    reach = scan(spans, F.lit(0), lambda s, x: F.greatest(s, x["stop"]), "bigint")
    before = F.slice(F.concat(F.array(F.lit(0).cast("bigint")), reach), 1, F.size(spans))
    parts = F.zip_with(spans, before, lambda s, b: F.when(
        s["start"] >= b, F.concat(F.substring(text, b.cast("int") + 1, (s["start"] - b).cast("int")), F.lit(mark))).otherwise(""))
    tail = F.substring(text, F.element_at(reach, -1).cast("int") + 1, F.length(text))
    out = found.withColumn("_new", F.when(F.size(spans) > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(text))
    return out.select(*[F.col("_new").alias("text") if c == "text"
                        else F.when(F.size(spans) > 0, F.length("_new").cast(t)).otherwise(F.col("row")[c]).alias(c)
                        if c == "n_chars" else F.col("row")[c].alias(c) for c, t in docs.dtypes])
