"""Quality rules: text shape counts and tokeniser fertility with bands per script.

Base counts are taken over the whole text on its UTF-8 bytes (words are runs
without ASCII white space).  Fertility is measured by a public vocabulary with
byte fallback: characters per token, share of byte-fallback tokens, and entropy
of the token distribution.  Pieces never cross a word, so each distinct word is
tokenised once per worker and kept in a bounded table.

Bands: per language (``lang`` where given, else the script of most letters) and
size class (power of two of the token count), the median and the median
absolute deviation of each measure over *all* documents that pass the base
rules.  A document is rejected when a measure lies more than ``width`` scaled
deviations from the median, or beyond a fixed floor.  Size classes make the
measures comparable: both spread and entropy depend on the length.  A document
whose band has fewer than ``least`` documents takes the next wider full one:
its language over one and two neighbouring size classes to each side, then its
script, then all documents likewise, then all documents of any size.  Only a
table with fewer than ``least`` documents that pass has no usable spread; the
floors alone hold there.

Nulls, blanks: a null or wordless text has no words, so the base rule rejects
it.  Null or unknown ``lang`` values use the script.  Rows with a null id and
repeated rows are measured like any other; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_unique
from ..session import cut_lineage
from . import common

KEPT_BYTES = 16 << 20       # each of two generations
KEPT_LENGTH = 64
BLANKS = "\t\n\x0b\x0c\r "
SYMBOLS = b"#*$%&|<>"

#: First code point of each script range, with its name; a letter belongs to the last range that starts at or below it.
SCRIPTS = [
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"),
]
SCRIPT_STARTS = np.array([a for a, _ in SCRIPTS])


class Meter:
    """Tokens per word for one vocabulary."""

    def __init__(self, path: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.sp.get_piece_size()
        self.byte = np.array([self.sp.is_byte(i) for i in range(size)])
        self.type = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.kept = common.Kept(KEPT_BYTES)

    def tokens(self, words: list[bytes]) -> np.ndarray:
        """Token ids of the words, each tokenised by itself."""
        young, old = self.kept.young, self.kept.old
        found = {w: young.get(w) or old.get(w) for w in set(words)}
        new = [w for w, ids in found.items() if ids is None]
        size = 0
        for w, ids in zip(new, self.sp.encode([w.decode("utf-8") for w in new], num_threads=1)):
            found[w] = np.array(ids, self.type).tobytes()
        for w, packed in found.items():
            if w not in young and len(w) <= KEPT_LENGTH:
                young[w] = packed
                size += 180 + len(w) + len(packed)
        self.kept.grown(size)
        return np.frombuffer(b"".join(map(found.__getitem__, words)), self.type)


@lru_cache(maxsize=2)
def meter(path: str) -> Meter:
    return Meter(path)


def repeat_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows of ``window`` words that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    key = ids[:n]
    for k in range(1, window):
        key = key * len(number) + ids[k:n + k]
        if k < window - 1 and len(number) ** (k + 2) > 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
    order = np.argsort(key, kind="stable")
    s = key[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(len(words), bool)
    for k in range(window):
        hit[k:n + k] |= twice
    return int(hit.sum())


def script_of(text: str) -> str:
    """Script of most letters of the text; ``none`` without letters."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.searchsorted(SCRIPT_STARTS, cp, side="right") - 1
    plain = (cp < 0x41) | ((cp > 0x5A) & (cp < 0x61)) | ((cp > 0x7A) & (cp < 0xC0))
    counts = np.bincount(at[~plain & (at >= 0)], minlength=len(SCRIPTS))
    return SCRIPTS[int(counts.argmax())][1] if counts.any() else "none"


def measure(text: str | None, m: Meter) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_tokens, chars_per_token, byte_share,
    entropy in bits) of a whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    word_chars = len(text) - sum(map(text.count, BLANKS))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    dup = len(lines) - len(set(lines))
    repeats = repeat_words(words)
    if not words:
        return 0, 0, symbols, dup, 0, 0, None, None, None
    ids = m.tokens(words)
    n = len(ids)
    p = np.bincount(ids)
    p = p[p > 0] / n
    entropy = float(-(p * np.log2(p)).sum())
    return (len(words), word_chars, symbols, dup, repeats, n, word_chars / n, float(m.byte[ids].mean()),
            entropy)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens",
         "chars_per_token", "byte_share", "token_entropy")
#: Neighbouring size classes to each side of a band, from narrow to wide.
REACH = (0, 1, 2)
BANDED = ("chars_per_token", "byte_share", "token_entropy")


def measures(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row of counts and fertility measures per row of ``docs(doc_id, text[, lang])``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")

    def run(b: pa.RecordBatch) -> dict:
        m = meter(vocabulary)
        texts = b.column("text").to_pylist()
        out = dict(zip(NAMES, map(list, zip(*[measure(t, m) for t in texts]))))
        script = [script_of(t or "") for t in texts]
        band = [f"{g if g else s}/{n.bit_length()}"
                for g, s, n in zip(b.column("lang").to_pylist(), script, out["n_tokens"])]
        return {"doc_id": b.column("doc_id"), "band": band, "script": script} | out
    return common.map_rows(
        docs.select("doc_id", "text", lang.alias("lang")),
        f"doc_id {kind}, band string, script string, " + ", ".join(f"{c} bigint" for c in NAMES[:6]) + ", "
        + ", ".join(f"{c} double" for c in NAMES[6:]), run, keeps="quality",
        clear=lambda: meter(vocabulary).kept.clear())


def _wide_bands(cells: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``(cell, wide)``, the narrowest full band of each of ``cells(cell, band, script, n)``, and ``(cell, fed)``, the bands in use
    that the cell's documents count in (28 at most)."""
    size = F.substring_index("band", "/", -1)
    group = F.expr("substring(band, 1, length(band) - length(substring_index(band, '/', -1)))")
    kinds = [F.concat(F.lit("language/"), group), F.concat(F.lit("script/"), "script", F.lit("/")), F.lit("all/")]

    def name(kind, r, d):
        return F.concat(kind, (size.cast("int") + d).cast("string"), F.lit(f"/{r}"))
    every = F.lit("all")
    own = F.array(*[name(g, r, 0) for g in kinds for r in REACH], every)
    meets = F.array(*[name(g, r, d) for g in kinds for r in REACH for d in range(-r, r + 1)], every)
    met = cells.select("cell", "n", F.explode(meets).alias("wide"))
    full = met.groupBy("wide").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("wide")
    chosen = cut_lineage(cells.select("cell", F.posexplode(own).alias("at", "wide")).join(full, "wide")
                              .groupBy("cell").agg(F.min(F.struct("at", "wide"))["wide"].alias("wide")))
    fed = cut_lineage(met.join(chosen.select("wide").distinct(), "wide").groupBy("cell").agg(F.collect_list("wide").alias("fed")))
    return chosen, fed


def verdicts(measured: DataFrame, width: float = 5.0, least_spread: tuple = (0.015, 0.005, 0.05),
             least: int = 30, fewest_chars: float = 1.0, most_bytes: float = 0.3) -> DataFrame:
    """``measured`` with base_failed and kept; ``measured`` is read several times.

    ``width``: scaled deviations allowed; ``least_spread``: smallest scaled deviation of
    characters per token, byte share and entropy; ``fewest_chars`` per token and
    ``most_bytes`` (share of byte-fallback tokens) hold in every band.
    """
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    m = measured.withColumn("base_failed", base).withColumn("cell", F.concat_ws("/", "script", "band"))
    good = m.filter(~F.col("base_failed"))
    mids, devs = [f"_m{i}" for i in range(3)], [f"_s{i}" for i in range(3)]
    cells = cut_lineage(good.groupBy("cell", "band", "script").agg(F.count(F.lit(1)).alias("n")))
    chosen, fed = _wide_bands(cells, least)
    good = join_unique(good.select("cell", *BANDED), fed, "cell", cells).select(F.explode("fed").alias("wide"), *BANDED)
    mid = cut_lineage(good.groupBy("wide").agg(
        *[F.percentile_approx(c, 0.5, 1000).alias(o) for c, o in zip(BANDED, mids)], F.count(F.lit(1)).alias("n")))
    far = join_unique(good, mid.drop("n"), "wide", mid.select("wide", "n"))
    dev = far.groupBy("wide").agg(*[F.percentile_approx(F.abs(F.col(c) - F.col(o)), 0.5, 1000).alias(d)
                                    for c, o, d in zip(BANDED, mids, devs)])
    bands = cut_lineage(chosen.join(mid.drop("n").join(dev, "wide"), "wide").drop("wide"))
    m = join_unique(m, bands, "cell")
    bad = (F.col(BANDED[0]) < fewest_chars) | (F.col(BANDED[1]) > most_bytes)
    for c, o, d, e in zip(BANDED, mids, devs, least_spread):
        bad = bad | F.coalesce(F.abs(F.col(c) - F.col(o)) > width * F.greatest(1.4826 * F.col(d), F.lit(e)), F.lit(False))
    return m.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(bad, F.lit(False))).select(
        *measured.columns, "base_failed", "kept")


def assess(docs: DataFrame, vocabulary: str, **bands) -> DataFrame:
    """Counts, fertility and verdict of every row of ``docs``."""
    return verdicts(cut_lineage(measures(docs, vocabulary)), **bands)


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "n_tokens", "chars_per_token", "byte_share", "token_entropy")


def keep_good(docs: DataFrame, vocabulary: str, **bands) -> DataFrame:
    """The rows of ``docs`` that pass; the decision is taken per row, so repeated rows go or stay alike.

    Rows are told apart by a 128-bit key of the whole row, so a null or repeated id is no matter.
    """
    lang = "lang" if "lang" in docs.columns else F.lit(None).cast("string").alias("lang")
    keyed = common.keyed_rows(docs, "text", lang)
    got = assess(keyed.select(F.struct("a", "b").alias("doc_id"), "text", "lang"), vocabulary, **bands)
    keep = got.filter("kept").select("doc_id.a", "doc_id.b").distinct()
    return keyed.select("row", "a", "b").join(keep, ["a", "b"], "left_semi").select("row.*")
