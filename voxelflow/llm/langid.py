"""Language identification with Viterbi spans over per-word scores.

Per word and language the score is the log probability of the word's hashed
character n-grams under that language.  The script of a word narrows the
candidates: languages that hardly ever use the script are out for that word.
Viterbi finds the best sequence of languages for the words of a text when every
switch costs ``penalty``, so a passage in another language becomes a span and a
stray word does not.  A text's language is the one with most letters.

Viterbi steps through many texts at once (one array operation per word position
for all texts of a slice), in the texts' full length.

Training counts n-grams of at most about ``rows_per_language`` labelled texts
per language (a documented bound on the classifier's sample, chosen by a hash of
the id).  The model has languages x 2^16 numbers; more than ``most_languages``
labels are an error, so the broadcast is bounded.

Nulls, blanks: a null text, or one without letters, is ``und`` with score 0 and
no spans.  Without training rows every text is ``und``.  A null id is never
trained on and never held out.  Repeated rows get equal results; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .quality import SCRIPT_STARTS, SCRIPTS

#: A letter, then letters and the marks that combine with them; digits of other scripts and numerals are no letters.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
CELLS = 1 << 16
GRAMS = (1, 2, 3)
KEPT_SCORES = 4_000_000   # words kept x languages
NEVER = -1e4
NAMES = sorted({n for _, n in SCRIPTS})
OF_RANGE = np.array([NAMES.index(n) for _, n in SCRIPTS])


def grams(words: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Hash cells of the n-grams of all words at once, and the script of each word's first letter.

    Per n the cells of all words one after another with each word's first place;
    last the cell of every whole word.
    """
    c = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array(list(map(len, words))) + 2
    start = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    out, h = [], c
    for n in GRAMS:
        if n > 1:
            h = h[:-1] * np.uint64(0x100000001B3) + c[n - 1:]
        own = h[word[:len(h)] == word[n - 1:]]
        cell = (own + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)
        out.append((cell.astype(np.int64), start - (n - 1) * np.arange(len(words))))
    whole = np.array([zlib.crc32(w.encode()) & 0xFFFF for w in words], np.int64)
    out.append((whole, np.arange(len(words))))
    at = np.searchsorted(SCRIPT_STARTS, c[start + 1], side="right") - 1
    return out, OF_RANGE[np.maximum(at, 0)]


def fold(doc_id: str, folds: int, n: int) -> Column:
    """True where crc32 of the id as text leaves ``n`` modulo ``folds``; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)) == n, F.lit(False))


class Model:
    def __init__(self, langs: list[str], logp: np.ndarray, allowed: np.ndarray):
        self.langs, self.logp, self.allowed = langs, logp, allowed


def train(rows: DataFrame, rows_per_language: int = 2000, most_languages: int = 1000, alpha: float = 0.1,
          least_share: float = 0.01) -> Model:
    """Model of ``rows(doc_id, text, lang)``; rows with a null text or lang are ignored."""
    rows = rows.select("doc_id", "text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    n = rows.groupBy("lang").count().limit(most_languages + 1).collect()
    if len(n) > most_languages:
        raise ValueError("too many languages")
    langs = sorted(r["lang"] for r in n)
    share = {r["lang"]: min(1.0, rows_per_language / r["count"]) for r in n}
    take = F.lit(False)
    for g in langs:
        take = take | ((F.col("lang") == g) & (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share[g] * 1_000_000)))
    number = {g: i for i, g in enumerate(langs)}

    def count(batches):
        total: dict[int, np.ndarray] = {}
        for b in (s for b in batches for s in common.slices(b)):
            seen: dict[int, Counter] = {}
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen.setdefault(number[lang], Counter()).update([w.lower() for w in WORD.findall(text)])
            for i, words in seen.items():
                own = total.setdefault(i, np.zeros(CELLS + len(NAMES), np.int64))
                if not words:
                    continue
                k = np.array(list(words.values()))
                by, scripts = grams(list(words))
                for cell, first in by:
                    n = np.diff(np.append(first, len(cell)))
                    own[:CELLS] += np.bincount(cell, np.repeat(k, n), CELLS).astype(np.int64)
                own[CELLS:] += np.bincount(scripts, k, len(NAMES)).astype(np.int64)
        for i, own in total.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)),
                                              pa.array(own[at])], names=["lang", "cell", "n"])
    counts = np.zeros((len(langs), CELLS + len(NAMES)))
    summed = (rows.filter(take).select("text", "lang").mapInArrow(count, "lang int, cell int, n bigint")
              .groupBy("lang", "cell").agg(F.sum("n").alias("n")))
    for r in summed.toLocalIterator():
        counts[r[0], r[1]] = r[2]
    smooth, scripts = counts[:, :CELLS] + alpha, counts[:, CELLS:]
    logp = np.log(smooth / smooth.sum(1, keepdims=True)).astype(np.float32)
    allowed = scripts >= least_share * np.maximum(scripts.sum(1, keepdims=True), 1)
    allowed[:, ~allowed.any(0)] = True
    return Model(langs, logp, allowed)


class Scorer:
    def __init__(self, model: Model):
        self.m = model
        self.number: dict[str, int] = {}
        self.rows = np.zeros((1024, len(model.langs)), np.float32)
        self.by_cell = np.ascontiguousarray(model.logp.T)
        self.never = np.where(model.allowed.T, 0, NEVER).astype(np.float32)

    def words(self, words: list[str]) -> np.ndarray:
        """Row numbers of the words' scores."""
        number = self.number
        new = [w for w in set(words) if w not in number]
        if new:
            by, scripts = grams(new)
            s = self.never[scripts]
            for cell, first in by:
                s += np.add.reduceat(self.by_cell[cell], first, axis=0)
            s -= s.max(1, keepdims=True)
            n = len(number)
            while n + len(new) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[n:n + len(new)] = s
            number.update(zip(new, range(n, n + len(new))))
        return np.array(list(map(number.__getitem__, words)), np.int64)

    def trim(self):
        if len(self.number) * len(self.m.langs) > KEPT_SCORES:
            self.number.clear()
            self.rows = self.rows[:1024]


def viterbi(scores: np.ndarray, rows: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of every word: texts of ``sizes`` words one after another, all stepped together."""
    order = np.argsort(-sizes, kind="stable")
    begin = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    live = np.searchsorted(-sizes, -np.arange(int(sizes[0]) + 1 if len(sizes) else 0), side="left")
    n, k = len(rows), scores.shape[1]
    stay = np.zeros((n, k), bool)
    came = np.zeros(n, np.int32)
    best = np.zeros((len(sizes), k), np.float32)
    for t in range(int(sizes[0]) if len(sizes) else 0):
        a = live[t]
        at = begin[:a] + t
        own = best[:a]
        top = own.argmax(1)
        switch = own[np.arange(a), top][:, None] - penalty
        keep = own >= switch
        stay[at], came[at] = keep, top
        own = np.where(keep, own, switch) + scores[rows[at]]
        best[:a] = own - own.max(1, keepdims=True)
    out = np.zeros(n, np.int32)
    state = best.argmax(1)
    for t in range(int(sizes[0]) - 1 if len(sizes) else -1, -1, -1):
        a = live[t]
        at = begin[:a] + t
        out[at] = state[:a]
        state[:a] = np.where(stay[at, state[:a]], state[:a], came[at])
    return out


def _spans(text: str, labels: np.ndarray, langs: list[str]) -> list[dict]:
    cut = np.concatenate([[0], np.flatnonzero(labels[1:] != labels[:-1]) + 1, [len(labels)]])
    if len(cut) == 2:
        return [{"start": 0, "stop": len(text), "lang": langs[labels[0]]}]
    starts = [m.start() for m in WORD.finditer(text)] + [len(text)]
    edges = [0, *(starts[c] for c in cut[1:-1]), len(text)]
    return [{"start": a, "stop": b, "lang": langs[labels[c]]} for a, b, c in zip(edges, edges[1:], cut)]


def identify(docs: DataFrame, model: Model, penalty: float = 20.0) -> DataFrame:
    """``(doc_id, lang_pred, score, spans)`` of every row; spans are (start, stop, lang) in code points."""
    d = common.doc_text(docs)
    kind = d.schema["doc_id"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)

    def scorer():
        if getattr(held.value, "scorer", None) is None:
            held.value.scorer = Scorer(held.value)
        return held.value.scorer

    def run(b: pa.RecordBatch) -> dict:
        s = scorer()
        langs = s.m.langs
        texts = [t or "" for t in b.column("text").to_pylist()]
        words = [WORD.findall(t) if langs else [] for t in texts]
        sizes = np.array(list(map(len, words)))
        flat = [w for ws in words for w in ws]
        lens = np.array(list(map(len, flat)), np.int64)
        rows = s.words([w.lower() for w in flat])
        labels = viterbi(s.rows, rows, sizes, penalty) if langs else rows
        s.trim()
        doc = np.repeat(np.arange(len(texts)), sizes)
        mass = np.zeros((len(texts), max(1, len(langs))))
        np.add.at(mass, (doc, labels), lens)
        total = mass.sum(1)
        top = mass.argmax(1)
        at = np.cumsum(sizes) - sizes
        return {"doc_id": b.column("doc_id"),
                "lang_pred": [langs[k] if n else "und" for k, n in zip(top, total)],
                "score": np.where(total > 0, mass.max(1) / np.maximum(total, 1), 0.0),
                "spans": [_spans(t, labels[a:a + n], langs) if n else [] for t, a, n in zip(texts, at, sizes)]}
    return common.map_rows(d, f"doc_id {kind}, lang_pred string, score double, "
                              "spans array<struct<start:bigint,stop:bigint,lang:string>>", run)


def predict_all(docs: DataFrame, folds: int = 4, held: int = 2, **how) -> DataFrame:
    """Identify every row with a model that never saw the held-out fold."""
    out = identify(docs, train(docs.filter(~fold("doc_id", folds, held) & F.col("doc_id").isNotNull()), **how))
    return out.withColumn("held_out", fold("doc_id", folds, held))


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))
