"""License scans with built-in SQL functions only.

Passages become sparse TF-IDF vectors and are compared to licence templates by
cosine: lines that carry a licence cue, whole licence files, and word windows
over the whole text, whatever its line breaks.  Around every cue a window is
laid for each template so that the cue falls on the template's own cue, as long
as the template and half as long again.  A window that holds too little of the
template's norm to reach ``least_cosine`` is left out before it is exploded
(Cauchy-Schwarz, so no match is lost).  The inverse document frequencies are
counted over the lines, licence files and templates; a word outside them counts
as met nowhere.  A file's own licence is the template of its best passage at
``least_cosine`` or more.  A file without one inherits from the nearest ancestor directory that
holds a licence file: the directories above a path are generated and joined to
the directories of licence files by equality, and the longest one wins.  A file
is a licence file by its name and, with ``licence_share``, also by its text: at
least that share of its words are those of a template of its own licence.

Texts are cut into overlapping blocks before their cues are, so a text full of
cues makes no large row, and equal surroundings are compared once.  Terms and
directories may be hot (a word in every notice, the root of a third of all paths): both joins
go through ``skew.join_unique``, and sums are pre-aggregated.

Nulls, blanks: a null or empty text has no passage and no own licence.  A null
path inherits nothing and holds nothing.  Ties between templates go to the
smaller name, ties between licence files of one directory to the smaller
licence.  Rows with equal id and path are one file: their passages count
together, and each row is returned.  An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_unique
from ..session import cut_lineage

#: Names and characteristic notices of common licences.
TEMPLATES = {
    "AGPL-3.0": "this program is licensed under the gnu affero general public license version 3 agpl",
    "Apache-2.0": "licensed under the apache license version 2.0 you may not use this file except in compliance with the license",
    "BSD-2-Clause": "redistribution and use in source and binary forms with or without modification are permitted simplified bsd 2 clause license",
    "BSD-3-Clause": "redistribution and use in source and binary forms with or without modification are permitted neither the name of the "
                    "copyright holder may be used to endorse new bsd 3 clause license",
    "CC-BY-4.0": "licensed under cc by 4.0 creative commons attribution 4.0 international license",
    "CC-BY-NC-4.0": "licensed under cc by nc 4.0 creative commons attribution noncommercial 4.0 international license",
    "CC-BY-SA-4.0": "licensed under cc by sa 4.0 creative commons attribution sharealike 4.0 international license",
    "CC0-1.0": "cc0 1.0 universal public domain dedication no rights reserved",
    "GPL-2.0": "this work is licensed under the gnu general public license version 2 gpl",
    "GPL-3.0": "this work is licensed under the gnu general public license version 3 gpl",
    "ISC": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted isc license",
    "LGPL-3.0": "licensed under the gnu lesser general public license version 3 lgpl",
    "MIT": "released under the mit license permission is hereby granted free of charge to any person obtaining a copy of this software",
    "MPL-2.0": "this source code form is subject to the terms of the mozilla public license version 2.0 mpl",
    "Unlicense": "this is free and unencumbered software released into the public domain unlicense",
}
#: Short forms; the best variant of a template counts.
SHORT = {
    "Apache-2.0": "licensed under the apache license version 2.0", "MIT": "released under the mit license",
    "CC-BY-4.0": "licensed under cc by 4.0", "CC-BY-NC-4.0": "licensed under cc by nc 4.0",
    "CC-BY-SA-4.0": "licensed under cc by sa 4.0", "BSD-3-Clause": "bsd 3 clause license",
    "BSD-2-Clause": "bsd 2 clause license", "GPL-3.0": "gnu general public license version 3",
    "GPL-2.0": "gnu general public license version 2", "MPL-2.0": "mozilla public license version 2.0",
    "AGPL-3.0": "gnu affero general public license version 3", "LGPL-3.0": "gnu lesser general public license version 3",
    "LGPL-2.1": "gnu lesser general public license version 2.1",
}


def _gnu(work: str, name: str, version: str) -> str:
    return (f"{work} is free software you can redistribute it and or modify it under the terms of the gnu {name} as published by the "
            f"free software foundation either version {version} of the license or at your option any later version")


_BSD = ("redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met 1. redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer 2. redistributions in binary form must reproduce the above copyright notice this list of conditions and "
        "the following disclaimer in the documentation and or other materials provided with the distribution")
#: Standard headers in full; they tell apart licences that share their first words.
HEADERS = {
    "AGPL-3.0": _gnu("this program", "affero general public license", "3"),
    "BSD-2-Clause": _BSD,
    "BSD-3-Clause": _BSD + " 3. neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                           "promote products derived from this software without specific prior written permission",
    "GPL-2.0": _gnu("this program", "general public license", "2"),
    "GPL-3.0": _gnu("this program", "general public license", "3"),
    "LGPL-2.1": _gnu("this library", "lesser general public license", "2.1"),
    "LGPL-3.0": _gnu("this library", "lesser general public license", "3"),
    "MPL-2.0": "this source code form is subject to the terms of the mozilla public license v. 2.0 if a copy of the mpl was not "
               "distributed with this file you can obtain one at",
}
VARIANTS = [*TEMPLATES.items(), *SHORT.items(), *HEADERS.items()]
CUE = r"(?i)licen[sc]e|copyright|spdx-|public domain|hereby granted|redistribution and use"
#: The same cues where a line break or a comment mark may stand between the words.
WRAPPED_CUE = r"(?i)licen[sc]e|copyright|spdx-|public\W+domain|hereby\W+granted|redistribution\W+and\W+use"
CUE_TERM = "licen[sc]e|copyright|spdx"
CUE_TERMS = (("public", "domain"), ("hereby", "granted"), ("redistribution", "and"))
#: Words of a text that are cut out together.
BLOCK = 256
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)[^/]*$"


NO_TERM = r"[^a-z0-9.]+|\.(?![0-9])"


def _words(text: str) -> list[str]:
    return re.sub(NO_TERM, " ", text.lower()).split()


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), NO_TERM, " "), " +"), lambda t: t != "")


def _layouts() -> list[tuple[int, int, int]]:
    """``(variant, words before the cue, words)`` of the windows laid around a cue, the template's length and half more.

    A template that begins another licence's is laid as long as that one, so that both are compared over the same words.
    """
    out = []
    texts = [(n, _words(t)) for n, t in VARIANTS]
    for v, (name, words) in enumerate(texts):
        at = next(i for i, w in enumerate(words) if re.search(CUE_TERM, w) or (w, *words[i + 1:i + 2]) in CUE_TERMS)
        n = max(len(u) for m, u in texts if u == words or m != name and u[:len(words)] == words)
        more = n // 4 + 1
        out += [(v, at, n), (v, at + more, n + 2 * more)]
    return out


def passages(files: DataFrame, licence_file: str = LICENCE_FILE) -> DataFrame:
    """``(key, path, passage, terms)`` for every cue line, and for the whole text of every licence file."""
    lines = F.transform(F.filter(F.split("text", r"\r\n|\n|\r"), lambda s: s.rlike(CUE)), lambda s: s)
    whole = F.when(F.col("path").rlike(licence_file), F.array("text")).otherwise(F.array().cast("array<string>"))
    return (files.filter(F.col("text").rlike(CUE))
                 .select("key", "path", F.explode(F.array_distinct(F.concat(lines, whole))).alias("passage"))
                 .select("key", "path", F.xxhash64("passage").alias("passage"), _terms(F.col("passage")).alias("terms")))


def _part(words: Column, start: Column, stop: Column) -> Column:
    """The words from ``start`` to before ``stop``, which may lie outside."""
    first = F.greatest(start, F.lit(0))
    return F.slice(words, first + 1, F.greatest(stop - first, F.lit(0)))


def surroundings(files: DataFrame) -> DataFrame:
    """``(key, context, before, terms)``: the words around every cue of a text, ``before`` of them ahead of the cue."""
    reach = max(max(b, n - b) for _, b, n in _layouts())
    w = F.col("words")
    cue = lambda i: F.coalesce(F.get(w, i).rlike(CUE_TERM), F.lit(False)) | F.coalesce(
        F.concat_ws(" ", F.get(w, i), F.get(w, i + 1)).isin([" ".join(p) for p in CUE_TERMS]), F.lit(False))
    worded = (files.filter(F.col("text").rlike(WRAPPED_CUE)).select("key", _terms(F.col("text")).alias("words"))
                   .filter(F.size("words") > 0))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("words") - 1) / BLOCK).cast("int")), lambda k: F.struct(
        F.least(k * BLOCK, F.lit(reach)).alias("ahead"), F.least(F.size(w) - k * BLOCK, F.lit(BLOCK)).alias("n"),
        _part(w, k * BLOCK - reach, (k + 1) * BLOCK + reach).alias("words")))
    cut = worded.select("key", F.inline(blocks))
    at = F.filter(F.sequence(F.col("ahead"), F.col("ahead") + F.col("n") - 1), cue)
    around = F.transform(at, lambda i: F.struct(F.least(i, F.lit(reach)).alias("before"), _part(w, i - reach, i + reach).alias("terms")))
    return cut.select("key", F.inline(around)).select("key", F.xxhash64("before", "terms").alias("context"), "before", "terms")


def windows(contexts: DataFrame, weights: dict[str, float], least_cosine: float) -> DataFrame:
    """``(context, passage, terms)`` of the windows of ``contexts(context, before, terms)`` that may reach ``least_cosine``.

    A cosine is at most the share of the template's norm that the window's words make up.
    """
    squares = []
    for _, text in VARIANTS:
        squares.append({t: ((1 + math.log(n)) * weights[t]) ** 2 for t, n in Counter(_words(text)).items()})
    laid = F.array(*[F.struct(
        F.lit(b).alias("b"), F.lit(n).alias("n"), F.array(*map(F.lit, squares[v])).alias("terms"),
        F.create_map(*[F.lit(x) for p in squares[v].items() for x in p]).alias("squares"),
        F.lit(sum(squares[v].values()) * least_cosine ** 2 * (1 - 1e-6)).alias("least")) for v, b, n in _layouts()])
    c, w = F.col("before"), F.col("terms")

    def window(x):
        return _part(w, c - x["b"], c - x["b"] + x["n"])

    def enough(x):
        held = F.array_intersect(x["terms"], window(x))
        return F.aggregate(held, F.lit(0.0), lambda a, t: a + F.element_at(x["squares"], t)) >= x["least"]
    found = F.array_distinct(F.transform(F.filter(laid, enough), window))
    return (contexts.select("context", F.explode(found).alias("terms"))
                    .select("context", F.xxhash64("terms").alias("passage"), "terms"))


def _templates(spark) -> DataFrame:
    texts = F.array(*[F.struct(F.lit(n).alias("licence"), F.lit(t).alias("text")) for n, t in VARIANTS])
    return spark.range(1).select(F.inline(texts)).select(
        "licence", F.xxhash64("text").alias("variant"), _terms(F.col("text")).alias("terms"))


def _counts(vectors: DataFrame) -> DataFrame:
    return vectors.select("passage", F.explode("terms").alias("term")).groupBy("passage", "term").agg(F.count(F.lit(1)).alias("tf"))


def scan(files: DataFrame, least_cosine: float = 0.6, licence_file: str = LICENCE_FILE) -> DataFrame:
    """``(key, licence, cosine)`` of the files of ``files(key, path, text)`` that name a licence."""
    spark = files.sparkSession
    # equal passages of different files are one vector
    found = cut_lineage(passages(files, licence_file))
    vectors = found.select("passage", "terms").dropDuplicates(["passage"])
    lines = cut_lineage(_counts(vectors))
    t = _templates(spark)
    ttf = t.select("licence", "variant", F.explode("terms").alias("term")).groupBy("licence", "variant", "term").agg(
        F.count(F.lit(1)).alias("tf"))
    total = vectors.count() + len(VARIANTS)
    df = cut_lineage(lines.select("term").unionByName(ttf.select("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    idf = df.select("term", (F.log(F.lit(1.0 + total) / (1 + F.col("n"))) + 1).alias("idf"))
    # the template vectors are a fixed list of a few hundred terms
    known = {r.term: r.idf for r in idf.join(F.broadcast(ttf.select("term").distinct()), "term").collect()}
    around = cut_lineage(surroundings(files))
    laid = cut_lineage(windows(around.select("context", "before", "terms").dropDuplicates(["context"]), known, least_cosine))
    tf = cut_lineage(lines.unionByName(_counts(laid.select("passage", "terms").dropDuplicates(["passage"]))))
    weighed = join_unique(tf, idf, "term").withColumn("idf", F.coalesce("idf", F.lit(math.log(1.0 + total) + 1)))
    w = weighed.select("passage", "term", ((1 + F.log("tf")) * F.col("idf")).alias("w"))
    tw = ttf.join(idf, "term").select("licence", "variant", "term", ((1 + F.log("tf")) * F.col("idf")).alias("tw"))
    tn = tw.groupBy("licence", "variant").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tn"))
    norm = w.groupBy("passage").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dot = (w.join(F.broadcast(tw), "term").groupBy("passage", "licence", "variant")
            .agg(F.sum(F.col("w") * F.col("tw")).alias("dot")))
    cos = (dot.join(F.broadcast(tn), ["licence", "variant"]).join(norm, "passage")
              .withColumn("cosine", F.round(F.col("dot") / (F.col("tn") * F.col("norm")), 9)))
    best = cut_lineage(cos.groupBy("passage").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b"))
                          .select("passage", F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine"))
                          .filter(F.col("cosine") >= least_cosine))
    # the best window of a context, then of a file
    of_context = _best(join_unique(laid.select("context", "passage"), best, "passage"), "context")
    hits = join_unique(found.select("key", "passage"), best, "passage").select("key", "licence", "cosine").unionByName(
        join_unique(around.select("key", "context"), of_context, "context").select("key", "licence", "cosine"))
    return _best(hits, "key")


def _best(hits: DataFrame, by: str) -> DataFrame:
    """``(by, licence, cosine)`` of the highest cosine of each ``by``."""
    return (hits.filter(F.col("licence").isNotNull())
                .groupBy(by).agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b"))
                .select(by, F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine")))


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def mostly_licence(files: DataFrame, share: float) -> DataFrame:
    """``(key, licence)`` where ``share`` of a text's words or more are those of a template, each as often as it holds it."""
    counts = [Counter(_words(text)) for _, text in VARIANTS]
    variants = F.array(*[F.struct(F.lit(n).alias("licence"), F.array(*[F.struct(F.lit(t).alias("term"), F.lit(k).alias("n")) for t, k in c.items()])
                                  .alias("terms")) for (n, _), c in zip(VARIANTS, counts)])
    longest = int(max(c.total() for c in counts) / share)
    words = (files.filter(F.col("text").rlike(WRAPPED_CUE)).select("key", _terms(F.col("text")).alias("words"))
                  .filter(F.size("words").between(1, longest)))

    def shared(v):
        return F.aggregate(v["terms"], F.lit(0), lambda a, t: a + F.least(F.size(F.filter(F.col("words"), lambda w: w == t["term"])), t["n"]))
    found = F.transform(F.filter(variants, lambda v: shared(v) >= F.size("words") * share), lambda v: v["licence"])
    return words.select("key", F.explode(found).alias("licence")).distinct()


def resolve(files: DataFrame, own: DataFrame, licence_file: str = LICENCE_FILE, whole: DataFrame | None = None) -> DataFrame:
    """``(key, inherited, inherited_from)`` of the files without an own licence, from the nearest licensed directory.

    ``whole``: keys of files that are their directory's licence files whatever their name; a file above all directories isn't.
    """
    named = join_unique(files.select("key", "path").distinct(), own.select("key", "licence"), "key")
    is_licence = F.col("path").rlike(licence_file)
    if whole is not None:
        named = join_unique(named, whole.select("key", F.lit(True).alias("whole")), "key")
        is_licence = is_licence | F.col("whole").isNotNull() & (_directory(F.col("path")) != "")
    held = (named.filter(F.col("licence").isNotNull() & is_licence)
                 .groupBy(_directory(F.col("path")).alias("dir")).agg(F.min("licence").alias("licence")))
    parts = F.split(_directory(F.col("path")), "/")
    above = (named.filter(F.col("licence").isNull() & F.col("path").isNotNull())
                  .select("key", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(
                      F.slice(parts, 1, i), "/"))).alias("dir")).distinct())
    found = join_unique(above, held, "dir").filter(F.col("licence").isNotNull())
    return (found.groupBy("key").agg(F.max(F.struct(F.length("dir").alias("n"), "dir", "licence")).alias("b"))
                 .select("key", F.col("b.licence").alias("inherited"), F.col("b.dir").alias("inherited_from")))


def assign(files: DataFrame, least_cosine: float = 0.6, licence_file: str = LICENCE_FILE, licence_share: float | None = None) -> DataFrame:
    """``(id, path, own, cosine, inherited_from, licence)`` of every row of ``files(id, path, text)``."""
    key = F.xxhash64(F.col("id").cast("string"), F.lit("\u0000"), F.col("path"))
    keyed = files.select("id", F.col("path").cast("string").alias("path"), "text").withColumn("key", key)
    own = cut_lineage(scan(keyed, least_cosine, licence_file))
    slim = keyed.select("id", "path", "key")
    whole = None
    if licence_share is not None:
        whole = cut_lineage(mostly_licence(keyed, licence_share).join(own.select("key", "licence"), ["key", "licence"]).select("key").distinct())
    inherited = resolve(slim, own, licence_file, whole)
    out = join_unique(join_unique(slim, own.withColumnRenamed("licence", "own"), "key"), inherited, "key")
    return out.select("id", "path", "own", "cosine", "inherited_from", F.coalesce("own", "inherited").alias("licence"))
