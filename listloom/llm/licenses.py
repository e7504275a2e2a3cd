"""License scans: base phrases, and notices found by diagonal voting.

All runs of ``K`` words of a text are joined to the places where they stand in
the templates. A match at word p of a text and word t of a template lies on
diagonal p - t; a copied notice is a heap of matches on one diagonal, or on
neighbouring ones where words were added or left out. Votes are counted per
text, template and diagonal before they are shuffled. Matches on neighbouring diagonals are chained in the text's order where
text and template both go on, and a chain's span counts if its matches cover enough of the template's words. Runs are joined as texts, so each
vote is a true match, and a span is verified by the words it covers.

Where spans of two labels overlap, the template that fits better stays: a span is ruled out by another label's chain, of any share, that
covers all its words and leaves out fewer between, and by a found span with the higher share of template and span.

The templates are a parameter of the scan and the only thing broadcast.

Cases: null and empty texts have no words, phrases or spans. Rows that repeat
an id and a text each get the same result; rows that share only the id are
scanned apart. Several notices in one text give several spans. A template of
fewer than ``K`` words is never found.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.llm.text import NON_ALNUM, let, lowered, same_row, ship, split_words, with_key

ship(__name__)

K = 3

# Phrases that count by themselves.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# The opening or the telling sentence of common notices.
TEMPLATES = {
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files to deal in the software without restriction including without limitation the rights to use "
        "copy modify merge publish distribute sublicense and or sell copies of the software",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement",
    ],
    "apache": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0",
    ],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
    ],
    "agpl": ["under the terms of the gnu affero general public license as published by the free software foundation"],
    "lgpl": ["under the terms of the gnu lesser general public license as published by the free software foundation"],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission",
    ],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "epl": ["made available under the terms of the eclipse public license 2 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "cc-by": ["this work is licensed under a creative commons attribution 4 0 international license", "licensed under cc by 4 0"],
    "cc-by-sa": ["this work is licensed under a creative commons attribution sharealike 4 0 international license", "licensed under cc by sa 4 0"],
    "cc-by-nd": ["this work is licensed under a creative commons attribution noderivatives 4 0 international license", "licensed under cc by nd 4 0"],
    "cc-by-nc": ["this work is licensed under a creative commons attribution noncommercial 4 0 international license", "licensed under cc by nc 4 0"],
    "cc-by-nc-sa": [
        "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license", "licensed under cc by nc sa 4 0",
    ],
    "cc-by-nc-nd": [
        "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license", "licensed under cc by nc nd 4 0",
    ],
    "cc0": ["to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"],
}


def template_runs(spark, templates: dict[str, list[str]], k: int = K) -> DataFrame:
    """(run, label, template, t, length): where each run of words stands in the templates."""
    rows = []
    for label, texts in sorted(templates.items()):
        for n, text in enumerate(texts):
            words = text.split()
            rows += [
                (" ".join(words[t : t + k]), label, f"{label}/{n}", t, len(words)) for t in range(len(words) - k + 1)
            ]
    return spark.createDataFrame(rows, "run string, label string, template string, t int, length int")


def votes(docs: DataFrame, templates: dict[str, list[str]] | None = None, k: int = K) -> DataFrame:
    """(doc_id, text_key, label, template, length, diagonal, matches): matched (p, t) pairs per diagonal."""
    runs = template_runs(docs.sparkSession, TEMPLATES if templates is None else templates, k)

    def runs_of(w):
        starts = F.sequence(F.lit(0), F.size(w) - k)
        made = F.transform(starts, lambda i: F.lower(F.concat_ws(" ", *[F.get(w, i + j) for j in range(k)])))
        return F.when(F.size(w) >= k, made).otherwise(F.array().cast("array<string>"))

    placed = with_key(docs).select(
        "doc_id", "text_key", F.posexplode(let(split_words(lowered(F.col("text")), NON_ALNUM), runs_of)).alias("p", "run")
    )
    return (
        placed.join(F.broadcast(runs), "run")
        .groupBy("doc_id", "text_key", "label", "template", "length", (F.col("p") - F.col("t")).alias("diagonal"))
        # at most one match for each word of the template
        .agg(F.collect_set("t").alias("ts"))
    )


def chains(matches: list[tuple[int, int]], length: int, slack: int, k: int) -> list[list[tuple[int, int]]]:
    """Chains of (p, t) matches, the one that covers most first; each match is in one chain at most.

    In a chain p and t rise, and the diagonal moves by ``slack`` at most from one match to the next.
    """
    matches = sorted(matches)
    score, before, first = [], [], 0
    for i, (p, t) in enumerate(matches):
        while matches[first][0] < p - length - slack:
            first += 1
        best, last = k, -1
        for j in range(i - 1, first - 1, -1):
            q, u = matches[j]
            if q < p and u < t and abs(p - t - q + u) <= slack:
                # Of equals the match on the nearest diagonal.
                gain = score[j] + min(k, t - u)
                if gain > best or gain == best and last >= 0 and abs(p - t - q + u) < abs(p - t - matches[last][0] + matches[last][1]):
                    best, last = gain, j
        score.append(best)
        before.append(last)
    used, out = [False] * len(matches), []
    for i in sorted(range(len(matches)), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(matches[i])
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def found_spans(votes: list[dict], slack: int, least: float, k: int) -> list[tuple[str, int, int, float]]:
    """(label, start, end, share) of one text's notices."""
    by_template: dict = {}
    for v in votes:
        by_template.setdefault((v["template"], v["label"], v["length"]), []).extend((v["diagonal"] + t, t) for t in v["ts"])
    held = []
    for (_, label, length), matches in sorted(by_template.items()):
        for chain in chains(matches, length, slack, k):
            words = {p + i for p, _ in chain for i in range(k)}
            places = {t + i for _, t in chain for i in range(k)}
            start, end = chain[0][0], chain[-1][0] + k
            left_out = end - start - len(words) + chain[-1][1] + k - chain[0][1] - len(places)
            held.append((label, start, end, len(places) / length, len(places) / max(length, end - start), left_out, words))
    good = [x for x in held if x[3] >= least]
    # Chains by the words of the text, so that only those that meet are compared.
    at: dict[int, list[int]] = {}
    for n, x in enumerate(held):
        for w in x[6]:
            at.setdefault(w, []).append(n)
    good = [
        x for x in good
        if not any(held[n][0] != x[0] and held[n][5] < x[5] and x[6] <= held[n][6] for n in at[x[1]])
    ]
    out: list[tuple] = []
    taken: dict[int, tuple] = {}
    for x in sorted(good, key=lambda x: (-x[4], -len(x[6]), x[1], x[0])):
        met = {taken[w][:3] for w in x[6] if w in taken}
        if not any(y[0] != x[0] and 2 * (min(x[2], y[2]) - max(x[1], y[1])) > min(x[2] - x[1], y[2] - y[1]) for y in met):
            out.append(x[:4])
            for w in x[6]:
                taken.setdefault(w, x)
    return out


def notices(
    docs: DataFrame, templates: dict[str, list[str]] | None = None, slack: int = 4, least: float = 0.75, k: int = K
) -> DataFrame:
    """(doc_id, text_key, label, start, end, share): verified spans, in words, end exclusive.

    Matches on diagonals at most ``slack`` apart are chained. ``share`` is the part of the template's words that the
    span's matches cover.
    """
    found = votes(docs, templates, k)
    per_doc = found.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("label", "template", "length", "diagonal", "ts")).alias("votes"))
    types = {f.name: f.dataType.simpleString() for f in per_doc.schema}

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places = [], []
            for n, held in enumerate(batch.column(2).to_pylist()):
                for row in found_spans(held, slack, least, k):
                    rows.append(row)
                    places.append(n)
            at = pa.array(places, pa.int64())
            columns = [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * 4, (pa.string(), pa.int64(), pa.int64(), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *columns], ["doc_id", "text_key", "label", "start", "end", "share"])

    return per_doc.mapInArrow(spans, f"doc_id {types['doc_id']}, text_key {types['text_key']}, label string, start long, end long, share double")


def phrase_places(docs: DataFrame, phrases: dict[str, str] | None = None) -> DataFrame:
    """Per row: doc_id, text_key, n_words and ``places``, the starts of all phrases with their labels."""
    phrases = PHRASES if phrases is None else phrases
    none = F.array().cast("array<struct<start:int,label:string>>")

    def places(w):
        parts = []
        for phrase, label in phrases.items():
            words = phrase.split()
            stands = lambda i, words=words: [F.get(w, i + k) == x for k, x in enumerate(words)]

            def at(i, stands=stands):
                conditions = stands(i)
                whole = conditions[0]
                for c in conditions[1:]:
                    whole = whole & c
                return F.coalesce(whole, F.lit(False))

            starts = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: at(i))  # noqa: B023
            name = F.lit(label)
            parts.append(F.transform(starts, lambda i: F.struct(i.alias("start"), name.alias("label"))))  # noqa: B023
        return F.when(F.size(w) > 0, F.array_sort(F.concat(*parts))).otherwise(none)

    rows = with_key(docs)
    words = split_words(lowered(F.col("text")), NON_ALNUM)
    lasts = sorted({p.split()[-1] for p in phrases})
    may = F.lit(False)
    for last in lasts:
        may = may | F.contains(F.lower("text"), F.lit(last))
    return rows.select(
        "doc_id", "text_key", let(words, lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), F.when(may, places(w)).otherwise(none).alias("places")
        )).alias("x"),
    ).select("doc_id", "text_key", "x.*")


def license_report(docs: DataFrame) -> DataFrame:
    """One row per document: base phrases, labels of both kinds, and a score.

    The score is the best share of a notice that was found, one half at least if a base phrase stands there.
    """
    per_doc = notices(docs).groupBy("doc_id", "text_key").agg(
        F.collect_set("label").alias("found"), F.max("share").alias("share")
    )
    base = phrase_places(docs)
    starts = F.transform("places", lambda p: p["start"].cast("long"))
    own = F.array_distinct(F.transform("places", lambda p: p["label"]))
    found = F.coalesce("found", F.array().cast("array<string>"))
    return base.join(per_doc, same_row(base, per_doc), "left").select(
        base["doc_id"],
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.concat_ws(",", F.array_sort(own)).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(own, found))).alias("labels"),
        F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.size("places") > 0, 0.5).otherwise(0.0)).alias("score"),
    )
