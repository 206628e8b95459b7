"""License scan: exact set-similarity join of text blocks with license templates.

A window is twice a template's words long and may start at every word of a document. It matches
when it holds at least ``LEAST`` of the template's distinct words. Of each run of matching starts
those at multiples of the template's length are reported, and the first of the fullest windows where
none of these is as full, so labels and scores do not depend on where a notice stands.

Words are ordered by how often they occur in all documents, rarest first. Only templates with a word
of their prefix (their ``distinct - needed + 1`` rarest words) and enough words in the document are
looked at; their windows are counted by stepping from one template word that comes or goes to the
next. The filters lose no match.

Frequencies come from one pass over all texts, matches from a second; neither moves a text. What
travels to the tasks are the templates and the counts of their words, a fixed size.

Beside it stand the places of the three plain phrases, word by word.

Defined cases: a null text is empty; an empty text has no words and no labels; repeated rows are
reported each; null ids are carried; an empty table gives an empty result; other columns are never
read.
"""

from __future__ import annotations

from collections import Counter
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.common import as_array, table

LEAST = 0.9
# The phrases of the base labels, and the notices by which licenses are usually stated.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is "
               "distributed on an as is basis without warranties or conditions of any kind"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "this work has been dedicated to the public domain under cc0 1 0 universal"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

#: A-Z become a-z; ASCII that is no letter or digit becomes a space; bytes of other characters stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
_PHRASES = {tuple(p.encode().split()): label for p, label in PHRASES.items()}
SCHEMA = (
    "doc_id {id}, n_words long, base array<struct<label:string,start:long>>, "
    "matches array<struct<template:int,label:string,start:long,words:int,containment:double>>"
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def base_places(words: list[bytes], at: list[int]) -> list[tuple[str, int]]:
    """(label, first word) of every phrase; ``at``: places of words that phrases end with."""
    out = []
    for i in at:
        for phrase, label in _PHRASES.items():
            start = i + 1 - len(phrase)
            if start >= 0 and tuple(words[start : i + 1]) == phrase:
                out.append((label, start))
    return sorted(out, key=lambda x: (x[1], x[0]))


class Templates:
    """Templates in the global order, with their prefixes."""

    def __init__(self, counts: dict[bytes, int], templates=TEMPLATES, least: float = LEAST) -> None:
        self.labels = [label for label, _ in templates]
        self.lengths = [len(text.encode().split()) for _, text in templates]
        sets = [set(text.encode().split()) for _, text in templates]
        order = sorted(set().union(*sets), key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.sorted = [sorted(self.rank[w] for w in s) for s in sets]
        self.needed = [ceil(least * len(s) - 1e-9) for s in sets]
        self.prefixes: dict[int, list[tuple[int, int]]] = {}
        for t, ranks in enumerate(self.sorted):
            for place, r in enumerate(ranks[: len(ranks) - self.needed[t] + 1]):
                self.prefixes.setdefault(r, []).append((t, place))
        self.sets = [set(x) for x in self.sorted]

    def blocks(self, hits: list[tuple[int, int]], n_words: int) -> list[tuple]:
        """Matches among the (place, rank) of template words, in order of place."""
        seen = {r for _, r in hits}
        out = []
        for t in {t for r in seen for t, _ in self.prefixes.get(r, ())}:
            if len(self.sets[t] & seen) < self.needed[t]:
                continue
            length, ranks = self.lengths[t], self.sets[t]
            for run in self._runs(t, [hit for hit in hits if hit[1] in ranks]):
                best = max(common for _, _, common in run)
                found = [(start, common) for first, end, common in run for start in range(-(-first // length) * length, end, length)]
                if all(common < best for _, common in found):
                    found.append((next(first for first, _, common in run if common == best), best))
                out += [(t, self.labels[t], start, min(n_words, start + 2 * length) - start, common / len(ranks)) for start, common in found]
        return sorted(out, key=lambda x: (x[2], x[0]))

    def _runs(self, t: int, hits: list[tuple[int, int]]) -> list[list[tuple[int, int, int]]]:
        """Runs of starts whose windows match: (first start, end of starts, distinct words) of equal windows, in order."""
        size, need = 2 * self.lengths[t], self.needed[t]
        runs: list[list[tuple[int, int, int]]] = []
        held: Counter = Counter()
        comes = goes = at = 0
        while goes < len(hits):
            # The window at ``at`` holds hits[goes:comes]; it stays so until a hit comes or goes.
            while comes < len(hits) and hits[comes][0] < at + size:
                held[hits[comes][1]] += 1
                comes += 1
            while goes < comes and hits[goes][0] < at:
                r = hits[goes][1]
                held[r] -= 1
                if not held[r]:
                    del held[r]
                goes += 1
            if goes == len(hits):
                break
            end = hits[goes][0] + 1 if goes < comes else hits[comes][0] - size + 1
            if comes < len(hits):
                end = min(end, hits[comes][0] - size + 1)
            if len(held) >= need:
                if runs and runs[-1][-1][1] == at:
                    runs[-1].append((at, end, len(held)))
                else:
                    runs.append([(at, end, len(held))])
            at = end
        return runs


def word_counts(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """How often each word of ``vocabulary`` occurs in all texts."""
    def of(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in as_array(batch.column(0)).cast(pa.binary()).to_pylist():
                counts.update(filter(vocabulary.__contains__, words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    rows = docs.select("text").mapInArrow(of, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r.word): r.n for r in rows}


def scan(docs: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, base phrase places, matching blocks."""
    vocabulary = frozenset(w for _, text in templates for w in text.encode().split())
    known = Templates(word_counts(docs, vocabulary), templates, least)
    ends = frozenset(p[-1] for p in _PHRASES)

    def of(batches):
        rank = known.rank
        for batch in batches:
            sizes, bases, matches = [], [], []
            for text in as_array(batch.column(1)).cast(pa.binary()).to_pylist():
                words = words_of(text)
                sizes.append(len(words))
                hits = [(i, rank[w]) for i, w in enumerate(words) if w in rank]
                some = any(r in known.prefixes for _, r in hits)
                matches.append(known.blocks(hits, len(words)) if some else [])
                bases.append(base_places(words, [i for i, w in enumerate(words) if w in ends]))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()),
                pa.array([[{"label": a, "start": b} for a, b in x] for x in bases], pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))),
                pa.array(
                    [[dict(zip(("template", "label", "start", "words", "containment"), m, strict=True)) for m in x] for x in matches],
                    pa.list_(pa.struct([("template", pa.int32()), ("label", pa.string()), ("start", pa.int64()), ("words", pa.int32()), ("containment", pa.float64())])),
                ),
            ], ["doc_id", "n_words", "base", "matches"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(of, SCHEMA.format(id=kind))


def op7_licenses(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    labels = F.concat(F.col("base.label"), F.col("matches.label"))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"), F.array_max("base.start").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max("matches.containment"), F.lit(0.0))).alias("score"),
    )
