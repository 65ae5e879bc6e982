"""Licence scans with a positional index of rare template words, in DataFrame functions only.

A first pass counts in how many documents each template word occurs. In the second
one, the rarest words of each template that a document holds are looked up in the
template's postings; each posting votes for the place at which the template would
begin. A template stands at each place with enough votes at which its mandatory key
phrases are found in the words there. Documents without any anchor word (one of each
template's key phrases) cannot hold a template and are not aligned, nor is a
template without all words of its key phrases.

Phrases in ``BASE_PHRASES`` are found at all their places besides, and always give
their label.

Defined cases: null and empty texts have no words and no labels; ties between
places take the first; repeated rows get equal results; without documents there
are no counts and no rows; extra columns pass through, and input columns named like
an added one are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import column, let, others

# Base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Rarest words of each template that vote.
RARE_WORDS = 12
# Words by which a template may be off its place: what was put in or left out.
SLACK = 6
MIN_COVERAGE = 0.5

ADDED = ["n_words", "base_places", "base_labels", "labels", "score"]


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    keys: tuple[str, ...]

    @classmethod
    def of(cls, label: str, text: str, *keys: str) -> Template:
        return cls(label, tuple(text.split()), keys)


# Notices in lower case without punctuation. Key phrases must all stand in the text.
TEMPLATES = (
    Template.of("mit", "released under the mit license", "mit license"),
    Template.of(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software",
        "permission is hereby granted free of charge", "without restriction including without limitation",
    ),
    Template.of("apache", "licensed under the apache license version 2 0", "apache license"),
    Template.of(
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy",
        "apache license", "except in compliance with the license",
    ),
    Template.of("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    Template.of(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "redistribute it and or modify it", "gnu general public license",
    ),
    Template.of(
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
        "gnu lesser general public license",
    ),
    Template.of(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistribution and use in source and binary forms", "with or without modification",
    ),
    Template.of("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template.of(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "permission to use copy modify", "for any purpose with or without fee",
    ),
    Template.of("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    Template.of("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template.of("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template.of("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
)


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    return F.filter(F.split(lowered(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def _strings(values) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def _anchors(templates: tuple[Template, ...]) -> list[str]:
    """A word of each template's key phrases, the longest one of any."""
    return sorted({max((w for k in t.keys for w in k.split()), key=lambda w: (len(w), w)) for t in templates})


def word_counts(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> tuple[dict[str, int], int]:
    """In how many documents each template word occurs, and how many documents there are."""
    vocabulary = sorted({w for t in templates for w in t.words})
    found = docs.select(F.array_intersect(words_of(F.col("text")), _strings(vocabulary)).alias("own"))
    # A row's words count once each; null stands for the row itself.
    rows = found.select(F.explode(F.concat(F.col("own"), F.array(F.lit(None).cast("string")))).alias("word"))
    counts = {r["word"]: r["n"] for r in rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = counts.pop(None, 0)
    return counts, total


_PLACES = "array<struct<start:bigint,label:string>>"


def _phrase(words: Column, ends: Column, before: list[str], label: str) -> Column:
    """(start, label) where the words ``before`` stand in front of one of the places ``ends``."""
    k = len(before)

    def here(i: Column) -> Column:
        ok = i >= k
        for j, w in enumerate(before):
            ok = ok & (F.get(words, i - k + j) == w)
        return ok

    return F.transform(F.filter(ends, here), lambda i: F.struct((i - k).cast("bigint").alias("start"), F.lit(label).alias("label")))


def _places(words: Column, phrases: dict[str, str]) -> Column:
    """(start, label) of all places where a phrase's words stand consecutively, in order of place."""
    found = [F.array().cast(_PLACES)]
    for last in sorted({p.split()[-1] for p in phrases}):
        ends = F.filter(F.transform(words, _numbered(last)), lambda i: i.isNotNull())
        found += [_phrase(words, ends, p.split()[:-1], label) for p, label in phrases.items() if p.split()[-1] == last]
    return F.array_sort(F.concat(*found))


def _numbered(word: str):
    return lambda w, i: F.when(w == word, i)


def _aligned(words: Column, templates: tuple[Template, ...], idf: dict[str, float]) -> Column:
    """(label, coverage) of each template that stands somewhere in the words and has its key phrases there."""
    hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: F.array_contains(_strings(sorted(idf)), h["w"]))

    def standing(hits: Column) -> Column:
        own = F.array_distinct(F.transform(hits, lambda h: h["w"]))
        return let(own, lambda own: F.array(*[_standing(words, hits, own, t, idf) for t in templates]))

    return F.filter(let(hits, standing), lambda x: x["coverage"] >= MIN_COVERAGE)


def _standing(words: Column, hits: Column, own: Column, t: Template, idf: dict[str, float]) -> Column:
    """The template's label, and the largest share of the votes it could have at a place with its key phrases; 0 without any."""
    ranked = sorted(set(t.words), key=lambda w: (-idf[w], w))
    postings = F.create_map(*[x for w in ranked for x in (F.lit(w), F.array(*[F.lit(p) for p, v in enumerate(t.words) if v == w]))])
    key_words = {w for k in t.keys for w in k.split()}

    def votes(rare: Column) -> Column:
        voting = F.filter(hits, lambda h: F.array_contains(rare, h["w"]))
        return F.array_sort(F.flatten(F.transform(voting, lambda h: F.transform(postings[h["w"]], lambda p: h["i"] - p))))

    def keyed(at: Column) -> Column:
        window = F.concat(F.lit(" "), F.array_join(F.slice(words, F.greatest(at - SLACK, F.lit(0)) + 1, len(t.words) + 2 * SLACK), " "), F.lit(" "))
        return let(window, lambda x: F.forall(_strings(t.keys), lambda k: F.contains(x, F.concat(F.lit(" "), k, F.lit(" ")))))

    def best(rare: Column, at: Column) -> Column:
        possible = F.size(F.filter(_strings(t.words), lambda w: F.array_contains(rare, w)))
        firsts = F.filter(F.transform(at, lambda x, i: F.when(~F.get(at, i - 1).eqNullSafe(x), i)), lambda i: i.isNotNull())

        def shares(firsts: Column, possible: Column) -> Column:
            runs = F.transform(firsts, lambda i, k: F.struct(F.get(at, i).alias("at"), ((F.coalesce(F.get(firsts, k + 1), F.size(at)) - i) / possible).alias("share")))
            return F.transform(F.filter(runs, lambda r: (r["share"] >= MIN_COVERAGE) & keyed(r["at"])), lambda r: r["share"])

        return let(possible, lambda n: let(firsts, lambda f: F.array_max(shares(f, n))))

    rare = F.slice(F.array_intersect(_strings(ranked), own), 1, RARE_WORDS)
    there = F.size(F.array_intersect(_strings(sorted(key_words)), own)) == len(key_words)
    coverage = F.when(there, let(rare, lambda r: let(votes(r), lambda at: best(r, at))))
    return F.struct(F.lit(t.label).alias("label"), F.coalesce(coverage, F.lit(0.0)).alias("coverage"))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with n_words, base_places (start, label), base_labels, labels (arrays) and score.

    ``docs`` is read twice. The score is 1 with a base label, else the best coverage.
    """
    counts, total = word_counts(docs, templates)
    vocabulary = {w for t in templates for w in t.words}
    idf = {w: math.log((1 + total) / (1 + counts.get(w, 0))) for w in vocabulary}
    kept = others(docs.select(*map(column, docs.columns if keep is None else keep)), [*ADDED, "__w"])
    based = F.contains(lowered(F.col("text")), F.lit("license"))
    out = docs.select(*map(column, kept), words_of(F.col("text")).alias("__w"), based.alias("__based"))
    out = out.select(
        *map(column, kept),
        F.size("__w").cast("long").alias("n_words"),
        F.when(F.col("__based"), _places(F.col("__w"), BASE_PHRASES)).otherwise(F.array().cast(_PLACES)).alias("base_places"),
        F.when(F.arrays_overlap("__w", _strings(_anchors(templates))), _aligned(F.col("__w"), templates, idf)).otherwise(F.array().cast("array<struct<label:string,coverage:double>>")).alias("__found"),
    )
    labels = lambda c: F.transform(F.col(c), lambda x: x["label"])
    return out.select(
        *map(column, kept),
        "n_words",
        "base_places",
        F.array_sort(F.array_distinct(labels("base_places"))).alias("base_labels"),
        F.array_sort(F.array_union(labels("base_places"), labels("__found"))).alias("labels"),
        F.when(F.size("base_places") > 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("__found", lambda x: x["coverage"])), F.lit(0.0)))).alias("score"),
    )
