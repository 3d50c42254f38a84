"""License scan with a positional index of rare words.

Templates are short runs of words. The index maps a word to its postings: the templates that hold
it, and where. A text looks up its rarest license words (highest IDF over the scanned documents)
only; each posting names a place where the template would have to start, and the postings of the
template's other words, rarest first, are intersected at that relative position until the place
can no longer reach the template's share of IDF weight. What is left must hold the template's key
phrase word by word.

The words looked up are as many of a template's rarest as weigh more than what it may lack, so that
every place that reaches the share holds one of them: nothing is missed, however often it occurs."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pieces, text_bytes, whole_text, widened, words

# The base phrases and their labels
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

# Label, words of the text before the key phrase, key phrase, words after it
TEMPLATES = (
    ("agpl", "gnu", "affero general public license", ""),
    ("apache", "licensed under the", "apache license version 2", "0"),
    ("apache", "you may not use this file", "except in compliance with the license", "you may obtain a copy of the license at"),
    ("boost", "", "boost software license", "version 1 0"),
    ("bsd", "", "redistribution and use in source and binary forms",
     "with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a", "creative commons attribution", "4 0 international license"),
    ("cc-by-nc", "licensed under", "cc by nc", "4 0"),
    ("epl", "terms of the", "eclipse public license", "v 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the",
     "gnu general public license", "as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software", "for any purpose with or without fee",
     "is hereby granted"),
    ("lgpl", "gnu", "lesser general public license", ""),
    ("mit", "", "permission is hereby granted free of charge",
     "to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the", "mozilla public license", "v 2 0"),
    ("unlicense", "this is", "free and unencumbered software", "released into the public domain"),
    ("zlib", "this software is provided as is", "without any express or implied warranty",
     "in no event will the authors be held liable for any damages arising from the use of this software"),
)

SHARE = 80  # hundredths of a template's IDF weight that a place must hold; a base phrase is held whole
PIECE_BYTES = 1 << 20


@dataclass(frozen=True)
class Template:
    label: str
    base: bool
    words: tuple[str, ...]
    key: range  # places of the key phrase

    @property
    def share(self) -> int:
        return 100 if self.base else SHARE


def templates() -> list[Template]:
    found = [Template(label, True, tuple(p.split()), range(len(p.split()))) for label, p in PHRASES]
    for label, before, key, after in TEMPLATES:
        first, length = len(before.split()), len(key.split())
        whole = tuple(f"{before} {key} {after}".split())
        found.append(Template(label, False, whole, range(first, first + length)))
    return found


def vocabulary() -> list[str]:
    return sorted({w for t in templates() for w in t.words})


def numbers_of(h: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The vocabulary number of each hashed word, -1 for all others."""
    hashes, numbers = known
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    return np.where(hashes[at] == h, numbers[at], -1)


def known_words() -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the vocabulary in order, and the number of each."""
    h = words(*text_bytes(pa.array([" ".join(vocabulary())])))[0]
    order = np.argsort(h)
    return h[order], order


def document_counts(docs: DataFrame) -> tuple[int, np.ndarray]:
    """The number of documents, and of those that hold each word of the vocabulary; one row per
    word of the templates reaches the driver."""
    size = len(vocabulary())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, rows = known_words(), np.zeros(size, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for piece in pieces(batch, "text", PIECE_BYTES):
                h, _, _, text = words(*text_bytes(piece.column("text")))
                number = numbers_of(h, known)
                met = number >= 0
                once = np.unique(text[met] * size + number[met])
                total += np.bincount(once % size, minlength=size)
        out = {"word": np.append(np.arange(size), -1), "docs": np.append(total, rows)}
        yield pa.RecordBatch.from_pydict(out)

    found = docs.select("text").mapInArrow(count, "word bigint, docs bigint")
    sums = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.sum("docs").alias("n")).collect()}
    return sums.get(-1, 0), np.array([sums.get(i, 0) for i in range(size)])


def weights(total: int, held: np.ndarray) -> np.ndarray:
    """IDF in whole thousandths, so that sums are exact."""
    return np.round(1000 * (1 + np.log((1 + total) / (1 + held)))).astype(np.int64)


@dataclass(frozen=True)
class Posting:
    """A template as the index holds it: its words by falling weight, and how many are looked up."""

    words: np.ndarray  # vocabulary numbers
    places: np.ndarray
    weights: np.ndarray
    keys: np.ndarray  # whether a word is part of the key phrase
    looked_up: int
    share: int


def postings(weight: np.ndarray) -> list[Posting]:
    number = {w: i for i, w in enumerate(vocabulary())}
    found = []
    for t in templates():
        own = np.array([number[w] for w in t.words])
        order = np.argsort(-weight[own], kind="stable")
        by_weight = weight[own][order]
        may_lack = by_weight.sum() * (100 - t.share)
        looked_up = int(np.searchsorted(np.cumsum(by_weight) * 100, may_lack, side="right")) + 1
        keys = np.isin(order, np.array(t.key))
        found.append(Posting(own[order], order, by_weight, keys, looked_up, t.share))
    return found


def places(posting: Posting, by_word: dict[int, np.ndarray], number: np.ndarray, text: np.ndarray):
    """Texts, first words (of all words) and weights found of one template's places."""
    none = np.zeros(0, np.int64)
    seeds = [
        (at, at - place)
        for word, place in zip(posting.words[: posting.looked_up], posting.places, strict=False)
        if len(at := by_word.get(int(word), none))
    ]
    if not seeds:
        return none, none, none
    # a place may begin before its text: the text is that of the word found
    found = np.unique(np.array([text[np.concatenate([s[0] for s in seeds])], np.concatenate([s[1] for s in seeds])]), axis=1)
    own, start = found
    got, keys = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
    total = left = int(posting.weights.sum())
    for word, place, weight, key in zip(posting.words, posting.places, posting.weights, posting.keys, strict=True):
        at = start + place
        inside = (at >= 0) & (at < len(number))
        at = np.where(inside, at, 0)
        same = inside & (text[at] == own) & (number[at] == word)
        got += weight * same
        keys += same & key
        left -= int(weight)
        kept = (got + left) * 100 >= posting.share * total
        own, start, got, keys = own[kept], start[kept], got[kept], keys[kept]
    whole = keys == posting.keys.sum()
    return own[whole], start[whole], got[whole]


MATCHES = "array<struct<template: int, start: bigint, share: double>>"


def scanned(docs: DataFrame) -> DataFrame:
    """`docs` with `n_words` and `matches`: for each place of a template its number in `templates()`,
    the word it starts at (from 0; below 0 where a text begins inside a template) and the share of
    its IDF weight. Columns of these names are replaced, all others kept.

    A null or empty text has no words and no matches. Rows are scanned one by one, so repeated rows
    have equal results, and places that tie are all given. IDF is that of the rows of `docs`; an
    empty table gives an empty table. Words are compared by 64-bit hashes."""
    weight = weights(*document_counts(docs))
    rows = docs.drop("n_words", "matches")
    text_at = rows.columns.index("text")
    schema = widened(rows, n_words="bigint", matches=MATCHES)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, index = known_words(), postings(weight)
        sought = np.zeros(len(weight) + 1, bool)  # the last is for words out of the vocabulary
        for posting in index:
            sought[posting.words[: posting.looked_up]] = True
        for batch in batches:
            for piece in pieces(batch, "text", PIECE_BYTES):
                h, _, _, text = words(*text_bytes(piece.column(text_at)))
                number = numbers_of(h, known)
                counts = np.bincount(text, minlength=piece.num_rows)
                first = np.cumsum(counts) - counts
                at = np.flatnonzero(sought[number])
                order = np.argsort(number[at], kind="stable")
                met, cuts = np.unique(number[at][order], return_index=True)
                by_word = dict(zip(met.tolist(), np.split(at[order], cuts[1:]), strict=True)) if len(at) else {}
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(counts, pa.int64()), listed(index, by_word, number, text, first)],
                    schema.fieldNames())

    return rows.mapInArrow(scan, schema)


def listed(index, by_word, number, text, first) -> pa.Array:
    """The matches of every text of a piece, by start and then by template."""
    found = [[np.zeros(0, np.int64)] * 3 + [np.zeros(0)]]
    for i, posting in enumerate(index):
        own, start, got = places(posting, by_word, number, text)
        found.append([own, np.full(len(own), i), start - first[own], got / posting.weights.sum()])
    own, template, start, share = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((template, start, own))
    ends = np.searchsorted(own[order], np.arange(len(first) + 1))
    values = pa.StructArray.from_arrays(
        [pa.array(template[order], pa.int32()), pa.array(start[order], pa.int64()), pa.array(share[order], pa.float64())],
        ["template", "start", "share"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.
    `score` is the largest share of a template at any place, 0 without a match."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    base = sum(t.base for t in templates())
    label = F.array(*(F.lit(t.label) for t in templates()))

    def names(matches):
        each = F.transform(matches, lambda m: F.get(label, m["template"]))
        return F.array_join(F.array_sort(F.array_distinct(each)), ",")

    found = scanned(rows).drop("text").withColumn("base", F.filter("matches", lambda m: m["template"] < base))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base.start").alias("first_word"), F.array_max("base.start").alias("last_word"),
        names(F.col("base")).alias("base_labels"), names(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max("matches.share"), F.lit(0.0)).alias("score"))
