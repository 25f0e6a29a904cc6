"""Licence scan with a positional index of rare words.

Licence texts are filed under their rarest words by inverse document frequency over the whole
corpus, each word with its place in the text. A file's occurrences of those words vote for
places where a licence text may lie; places on which enough rare words agree are compared word
by word, and a licence counts only if its mandatory phrases stand there too. Filing is exact: a
text that agrees with the required share of a licence's weight shares a filed word with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opskit.llm.common import batches_of, lowered, prefix_hash, range_hash, ranges, text_bytes, word_ranges

BATCH_ROWS = 1000
#: Share of a licence text's weight that has to agree, and filed words that vote at least.
SHARE, VOTERS = 0.8, 3

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_EPS = 1e-9


@dataclass(frozen=True)
class Licence:
    label: str
    text: str
    #: Phrases of the text that have to stand at their place; none: the text is a phrase itself.
    phrases: tuple[str, ...] = field(default=())


# fixed values: phrases that name a licence
NAMED = [Licence("mit", "under the MIT License"), Licence("apache-2", "Apache License, Version 2"), Licence("cc-by-nc", "CC BY-NC")]

# fixed values: sentences of public licences
TEXTS = [
    Licence("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            'files (the "Software"), to deal in the Software without restriction', ("deal in the software without restriction",)),
    Licence("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
            ("with or without fee is hereby granted",)),
    Licence("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met", ("in source and binary forms",)),
    Licence("bsd-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
            "derived from this software without specific prior written permission", ("endorse or promote products derived",)),
    Licence("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
            "http://www.apache.org/licenses/LICENSE-2.0", ("apache org licenses license 2 0",)),
    Licence("gpl-2", "licensed under the GNU General Public License, version 2", ("gnu general public license version 2",)),
    Licence("gpl-3", "licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Licence("gpl", "under the terms of the GNU General Public License as published by the Free Software Foundation", ("gnu general public license",)),
    Licence("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
            ("gnu lesser general public license",)),
    Licence("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
            ("gnu affero general public license",)),
    Licence("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license v 2 0",)),
    Licence("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
            ("eclipse public license 2 0",)),
    Licence("bsl-1", "Distributed under the Boost Software License, Version 1.0", ("boost software license version 1 0",)),
    Licence("unlicense", "This is free and unencumbered software released into the public domain", ("released into the public domain",)),
    Licence("cc0", "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication", ("public domain dedication",)),
    Licence("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("commons attribution 4 0 international",)),
    Licence("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
            ("commons attribution sharealike 4 0",)),
    Licence("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
            ("commons attribution noncommercial 4 0",)),
]


# -- words --------------------------------------------------------------------------------


def _hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all documents, and the words before each document."""
    data = lowered(data)
    start, end, before = word_ranges(data, offsets, ~_ALNUM)
    return range_hash(prefix_hash(data), start, end), before


def words_of(text: str) -> list[int]:
    return _hashed(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0].tolist()


def vocabulary(licences: list[Licence]) -> np.ndarray:
    """Sorted hashes of all licence words."""
    return np.unique(np.array([h for lic in licences for h in words_of(lic.text)], np.uint64))


def _numbered(known: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word in the vocabulary (-1: no licence word), and the words before each document."""
    h, before = _hashed(data, offsets)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[at] == h, at, -1), before


def _present(batches: Iterator[pa.RecordBatch], known: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(word, n): in how many documents of the task a licence word stands; word -1 counts documents."""
    found, rows = np.zeros(len(known), np.int64), 0
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        rows += len(offsets) - 1
        for a, b in ranges(offsets):
            word, before = _numbered(known, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            place = np.flatnonzero(word >= 0)
            doc = np.searchsorted(before, place, "right") - 1
            once = np.unique(doc * len(known) + word[place]) % len(known)
            found += np.bincount(once, minlength=len(known))
    yield pa.RecordBatch.from_pydict({"word": pa.array([-1, *range(len(known))], pa.int64()), "n": pa.array([rows, *found.tolist()], pa.int64())})


def weights(docs: DataFrame, known: np.ndarray) -> np.ndarray:
    """Inverse document frequency of every licence word over all documents, always above 0.

    Each task counts its own documents; what is gathered has the size of the vocabulary.
    """
    with batches_of(docs.sparkSession, BATCH_ROWS):
        partial_counts = docs.select("text").mapInArrow(partial(_present, known=known), "word bigint, n bigint")
        counts = {r["word"]: r["n"] for r in partial_counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    n = np.array([counts.get(i, 0) for i in range(len(known))], float)
    return np.log1p((counts.get(-1, 0) + 1) / (n + 1))


# -- the index ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Filed:
    """A licence text with its filed words."""

    label: str
    named: bool
    words: np.ndarray  # vocabulary numbers in order
    weight: np.ndarray  # of every place
    places: np.ndarray  # filed places, rarest word first
    votes: float  # weight that filed places have to agree on
    share: float
    must: np.ndarray  # places of mandatory phrases


def _must(words: list[int], licence: Licence) -> np.ndarray:
    out = []
    for phrase in licence.phrases:
        p = words_of(phrase)
        at = next(i for i in range(len(words)) if words[i : i + len(p)] == p)
        out += range(at, at + len(p))
    return np.array(sorted(set(out)), np.int64) if out else np.arange(len(words))


def build_index(known: np.ndarray, idf: np.ndarray, named: list[Licence], texts: list[Licence]) -> list[Filed]:
    """Each licence under its rarest words.

    Filed are the heaviest places until they outweigh what a match may miss, and at least
    ``VOTERS`` of a text. A match then agrees on filed places of the weight ``votes``.
    """
    index = []
    for licence in [*named, *texts]:
        words = words_of(licence.text)
        number = np.searchsorted(known, np.array(words, np.uint64))
        weight = idf[number]
        share = SHARE if licence.phrases else 1.0
        may_miss = (1 - share) * weight.sum()
        order = np.argsort(-weight, kind="stable")
        enough = int(np.searchsorted(np.cumsum(weight[order]), may_miss + _EPS, "right")) + 1
        places = order[: max(enough, VOTERS if licence.phrases else 1)]
        votes = weight[places].sum() - may_miss - _EPS
        index.append(Filed(licence.label, licence in named, number, weight, places, votes, share, _must(words, licence)))
    return index


def _aligned(filed: Filed, at: dict[int, np.ndarray], word: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places where the licence begins, share of its weight that agrees) in a run of documents."""
    none = np.zeros(0, np.int64)
    starts = [at.get(int(filed.words[p]), none) - p for p in filed.places]
    every = np.concatenate(starts)
    start, who = np.unique(every, return_inverse=True)
    voted = np.bincount(who, np.repeat(filed.weight[filed.places], [len(s) for s in starts]), len(start))
    n = len(filed.words)
    start = start[(voted >= filed.votes) & (start >= 0)]
    end = before[np.searchsorted(before, start, "right")] if len(start) else start
    start = start[start + n <= end]
    same = word[start[:, None] + np.arange(n)] == filed.words
    start, same = start[same[:, filed.must].all(1)], same[same[:, filed.must].all(1)]
    share = (same * filed.weight).sum(1) / filed.weight.sum()
    good = share >= filed.share - _EPS
    return start[good], np.minimum(share[good], 1.0)


MATCH = pa.struct([("label", pa.string()), ("named", pa.bool_()), ("first_word", pa.int64()), ("words", pa.int64()), ("share", pa.float64())])
MATCHES = "array<struct<label: string, named: boolean, first_word: bigint, words: bigint, share: double>>"


def _scan(batches: Iterator[pa.RecordBatch], known: np.ndarray, index: list[Filed]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        counts, matches = [], []
        for a, b in ranges(offsets):
            word, before = _numbered(known, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            counts.append(np.diff(before))
            found: list[list[dict]] = [[] for _ in range(b - a)]
            place = np.flatnonzero(word >= 0)
            place = place[np.argsort(word[place], kind="stable")]
            which, first = np.unique(word[place], return_index=True)
            at = dict(zip(which.tolist(), np.split(place, first[1:]), strict=True)) if len(which) else {}
            for filed in index if at else []:
                start, share = _aligned(filed, at, word, before)
                doc = np.searchsorted(before, start, "right") - 1
                for d, s, x in zip(doc.tolist(), (start - before[doc]).tolist(), share.tolist(), strict=True):
                    found[d].append({"label": filed.label, "named": filed.named, "first_word": s, "words": len(filed.words), "share": x})
            matches += found
        n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(matches, pa.list_(MATCH))], names=["doc_id", "n_words", "matches"])


def scan(docs: DataFrame, named: list[Licence] = NAMED, texts: list[Licence] = TEXTS) -> DataFrame:
    """Rows (doc_id, n_words, matches): where licence phrases and texts stand in each document.

    A match has its label, whether it is a naming phrase, its first word (from 0), its length in
    words and the share of the licence's weight that agrees. Words are runs of digits, letters
    a-z (A-Z lower-cased) and characters beyond ASCII. ``docs`` has doc_id and text; further
    columns are ignored, null text is empty, and every row is scanned for itself, so repeated
    rows and null ids keep their place.
    """
    known = vocabulary([*named, *texts])
    index = build_index(known, weights(docs, known), named, texts)
    kind = docs.schema["doc_id"].dataType.simpleString()
    with batches_of(docs.sparkSession, BATCH_ROWS):
        return docs.select("doc_id", "text").mapInArrow(partial(_scan, known=known, index=index), f"doc_id {kind}, n_words bigint, matches {MATCHES}")


def report(docs: DataFrame) -> DataFrame:
    """Per document: its words, the naming phrases, labels by them and by all matches, best share."""
    base = F.filter("matches", lambda m: m["named"])
    firsts = F.transform(base, lambda m: m["first_word"])
    labels = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["label"]))), ",")
    best = F.array_max(F.transform("matches", lambda m: m["share"]))
    return scan(docs).select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"),
    )
