"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Beginnings of longer words count as words of their own, so a stem is learned from all its
forms. Every coordinate has a learning rate of its own and an L1 penalty, so few weights are not
zero and the model is small enough to send to every task. Only a bounded sample of labelled
documents is fitted; every document is scored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opskit.llm.common import first_share, lowered, mix, prefix_hash, range_hash, ranges, remainder, text_bytes, trimmed_words

#: Labelled documents that are fitted, by one task: FTRL-proximal goes through them one by one.
SAMPLE = 10_000
ALPHA, BETA, L1, L2, EPOCHS = 2.0, 1.0, 4.0, 0.0, 6
#: Documents of the sample a feature must occur in to be included.
MIN_DOCUMENTS = 3
#: Bits of the feature space.
BITS = 40
THRESHOLD = 0.7
#: Longest distance inside a pair of words: 1 is a bigram, more are skip-grams.
REACH = 3
#: Bytes of the beginnings of longer words.
BEGINNINGS = (4, 6, 8, 10)
#: Folds of the sample whose margins, scored by a fit of the other folds, calibrate the scores.
FOLDS = 4
#: Margins beyond this count as this.
LIMIT = 35
#: Sorted coordinates, weights, bias, and margins with their probabilities.
Model = tuple[np.ndarray, np.ndarray, float, tuple[np.ndarray, np.ndarray]]


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, owner) of words, their beginnings, bigrams and skip-grams of a few documents."""
    data, offsets = text_bytes(column)
    h, start, end, before = trimmed_words(data, offsets)
    prefix = prefix_hash(lowered(data))
    owner = np.repeat(np.arange(len(before) - 1), np.diff(before))
    found, owners = [mix(h ^ np.uint64(1))], [owner]
    for gap in range(1, REACH + 1):
        a, b = h[:-gap], h[gap:]
        same = owner[:-gap] == owner[gap:]
        found.append(mix((a * np.uint64(3) + b * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(gap))[same])
        owners.append(owner[gap:][same])
    for size in BEGINNINGS:
        longer = np.flatnonzero(end - start > size)
        found.append(mix(range_hash(prefix, start[longer], start[longer] + size) ^ np.uint64(64 + size)))
        owners.append(owner[longer])
    return (np.concatenate(found) >> np.uint64(64 - BITS)).view(np.int64), np.concatenate(owners)


def fit_documents(rows: list[np.ndarray], labels: np.ndarray, alpha=ALPHA, beta=BETA, l1=L1, l2=L2, epochs=EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates, weights, bias) after FTRL-proximal passes over documents given as distinct coordinates."""
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0), 0.0
    known, counts = np.unique(np.concatenate(rows), return_counts=True)
    known = known[counts >= MIN_DOCUMENTS]
    places = []
    for r in rows:
        at = np.searchsorted(known, r)
        at[at == len(known)] = 0
        places.append(at[known[at] == r] if len(known) else at[:0])
    z, n = np.zeros(len(known) + 1), np.zeros(len(known) + 1)  # the last one is the bias, without L1
    last = len(known)
    rng = np.random.default_rng(3)
    for _ in range(epochs):
        for d in rng.permutation(len(rows)):
            at = np.append(places[d], last)
            zi, ni = z[at], n[at]
            shrink = np.sign(zi) * l1
            shrink[-1] = 0
            w = np.where((np.abs(zi) <= l1) & (at != last), 0.0, -(zi - shrink) / ((beta + np.sqrt(ni)) / alpha + l2))
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - labels[d]
            rate = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[at] += g - rate * w
            n[at] += g * g
    shrink = np.sign(z) * l1
    shrink[-1] = 0
    w = -(z - shrink) / ((beta + np.sqrt(n)) / alpha + l2)
    w[:-1][np.abs(z[:-1]) <= l1] = 0
    keep = np.flatnonzero(w[:-1])
    return known[keep], w[keep], float(w[-1])


def margins(rows: list[np.ndarray], model: tuple[np.ndarray, np.ndarray, float]) -> np.ndarray:
    """Bias plus the weights of the distinct coordinates of every document."""
    at, w, bias = model
    out = np.full(len(rows), bias)
    for i, r in enumerate(rows if len(at) else ()):
        place = np.searchsorted(at, r)
        place[place == len(at)] = 0
        out[i] += w[place[at[place] == r]].sum()
    return out


def calibration(x: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(margins, probabilities): an increasing map from margin to the share of ones seen there.

    Isotonic regression (pool adjacent violators) with one pseudo document a pool, interpolated
    between the mean margins of the pools; the sigmoid itself where only one label is known.
    """
    ones = labels.sum()
    if not 0 < ones < len(labels):
        grid = np.linspace(-LIMIT, LIMIT, 8 * LIMIT + 1)
        return grid, 1 / (1 + np.exp(-grid))
    x = np.clip(x, 1 - LIMIT, LIMIT - 1)
    pools: list[tuple[float, float, int]] = []  # sum of margins, ones, documents
    for margin, label in sorted(zip(x.tolist(), labels.tolist())):
        pool = (margin, label, 1)
        while pools and pools[-1][1] * pool[2] >= pool[1] * pools[-1][2]:
            last = pools.pop()
            pool = (last[0] + pool[0], last[1] + pool[1], last[2] + pool[2])
        pools.append(pool)
    at = [-LIMIT, *(m / n for m, _, n in pools), LIMIT]
    share = [0.0, *((y + 0.5) / (n + 1) for _, y, n in pools), 1.0]
    return np.array(at, float), np.maximum.accumulate(share)


def calibrate(rows: list[np.ndarray], labels: np.ndarray, folds: int = FOLDS) -> tuple[np.ndarray, np.ndarray]:
    """The calibration of margins that documents get from fits of the other folds."""
    seen = np.zeros(len(rows))
    fold = np.random.default_rng(5).permutation(len(rows)) % folds
    for f in range(folds):
        rest = np.flatnonzero(fold != f)
        mine = np.flatnonzero(fold == f)
        seen[mine] = margins([rows[i] for i in mine], fit_documents([rows[i] for i in rest], labels[rest]))
    return calibration(seen, labels)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Sparse model (sorted coordinates, weights, bias, calibration).

    The sample is at most ``sample`` labelled ids, chosen by their hash; an id with several labels
    counts as toxic if one says so; null labels and texts teach nothing.
    """
    labelled = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic"))
    chosen = labelled.where(first_share("_id", sample, labelled.count())).orderBy(F.xxhash64("_id"), "_id").limit(sample)  # at most ``sample`` pairs of numbers are broadcast
    rows = docs.where("text is not null").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    rows = rows.select(F.lit(0).alias("all"), "_id", F.col("text").cast("string").alias("text"), "toxic")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_id", "text"])
        bags: list[np.ndarray] = []
        column = pa.array(pdf["text"], pa.large_string())
        _, offsets = text_bytes(column)
        for a, b in ranges(offsets):
            f, owner = features(column.slice(a, b - a))
            order = np.argsort(owner, kind="stable")
            cut = np.searchsorted(owner[order], np.arange(b - a + 1))
            bags += [np.unique(f[order[x:y]]) for x, y in zip(cut[:-1], cut[1:])]
        labels = pdf["toxic"].to_numpy(float)
        at, w, bias = fit_documents(bags, labels)
        margin, share = calibrate(bags, labels)
        kinds = np.repeat(["weight", "bias", "margin", "share"], [len(at), 1, len(margin), len(share)])
        places = np.concatenate((at, [0], np.arange(len(margin)), np.arange(len(share))))
        return pd.DataFrame({"kind": kinds, "at": places, "w": np.concatenate((w, [bias], margin, share))})

    # the features of a bounded sample that survive L1: a few thousand weights, and a pool per document at most
    fitted = rows.groupBy("all").applyInPandas(fit, "kind string, at bigint, w double").orderBy("kind", "at").toPandas()
    part = {kind: fitted[fitted["kind"] == kind] for kind in ("weight", "bias", "margin", "share")}
    known = (part["margin"]["w"].to_numpy(float), part["share"]["w"].to_numpy(float)) if len(fitted) else calibration(np.zeros(0), np.zeros(0))
    return part["weight"]["at"].to_numpy(np.int64), part["weight"]["w"].to_numpy(float), float(part["bias"]["w"].sum()), known


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every document; a null or empty text gets the bias alone."""
    at, w, bias, (knots, shares) = model

    def run(batches):
        for batch in batches:
            text = batch.column(1)
            _, offsets = text_bytes(text)
            out = np.full(len(text), bias)
            for a, b in ranges(offsets):
                f, owner = features(text.slice(a, b - a))
                if len(at) and len(f):
                    place = np.searchsorted(at, f)
                    place[place == len(at)] = 0
                    hit = at[place] == f
                    pair = np.unique(owner[hit] * len(at) + place[hit])  # every feature counts once per document
                    out[a:b] += np.bincount(pair // len(at), w[pair % len(at)], minlength=b - a)
            p = np.interp(out, knots, shares)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id bigint, score double, predicted int")


def held_out_scores(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from labels of rows that are not held out."""
    model = train(docs, labels.where(remainder("doc_id", folds) != fold))
    out = score(docs, model)
    return out.select("doc_id", (remainder("doc_id", folds) == fold).alias("held_out"), "score", "predicted")
