"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram vector binds (multiplies) the vectors
of its letters, each permuted (rolled) by its place; a document bundles (adds) its n-gram
vectors, and a language prototype bundles the unit vectors of its documents. A document gets
the language whose prototype has the highest cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from opskit.llm.common import first_share, remainder

DIMENSIONS = 1024
N = 3
#: Documents per language that prototypes are bundled from; the fit is bounded by this.
SAMPLE = 1_000
#: Languages whose prototypes are broadcast: 2,000 * 1,024 floats are 8 MB.
LANGUAGES = 2_000
#: A best cosine below this resembles no learned language.
REJECT = 0.05
#: Code points worked on at once.
CHUNK = 1 << 20
#: N-grams whose vectors are held at once, and documents whose counts of them are: 2,048 vectors are 8 MB.
BLOCK = 2048
#: Letter vectors a task remembers (1 KB each); others are drawn again.
REMEMBERED = 1 << 14

_LETTERS: list[np.ndarray] = []
_VECTORS: dict[tuple[int, int], np.ndarray] = {}


def _letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _letter_vector(code: int, dimensions: int) -> np.ndarray:
    key = (code, dimensions)
    if key in _VECTORS:
        return _VECTORS[key]
    vector = (np.random.default_rng([7, code]).integers(0, 2, dimensions) * 2 - 1).astype(np.int8)
    if len(_VECTORS) < REMEMBERED:
        _VECTORS[key] = vector
    return vector


def _chunks(texts: list[str]):
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= CHUNK):
            size += len(texts[end])
            end += 1
        yield texts[at:end]
        at = end


def document_vectors(texts: list[str], dimensions: int = DIMENSIONS, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of length 1 or 0, whether a text has a letter) of a few texts.

    Letters are lower-cased; every run of other characters counts as one gap. Counts enter
    as square roots, so one repeated phrase does not decide.
    """
    joined = "".join(f"\0{t.replace(chr(0), ' ')}\0" for t in texts).lower()  # a gap before and after every document
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    bounds = codes == 0
    letter = _letters()[codes] & ~bounds
    codes = np.where(letter, codes, 0)
    keep = letter | bounds
    keep[1:] |= letter[:-1]  # the first character of a gap stays
    doc = (np.cumsum(bounds) - 1) // 2
    has = np.bincount(doc[letter], minlength=len(texts)) > 0 if len(codes) else np.zeros(len(texts), bool)
    codes, doc = codes[keep], doc[keep]
    out = np.zeros((len(texts), dimensions), np.float32)
    if len(codes) < n:
        return out, has
    alphabet, small = np.unique(codes, return_inverse=True)
    grams = np.zeros(len(codes) - n + 1, np.int64)
    solid = np.zeros(len(grams), np.int64)
    for k in range(n):
        part = small[k : len(small) - n + 1 + k]
        grams = grams * len(alphabet) + part
        solid += codes[k : len(codes) - n + 1 + k] > 0
    good = (solid >= min(2, n)) & (doc[: len(grams)] == doc[n - 1 :])
    grams, owner = grams[good], doc[: len(good)][good]
    if not len(grams):
        return out, has
    used, place = np.unique(grams, return_inverse=True)
    pair, count = np.unique(place * len(texts) + owner, return_counts=True)  # by n-gram, then document
    gram, owner, weight = pair // len(texts), pair % len(texts), np.sqrt(count).astype(np.float32)
    for a in range(0, len(used), BLOCK):
        some = used[a : a + BLOCK]
        bound = np.ones((len(some), dimensions), np.float32)
        for k in range(n):
            own, at = np.unique(some // len(alphabet) ** (n - 1 - k) % len(alphabet), return_inverse=True)
            letters = np.stack([_letter_vector(c, dimensions) for c in alphabet[own].tolist()])
            bound *= np.roll(letters, n - 1 - k, axis=1)[at]
        lo, hi = np.searchsorted(gram, (a, a + BLOCK))
        docs, row = np.unique(owner[lo:hi], return_inverse=True)
        for x in range(0, len(docs), BLOCK):
            mine = np.flatnonzero((row >= x) & (row < x + BLOCK))
            counts = np.zeros((min(BLOCK, len(docs) - x), len(some)), np.float32)
            counts[row[mine] - x, gram[lo:hi][mine] - a] = weight[lo:hi][mine]
            out[docs[x : x + BLOCK]] += counts @ bound
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1), has


def prototypes(docs: DataFrame, sample: int = SAMPLE, dimensions: int = DIMENSIONS, n: int = N) -> dict[str, list[float]]:
    """Language -> prototype, bundled from at most ``sample`` documents per language.

    The sample is chosen by a hash of id and text, so rows that share an id, or have none, are
    drawn one by one. Null or letterless texts and null languages teach nothing. More than
    ``LANGUAGES`` languages raise an error, as their prototypes are broadcast.
    """
    first = W.partitionBy("lang").orderBy(F.xxhash64("doc_id", "text"), "doc_id")
    known = docs.where("lang is not null and text is not null").select("doc_id", "lang", F.col("text").cast("string").alias("text"))
    sizes = known.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_n"))
    sizes = sizes.sparkSession.createDataFrame(sizes.limit(LANGUAGES + 1).collect(), "_lang string, _n bigint")
    if sizes.count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages: raise LANGUAGES if their prototypes may be broadcast")
    # about twice the sample of each language is gathered, whatever its share of all rows
    some = known.join(F.broadcast(sizes), F.col("lang") == F.col("_lang")).where(first_share(F.xxhash64("doc_id", "text"), sample, F.col("_n")))
    ids = some.select("lang", "doc_id", "text").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= sample)

    def bundle(batches):
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            for some in _chunks(texts):
                vectors, _ = document_vectors(some, dimensions, n)
                for lang, v in zip(langs[at : at + len(some)], vectors):
                    sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
                at += len(some)
            for lang, v in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * dimensions, pa.string()), pa.array(range(dimensions), pa.int32()), pa.array(v)], ["lang", "at", "v"])

    parts = ids.select("lang", "text").mapInArrow(bundle, "lang string, at int, v double")
    rows = parts.groupBy("lang", "at").agg(F.sum("v").alias("v")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("vs"))
    return {r.lang: [x.v for x in r.vs] for r in rows.collect()}


def identify(docs: DataFrame, profiles: dict[str, list[float]], n: int = N) -> DataFrame:
    """All columns of ``docs`` plus lang_pred and score (the best cosine, 0 at least).

    A null text or one without a letter is ``und`` with score 0, as is every text when
    nothing was learned. Ties go to the first language by name.
    """
    names = sorted(profiles)
    dimensions = len(profiles[names[0]]) if names else DIMENSIONS
    matrix = np.array([profiles[x] for x in names], np.float32).reshape(len(names), dimensions)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(at), "").to_pylist()
            best, score = [], []
            for some in _chunks(texts):
                vectors, has = document_vectors(some, dimensions, n)
                if not names:
                    best += ["und"] * len(some)
                    score += [0.0] * len(some)
                    continue
                like = vectors @ matrix.T
                top = like.argmax(axis=1)
                best += [names[t] if h else "und" for t, h in zip(top, has)]
                score += [float(min(1.0, max(0.0, x[t]))) if h else 0.0 for t, h, x in zip(top, has, like)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(score, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), "lang_pred string", "score double"])
    return docs.mapInArrow(run, schema)


def held_out_predictions(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    base = docs.select("doc_id", "lang", F.col("text").cast("string").alias("text"))
    profiles = prototypes(base.where(remainder("doc_id", folds) != fold))
    out = identify(base.select("doc_id", "text"), profiles)
    return out.select("doc_id", (remainder("doc_id", folds) == fold).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, reject: float = REJECT, folds: int = 4, fold: int = 2) -> DataFrame:
    """The rows of ``docs`` whose language is recognised: not ``und``, cosine at least ``reject``."""
    profiles = prototypes(docs.where(remainder("doc_id", folds) != fold))
    names = [f"c{i}" for i in range(len(docs.columns))]  # free of clashes with the new columns
    plain = docs.toDF(*["text" if c == "text" else x for c, x in zip(docs.columns, names)])
    kept = identify(plain, profiles).where(f"lang_pred <> 'und' and score >= {reject}").drop("lang_pred", "score")
    return kept.toDF(*docs.columns)
