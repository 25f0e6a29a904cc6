"""Personal data, and information-theoretic sanitisation of the terms that reveal it.

Patterns find e-mail addresses, IP addresses, card and phone numbers: the protected entities.
The corpus tells how strongly a term reveals an entity: with the information content
IC(c) = -log2 P(c) and the pointwise mutual information PMI(c; t) = log2 P(c, t) / (P(c) P(t)),
a term discloses the share PMI / IC of the entity, 1 where it never occurs without it. Terms
above one threshold are generalised, above a higher one removed.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from opskit.llm.common import durable, ranges, text_bytes, trimmed_words

KINDS = ("email", "ip", "card", "phone", "generalised", "removed")
#: Words on either side of an entity that count as occurring together with it.
WINDOW = 12
#: Different contexts an entity and a term must share; copies of one passage are one context. An
#: entity with two contexts must share both: a term next to one context only is not rated, as every
#: word that occurs once would reveal what stands beside it.
MIN_CONTEXTS = 3
GENERALISE, REMOVE = 0.7, 0.9
#: Bytes of the shortest word that is a term without a capital, digit or letter beyond ASCII.
MIN_BYTES = 4
#: Bits of the filter of candidate terms that every task gets (128 KB); an exact join follows it.
FILTER_BITS = 1 << 20

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str):
    """Leftmost matches, found from the @ signs so that long words cost no more than their length."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        done = max(done, at + 1)
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and then kind; matches that fail a test are dropped."""
    found = [(a, b, "email") for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in m[0].split(".")):
                found.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((*m.span(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append((*m.span(), "phone"))
    found.sort(key=lambda x: (x[0], KINDS.index(x[2])))
    return found


def _hash64(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _joined(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _is_term(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Words with a letter or digit (any byte beyond ASCII counts as one) that are long enough or look like a name or number."""
    low = data | 0x20
    digit = (data >= 48) & (data <= 57)
    marked = digit | (data >= 128) | ((data >= 65) & (data <= 90))
    solid = marked | ((low >= 97) & (low <= 122))
    has = lambda x: (n := np.concatenate(([0], np.cumsum(x))))[end] > n[start]
    return has(marked) | (has(solid) & (end - start >= MIN_BYTES))


_COLUMNS = ["doc_id", "_text", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "found", "entity", "term", "context"]
SCAN = "doc_id bigint, _text bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, found array<struct<start:int,end:int,kind:string>>, entity array<bigint>, term array<bigint>, context array<bigint>"


def _scan(batches):
    """Base spans of every document, and the terms around each entity."""
    for batch in batches:
        texts = [t or "" for t in batch.column(2).to_pylist()]
        out = []
        for doc_id, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            spans = base_spans(text)
            counts = [sum(kind == k for _, _, kind in spans) for k in KINDS[:4]]
            digest = hashlib.sha256(_joined(spans).encode()).hexdigest()
            near = ([], [], [])
            if spans:
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                h, start, end, _ = trimmed_words(data, np.array([0, len(data)]))
                term = _is_term(data, start, end)
                at = lambda i: i if len(data) == len(text) else len(text[:i].encode("utf-8", "surrogatepass"))  # noqa: B023, E731
                places = [(at(a), at(b)) for a, b, _ in spans]
                for a, b in places:
                    lo, hi = np.searchsorted(end, a, "right"), np.searchsorted(start, b)
                    term[lo:hi] = False
                for (a, b, kind), (x, y) in zip(spans, places):
                    lo, hi = int(np.searchsorted(end, x, "right")), int(np.searchsorted(start, y))
                    before, after = h[max(0, lo - WINDOW) : lo], h[hi : hi + WINDOW]
                    context = _hash64(np.concatenate((before[-4:], after[:4])).tobytes().hex())
                    entity = _hash64(f"{kind}:{text[a:b].lower()}")
                    around = np.concatenate((before[term[max(0, lo - WINDOW) : lo]], after[term[hi : hi + WINDOW]]))
                    for t in np.unique(around).view(np.int64).tolist():
                        for column, value in zip(near, (entity, t, context)):
                            column.append(value)
                    # the entity itself, to count its contexts
                    for column, value in zip(near, (entity, 0, context)):
                        column.append(value)
            out.append((doc_id, key, *counts, digest, [{"start": a, "end": b, "kind": k} for a, b, k in spans], *near))
        columns = list(zip(*out)) if out else [[]] * 11
        kinds = [*[pa.int64()] * 6, pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])), *[pa.list_(pa.int64())] * 3]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], _COLUMNS)


def _occurrences(bits: np.ndarray, once: bool = False):
    """(doc_id, _text, term, start, end) of the words whose hash is in the filter; code points. ``once``: one per document."""

    def run(batches):
        for batch in batches:
            text = batch.column(2)
            data, offsets = text_bytes(text)
            for a, b in ranges(offsets):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                h, start, end, before = trimmed_words(part, at)
                hit = np.flatnonzero(bits[(h % np.uint64(FILTER_BITS)).astype(np.int64)])
                doc = np.searchsorted(before, hit, "right") - 1
                if once:
                    order = np.lexsort((h[hit], doc))
                    hit, doc = hit[order], doc[order]
                    new = np.ones(len(hit), bool)
                    new[1:] = (h[hit[1:]] != h[hit[:-1]]) | (doc[1:] != doc[:-1])
                    hit, doc = hit[new], doc[new]
                points = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))  # code points before each byte
                first = points[at[doc]]
                rows = pa.array(a + doc)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(h[hit].view(np.int64)), pa.array((points[start[hit]] - first).astype(np.int32)), pa.array((points[end[hit]] - first).astype(np.int32))],
                    ["doc_id", "_text", "term", "start", "end"],
                )

    return run


def _plain(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("_text"), text.alias("text"))


def disclosing_terms(scanned: DataFrame, plain: DataFrame, generalise: float, remove: float, min_contexts: int) -> tuple[DataFrame, DataFrame]:
    """(term, kind) of the disclosing terms and (doc_id, _text, term, start, end) of their candidates.

    Probabilities are over different texts: exact copies count once, and an entity and a term
    count once per context, so a passage that is copied reveals nothing by its copies.
    """
    spark = plain.sparkSession
    triples = scanned.where("size(entity) > 0").select(F.explode(F.arrays_zip("entity", "term", "context")).alias("x")).select("x.*").distinct()
    shared = durable(triples.groupBy("entity", "term").agg(F.count("*").alias("both")).where(F.col("both") >= min(2, min_contexts)))
    entities = shared.where("term = 0").select("entity", F.col("both").alias("n_entity"))
    enough = F.col("both") >= F.least(F.lit(min_contexts), F.col("n_entity"))
    candidates = durable(shared.where("term <> 0").join(entities, "entity").where(enough))
    bits = np.zeros(FILTER_BITS, bool)
    # at most FILTER_BITS numbers, however many candidates there are
    filled = candidates.select(F.expr(f"term & {FILTER_BITS - 1}").cast("int").alias("bit")).distinct().toPandas()["bit"].to_numpy()
    bits[filled] = True
    places = "doc_id bigint, _text bigint, term bigint, start int, end int"
    if not len(filled):
        return spark.createDataFrame([], "term bigint, kind string"), spark.createDataFrame([], places)
    # a term whose texts are far more than a disclosing share allows is not written word by word;
    # twice the bound and more is far outside the error of the estimate
    total = plain.select("_text").distinct().count()
    seen = plain.mapInArrow(_occurrences(bits, once=True), places).groupBy("term").agg(F.approx_count_distinct("_text", 0.03).alias("seen"))
    most = F.max(F.least("both", "n_entity") * F.pow(F.lit(float(max(1, total))) / F.col("n_entity"), F.lit(1.0 - min(generalise, remove))))
    terms = durable(candidates.groupBy("term").agg(most.alias("most")).join(seen, "term").where("seen <= 2 * most + 10").select("term"))
    bits = np.zeros(FILTER_BITS, bool)
    # at most FILTER_BITS numbers again
    bits[terms.select(F.expr(f"term & {FILTER_BITS - 1}").cast("int").alias("bit")).distinct().toPandas()["bit"].to_numpy()] = True
    found = durable(plain.mapInArrow(_occurrences(bits), places).join(terms, "term", "left_semi").select("doc_id", "_text", "term", "start", "end"))
    n_term = found.select("term", "_text").distinct().groupBy("term").agg(F.count("*").alias("n_term"))
    total = F.lit(total)
    ic = -F.log2(F.col("n_entity") / total)
    joint = F.least("both", "n_term", "n_entity")
    share = F.when(ic > 0, F.log2(joint * total / (F.col("n_entity") * F.col("n_term"))) / ic).otherwise(0.0)
    rated = candidates.join(n_term, "term").groupBy("term").agg(F.max(share).alias("share"))
    kind = F.when(F.col("share") >= remove, "removed").when(F.col("share") >= generalise, "generalised")
    return durable(rated.select("term", kind.alias("kind")).where("kind is not null")), found


def _as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """Per document: doc_id, _text (hash of its text), n_email, n_ip, n_card, n_phone, base_sha256,
    spans (array of start, end, kind, in order), span_text.

    A null text counts as empty. Term spans that touch a base span are left out. Rows alike in
    id and text get the same spans; extra columns are ignored.
    """
    plain = _plain(docs)
    scanned = durable(plain.mapInArrow(_scan, SCAN))
    terms, places = disclosing_terms(scanned, plain, generalise, remove, min_contexts)
    hits = places.join(terms, "term").select("doc_id", "_text", F.struct("start", "end", "kind").alias("s")).distinct()
    # at most one span per word of the document
    more = hits.groupBy(F.col("doc_id").alias("_d"), F.col("_text").alias("_t")).agg(F.collect_list("s").alias("more"))
    rows = scanned.join(more, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_text") == F.col("_t")), "left")
    free = F.filter("more", lambda s: ~F.exists("found", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    rank = lambda k: F.array_position(F.array(*[F.lit(x) for x in KINDS]), k)
    keyed = F.transform(F.concat("found", F.coalesce(free, F.array().cast("array<struct<start:int,end:int,kind:string>>"))), lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    spans = F.transform(F.sort_array(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return rows.select("doc_id", "_text", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans.alias("spans")).withColumn("span_text", _as_text(F.col("spans")))


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every span replaced: personal data by its kind in brackets, generalised
    terms by [TERM], removed ones by nothing. Spans that overlap are replaced as one."""
    spans = find(docs, **options).where("size(spans) > 0").select(F.col("doc_id").alias("_d"), F.col("_text").alias("_t"), F.col("spans").alias("_spans")).distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")  # its names cannot clash with those in use here
    rows = docs.select("doc_id", "text", whole).join(spans, F.col("doc_id").cast("bigint").eqNullSafe(F.col("_d")) & (F.xxhash64(text) == F.col("_t")), "left")
    merged = F.aggregate(
        "_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(acc["out"], F.substr("text", acc["at"] + 1, s["start"] - acc["at"]), F.when(s["kind"] == "removed", "").when(s["kind"] == "generalised", "[TERM]").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))).alias("out"),
            )
        ),
        lambda acc: F.concat(acc["out"], F.substr("text", acc["at"] + 1)),
    )
    clean = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(merged)
    return rows.select(F.col("_row").withField("text", clean).alias("_row")).select("_row.*")


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (all as kind:start:end, comma-joined)."""
    return find(docs, **options).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", F.col("span_text").alias("spans"))
