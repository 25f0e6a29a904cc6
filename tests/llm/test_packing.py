import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from opskit.llm import packing

PATH = public_tokenizers.path(packing.TOKENIZER)
HARD = [
    "", " ", "Hello, World. it's they've 42 1234 a.b,c..", "É é é straße ÀÉÎ Ümlaut ΟΔΟΣ ΣΑΣ. J̌x ǰ İstanbul", "日本語 のテスト。한국어 🙂🙂 a🙂b",
    "<|endoftext|> x<|startoftext|>y", "a\x1cb\x1fc\x85d\xa0e f", "…—…. ,.,. x.,", "ﬁ Ⅷ ² ½ ٣٤ ௧", "word" * 300, "don't. DON'T, 'S 'll. o'clock.",
]


WHOLE = Tokenizer.from_file(PATH)


def full(texts):
    return [np.array(WHOLE.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


def test_word_by_word_ids_are_the_tokenizers_ids(spark, sf_dir):
    texts = HARD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    assert packing.token_bytes(texts, PATH) == full(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"])), max_size=5))
def test_any_text(texts):
    assert packing.token_bytes(texts, PATH) == full(texts)


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits", [{}, {"max_documents": 3}, {"max_attention": 60 * 60}])
def test_bins_hold_everything_within_every_limit(rule, limits):
    rng = np.random.default_rng(1)
    histogram = {int(k): int(v) for k, v in zip(*np.unique(rng.integers(1, 60, 3000), return_counts=True))}
    limits = {"max_documents": 1000, "max_attention": 10**9} | limits
    bins = packing.best_fit(histogram, 100, rule=rule, **limits)
    seen = {}
    for many, lengths in bins:
        assert sum(lengths) <= 100 and len(lengths) <= limits["max_documents"] and sum(x * x for x in lengths) <= limits["max_attention"]
        for x in lengths:
            seen[x] = seen.get(x, 0) + many
    assert seen == histogram


def plain_best_fit(lengths, capacity):
    bins = []
    for x in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] >= x]
        if fits:
            min(fits, key=lambda b: b[0])[0] -= x
        else:
            bins.append([capacity - x])
    return len(bins)


def test_as_few_bins_as_plain_best_fit_piece_by_piece():
    lengths = np.random.default_rng(2).integers(1, 400, 4000)
    histogram = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}
    got = sum(many for many, _ in packing.best_fit(histogram, 1000, weights=(1, 0, 0)))
    assert got <= plain_best_fit(lengths.tolist(), 1000)


def test_sequences_are_gapless_and_pieces_whole(docs, prose):
    rows = [(i, prose(i, 30 + 37 * i)) for i in range(30)] + [(100, None), (101, ""), (102, " \n"), (5, prose(5, 215)), (None, "x y")]
    got = packing.pack(docs(rows), capacity=256, keep_ids=True).toPandas()
    texts = [t or "" for _, t in rows]
    want = [(d, np.frombuffer(b, "<u4").tolist() + [1]) for (d, _), b in zip(rows, full(texts))]
    assert got.length.sum() == sum(len(x) for _, x in want)
    for r in got.itertuples():
        assert len(r.ids) == r.length <= 256
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    by_id = dict(want)
    for d, part in got[got.doc_id.notna() & (got.doc_id != 5)].groupby("doc_id"):
        part = part.sort_values("piece")
        assert [x for ids in part.ids for x in ids] == by_id[d]
        assert part.start.tolist() == [256 * k for k in range(len(part))] == (256 * part.piece).tolist()
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part.offset.tolist() == [0, *np.cumsum(part.length)[:-1].tolist()] and part.length.sum() <= 256
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 256) + 1


def test_empty_table(docs):
    assert packing.pack(docs([])).count() == 0
