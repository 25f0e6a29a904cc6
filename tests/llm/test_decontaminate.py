import random

import numpy as np
import pytest

from opskit.llm import decontaminate as d


def items(prose, n=60):
    return [(i, f"{prose(i, 20, 900)}. {prose(500 + i, 8, 900)}.") for i in range(n)]


def bench(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id bigint, text string, term string")


def corpus(prose, tests):
    rng = random.Random(1)
    rows, truth = [], {}
    for i in range(80):
        body = prose(1000 + i, rng.randint(30, 900), 900).split()
        if i % 4 == 0:
            item = rng.randrange(len(tests))
            at = rng.randrange(len(body))
            body[at:at] = tests[item][1].upper().replace(".", "!").split()
            truth[i] = {item}
        if i % 4 == 1:  # the question alone
            body += tests[i % len(tests)][1].split(". ")[0].split()
        rows.append((i, ("\n" if i % 2 else " ").join(body)))
    return rows, truth


def test_planted_items_are_found_and_nothing_else(spark, docs, prose):
    tests = items(prose) + [(90, None), (91, ""), (None, "alone here " * 9)]
    rows, truth = corpus(prose, tests[:60])
    rows += [(200, None), (201, ""), (202, tests[7][1]), (202, tests[7][1]), (None, tests[8][1])]
    for shard_words in (500_000, 100):
        got = d.report(docs(rows), bench(spark, tests), shard_words=shard_words).collect()
        assert len(got) == len(rows)
        found = {r.doc_id: {int(x) for x in r.item_ids.split(",")} for r in got if r.contaminated}
        assert found == truth | {202: {7}, None: {8}}
        assert all(r.kept != r.contaminated and r.n_items == len(found.get(r.doc_id, ())) for r in got)
    clean = d.clean(docs(rows), bench(spark, tests))
    assert clean.columns == docs([]).columns
    assert {r.doc_id for r in clean.collect()} == {x for x, _ in rows} - set(truth) - {202, None}


def test_long_items_are_found_wherever_their_copy_lies(spark, docs, prose):
    tests = items(prose, 30) + [(100 + n, f"{prose(n, n - 10, 900)}. {prose(n + 1, 10, 900)}.") for n in (97, 150, 250, 600)]
    rows, truth = [], {}
    for item, text in tests[30:]:
        for at in range(0, 1300, 37):
            doc = len(rows)
            rows.append((doc, f"{prose(3000 + doc, at, 900)} {text} {prose(9000 + doc, 700, 900)}"))
            truth[doc] = {item}
    rows += [(10_000, prose(1, 2000, 900)), (10_001, tests[33][1].split(". ")[0]), (10_002, tests[3][1])]
    got = d.report(docs(rows), bench(spark, tests)).collect()
    assert {r.doc_id: {int(x) for x in r.item_ids.split(",")} for r in got if r.contaminated} == truth | {10_002: {3}}


def test_empty_tables(spark, docs, prose):
    rows = [(1, prose(1, 50)), (2, None)]
    assert {r.contaminated for r in d.report(docs(rows), bench(spark, [])).collect()} == {False}
    assert d.report(docs([]), bench(spark, items(prose, 3))).count() == 0


@pytest.mark.parametrize("threshold", [0.3, 0.55, 0.8])
def test_block_max_wand_finds_every_item_above_the_threshold(spark, prose, threshold):
    found = d.index(bench(spark, items(prose, 100))).toPandas()
    shard = d.Shard(*(found[c].to_numpy() for c in ("item_id", "at", "term", "answer_at", "impact")))
    rng = np.random.default_rng(4)
    dense = np.zeros((len(shard.items), len(shard.terms)))
    for t in range(len(shard.terms)):
        a, b = shard.first[t], shard.first[t + 1]
        dense[shard.post[a:b], t] = shard.impact[a:b]
    assert np.allclose(dense.sum(axis=1), 1)
    for k in range(200):
        size = rng.integers(1, len(shard.terms) // 2)
        query = np.unique(np.concatenate((rng.integers(0, len(shard.terms), size), np.flatnonzero(dense[rng.integers(100)])[rng.random() < 0.7 :])))
        want = np.flatnonzero(dense[:, query].sum(axis=1) >= threshold - 1e-9)
        assert sorted(shard.search(query, threshold)) == want.tolist()
        # the bound over passages never misses one
        half = np.zeros(len(query), int)
        if len(want) and (dense[:, query[~shard.common[query]]][want].sum(axis=1) > 0).any():
            assert shard.candidates(query, half, np.array([True]), threshold).tolist() == [0]


def test_items_of_common_words_and_copies_across_a_border(spark, docs, prose):
    number = ["one", "two", "three", "four", "five", "six"]
    sums = [(300 + 36 * k + 6 * i + j, f"What is {a} {op} {b} please now? The answer is {a} {op} {b}.") for k, op in enumerate(("plus", "minus")) for i, a in enumerate(number) for j, b in enumerate(number)]
    same = f"{prose(70, 20, 900)}. {prose(71, 8, 900)}."
    # only the last words are rare
    tail = "What is one plus two please now? The answer is one plus zebra quagga."
    tests = items(prose) + sums + [(500 + i, same) for i in range(7)] + [(600, tail)]
    rows = [(1, f"{prose(1, 50, 10**9)} {sums[8][1]} {prose(2, 150, 10**9)}"), (2, f"{prose(3, 90, 10**9)} {same} {prose(4, 20, 10**9)}")]
    rows += [(10 + at, f"{prose(5, at, 10**9)} {tail} {prose(6, 120, 10**9)}") for at in range(80, 100)]
    got = {r.doc_id: {int(x) for x in r.item_ids.split(",") if x} for r in d.report(docs(rows), bench(spark, tests)).collect()}
    assert sums[8][0] in got[1] and got[2] == set(range(500, 507))
    assert all(600 in got[10 + at] for at in range(80, 100))


@pytest.mark.parametrize("read", [1, 300, 1 << 20])
@pytest.mark.parametrize("threshold", [0.3, 0.55, 0.8])
def test_candidates_hold_every_passage_above_the_threshold(spark, prose, monkeypatch, threshold, read):
    monkeypatch.setattr(d, "READ", read)
    # every word is in many items
    found = d.index(bench(spark, [(i, f"{prose(i, 12, 40)}. {prose(900 + i, 5, 4000)}" if i % 3 else prose(i, 12, 40)) for i in range(90)])).toPandas()
    shard = d.Shard(*(found[c].to_numpy() for c in ("item_id", "at", "term", "answer_at", "impact")))
    dense = np.zeros((len(shard.items), len(shard.terms)))
    for t in range(len(shard.terms)):
        a, b = shard.first[t], shard.first[t + 1]
        dense[shard.post[a:b], t] = shard.impact[a:b]
    rng = np.random.default_rng(6)
    halves, last = 120, rng.random(120) < 0.3
    last[-1] = True
    words = [rng.permutation(len(shard.terms))[: rng.integers(0, 5)] if rng.random() < 0.5 else np.flatnonzero(dense[rng.integers(90)])[rng.integers(0, 4) :: rng.integers(1, 3)] for _ in range(halves)]
    want = {p for p in range(halves) if (dense[:, np.unique(np.concatenate((words[p], words[p + 1] if not last[p] else words[p]))).astype(int)].sum(axis=1) >= threshold - 1e-9).any()}
    term, half = np.concatenate(words).astype(int), np.repeat(np.arange(halves), [len(w) for w in words])
    got = shard.candidates(term, half, last, threshold).tolist()
    assert got == sorted(set(got)) and want <= set(got) and len(want) > 5
