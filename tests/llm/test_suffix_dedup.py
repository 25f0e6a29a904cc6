import hashlib
import random

import pytest

from opskit.llm import suffix_dedup as s


def brute(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = {}
    for _, b in texts:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for d, b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(length):
    rng = random.Random(6)
    letters = "abcé "
    text = lambda n: "".join(rng.choices(letters, k=n))
    shared = [text(rng.randint(length // 2, 4 * length)) for _ in range(6)]
    rows = []
    for i in range(50):
        parts = [text(rng.randint(0, 2 * length))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randrange(len(p))
            parts += [p[a : a + rng.randint(1, 3 * length)], text(rng.randint(0, 5))]
        rows.append((i, "".join(parts)))
    rows += [(60, rows[1][1]), (61, rows[1][1]), (62, "ab" * 2 * length), (63, "ab" * length + "x"), (64, "z" * 5 * length), (65, None), (66, ""), (67, shared[0][: length - 1]), (1, rows[1][1]), (None, text(3 * length))]
    return rows


@pytest.mark.parametrize(("length", "grams", "group"), [(40, (8, 24, 32, 40), 256), (40, (8, 24, 32, 40), 2), (40, (16, 40), 1), (64, (64,), 9)])
def test_matches_comparison_of_all_strings(docs, length, grams, group):
    rows = corpus(length)
    got = sorted((tuple(r)[:5] for r in s.deduplicate(docs(rows), length, grams, group).collect()), key=repr)
    assert got == brute(rows, length)


def test_production_length(docs):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 9)))
    passage = " ".join(word() for _ in range(120))
    rows = [(i, " ".join(word() for _ in range(100)) + passage[i : 420 + 20 * i] + " ".join(word() for _ in range(60))) for i in range(12)]
    got = sorted((tuple(r)[:5] for r in s.deduplicate(docs(rows)).collect()), key=repr)
    assert got == brute(rows, 400)
    assert s.deduplicate(docs([])).count() == 0


def test_isolated_periodic_stretches_at_production_length(docs):
    rng = random.Random(10)
    text = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
    rows = []
    for i, (period, size) in enumerate([(1, 401), (1, 735), (3, 410), (7, 450), (50, 450), (50, 449), (100, 500), (120, 600), (199, 600), (200, 735), (335, 735), (340, 735)]):
        rows.append((i, text(500) + (text(period) * 800)[:size] + text(500)))
    rows += [(20, (text(60) * 20)[:480]), (21, text(900))]
    want = brute(rows, 400)
    assert sum(r[2] > 0 for r in want) == 11
    got = sorted((tuple(r)[:5] for r in s.deduplicate(docs(rows)).collect()), key=repr)
    assert got == want


def test_sorted_groups_are_in_order_and_complete():
    rng = random.Random(9)
    for length in (12, 40):
        data = bytes(rng.choices(b"ab", k=1500)) + bytes(rng.choices(b"abcd", k=200)) * 3
        at = list(range(len(data) - length + 1))
        trie = s.BlindTrie(data, length)
        for p in at:
            trie.insert(p)
        order = [data[g[0] : g[0] + length] for g in trie.ordered()]
        assert order == sorted({data[p : p + length] for p in at})
        want = {}
        for p in at:
            want.setdefault(data[p : p + length], set()).add(p)
        import numpy as np

        got = [set(g) for g in s.sorted_groups(data, np.array(at), np.zeros(len(at), int), length, 8)]
        assert sorted(map(sorted, got)) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_tasks_hold_little_beside_the_heap(spark, docs):
    import tracemalloc

    import pyarrow as pa

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")
    try:
        s.deduplicate(docs([(1, "a" * 900), (2, "b")]))
        assert int(spark.conf.get(name)) <= 1000  # also for the result, which is written later
    finally:
        spark.conf.set(name, before)
    rng = random.Random(11)
    texts = ["".join(rng.choices("abcdefgh ", k=2000)) for _ in range(1000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": range(1000), "_text": range(1000), "offset": pa.array([0] * 1000, pa.int32()), "weight": [1] * 1000, "bytes": texts})
    list(s._anchors(64, 400)([batch.slice(0, 10)]))
    tracemalloc.start()
    try:
        for _ in s._anchors(64, 400)([batch]):
            pass
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()


def test_only_texts_with_wanted_segments_are_joined(spark, docs, monkeypatch):
    rng = random.Random(12)
    rows = corpus(40) + [(1000 + i, "".join(rng.choices("defghijklmnopqrstuvw", k=300))) for i in range(300)]
    frame, joined = docs(rows), []
    join = type(frame).join

    def counted(self, *args, **more):
        if "text" in self.columns:
            joined.append(self.count())
        return join(self, *args, **more)

    monkeypatch.setattr(type(frame), "join", counted)
    got = sorted((tuple(r)[:5] for r in s.deduplicate(frame, 40, (8, 24, 32, 40), 2).collect()), key=repr)
    assert got == brute(rows, 40)
    assert len(joined) > 2 and max(joined) < 150  # texts of their own go to no shuffle


def test_filters_grow_with_the_hashes(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(s, "FILTER_BITS", 1 << 10)
    monkeypatch.setattr(s, "MOST_BITS", 1 << 20)
    words = s._bits(spark.range(5000).selectExpr("xxhash64(id) AS h"), "h")
    own, other = (np.array([r[0] for r in spark.range(a, a + 5000).selectExpr("xxhash64(id)").collect()]) for a in (0, 5000))
    assert s._marked(words, own).all()
    assert s._marked(words, other).mean() < 0.1
    monkeypatch.setattr(s, "MOST_BITS", 1 << 12)
    assert len(s._bits(spark.range(5000).selectExpr("xxhash64(id) AS h"), "h")) == 1 << 7
