import itertools
import math
import random
import re
import string
import zlib

import numpy as np
import pyarrow as pa

from opskit.llm import toxicity


def corpus(n=600):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(20, 80))]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["Foul,", "vile", "rotten."]))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_accuracy_and_edge_rows(spark, docs):
    rows, labels = corpus()
    more = [(900, None), (901, ""), (902, "vile " * 50_000), (903, "w1 w2"), (903, "w1 w2"), (None, "foul vile rotten")]
    got = toxicity.held_out_scores(docs(rows + more), frame(spark, labels + [(903, None), (903, 0), (None, 1), (777_777, 1)])).collect()
    assert len(got) == len(rows) + len(more)
    truth = dict(labels)
    held = [r for r in got if r.doc_id in truth and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert {r.predicted for r in got if r.doc_id in (900, 901, 903)} == {0}


def test_no_labels_or_documents(spark, docs):
    rows, _ = corpus(20)
    got = toxicity.held_out_scores(docs(rows), frame(spark, [])).collect()
    assert {r.score for r in got} == {0.5}
    assert toxicity.held_out_scores(docs([]), frame(spark, [(1, 1)])).count() == 0


def test_l1_keeps_few_weights():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 5000, 200)) for _ in range(400)]
    labels = np.arange(400) % 3 == 0
    rows = [np.append(r, 10_000) if y else r for r, y in zip(rows, labels)]
    at, w, _ = toxicity.fit_documents(rows, labels.astype(float))
    assert w[at == 10_000][0] > 1 and len(at) < 1500


def pieces(text):
    """Features of one text as tuples."""
    words = []
    for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)):
        raw = w.encode()
        while len(raw) > 1 and chr(raw[-1]) in string.punctuation:
            raw = raw[:-1]
        while len(raw) > 1 and chr(raw[0]) in string.punctuation:
            raw = raw[1:]
        words += [raw] if raw else []
    found = {("word", w) for w in words}
    found |= {(gap, a, b) for gap in (1, 2, 3) for a, b in zip(words, words[gap:])}
    return found | {("start", k, w[:k]) for k in (4, 6, 8, 10) for w in words if len(w) > k}


def test_features_match_pieces_of_each_text():
    texts = ["Vile, viler! vilest", "", "one two three four one two", "entsetzlich ENTSETZLICHE (entsetzlicher)", "ärger ärgerlich", "a"]
    coordinates, owner = toxicity.features(pa.array(texts))
    got = [set(coordinates[owner == i].tolist()) for i in range(len(texts))]
    want = [pieces(t) for t in texts]
    assert [len(x) for x in got] == [len(x) for x in want]
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert len(got[i] & got[j]) == len(want[i] & want[j])


def test_fit_matches_one_document_at_a_time_with_dictionaries():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 60, 12)) for _ in range(80)]
    labels = np.array([float(7 in r or rng.random() < 0.1) for r in rows])
    at, w, bias = toxicity.fit_documents(rows, labels, alpha=0.5, beta=1.0, l1=0.5, epochs=3)
    known = {x for x in range(60) if sum(x in r for r in rows) >= toxicity.MIN_DOCUMENTS}
    z, n = {}, {}

    def weight(x):
        if x != "bias" and abs(z.get(x, 0)) <= 0.5:
            return 0.0
        shrink = 0 if x == "bias" else math.copysign(0.5, z.get(x, 0))
        return -(z.get(x, 0) - shrink) / ((1.0 + math.sqrt(n.get(x, 0))) / 0.5)

    order = np.random.default_rng(3)
    for _ in range(3):
        for d in order.permutation(len(rows)):
            some = [int(x) for x in rows[d] if x in known] + ["bias"]
            now = {x: weight(x) for x in some}
            g = 1 / (1 + math.exp(-sum(now.values()))) - labels[d]
            for x in some:
                rate = (math.sqrt(n.get(x, 0) + g * g) - math.sqrt(n.get(x, 0))) / 0.5
                z[x] = z.get(x, 0) + g - rate * now[x]
                n[x] = n.get(x, 0) + g * g
    want = {x: weight(x) for x in known if weight(x)}
    assert dict(zip(at.tolist(), w)).keys() == want.keys() and abs(bias - weight("bias")) < 1e-9
    assert all(abs(v - want[int(x)]) < 1e-9 for x, v in zip(at, w))


def test_scores_are_probabilities_seen_on_other_folds():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 3, 4000)
    labels = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 * x + 1)))).astype(float)
    margin, share = toxicity.calibration(x, labels)
    grid = np.linspace(-6, 4, 21)
    assert abs(np.interp(grid, margin, share) - 1 / (1 + np.exp(-(0.5 * grid + 1)))).max() < 0.12
    assert (np.diff(share) >= 0).all() and (np.diff(margin) > 0).all() and 0 <= share.min() and share.max() <= 1
    for one in (np.ones(5), np.zeros(0)):  # a single label or none: the sigmoid itself
        assert np.interp(0.0, *toxicity.calibration(x[: len(one)], one)) == 0.5
    pools = toxicity.calibration(np.array([-30.0, -20, 20, 30]), np.array([0.0, 0, 1, 1]))
    assert np.interp(-25, *pools) < 0.3 and np.interp(25, *pools) > 0.7
