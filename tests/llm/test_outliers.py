import random
import re

import numpy as np
from pyspark.sql import functions as F

from opskit.llm import outliers


def base(text):
    text = text or ""
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen = {}
    for i in range(len(ws) - 2):
        seen.setdefault(tuple(ws[i : i + 3]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    lines, dups, had = text.split("\n"), 0, set()
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dups += x in had
            had.add(x)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
    return len(ws), sum(map(len, ws)), symbols, dups, len(covered), failed


def corpus():
    rng = random.Random(2)
    rows = []
    for i in range(700):
        body = [f"{'abcdefgh'[rng.randint(0, 7)] * rng.randint(2, 7)}{rng.randint(0, 400)}" for _ in range(rng.randint(40, 300))]
        if i % 50 == 0:
            body = [w + "$$$%" for w in body]
        if i % 9 == 0:
            body[5:5] = body[20:26]
        rows.append((i, "\n".join(" ".join(body[a : a + 12]) for a in range(0, len(body), 12)), "aa" if i % 3 else "bb", ["s", "t", None][i % 5 % 3]))
    extra = ["", None, "a b c a b c", "x " * 3000, "a b\na b\n \n\na b", "é🙂 ü#|", "same " * 60, "\x1f\x85 \xa0 b"]
    return rows + [(1000 + i, t, None, "s") for i, t in enumerate(extra)] + [(5, "a b", "aa", "s")]


def test_base_columns_match_brute_force(docs):
    rows = corpus()
    got = outliers.judge(docs(rows)).collect()
    want = sorted((d, *base(t)) for d, t, _, _ in rows)
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    rejected = {r.doc_id for r in got if not r.base_failed and not r.kept}
    planted = {d for d, t, _, _ in rows if t and "$$$%" in t and not base(t)[-1]}
    assert planted and rejected == planted
    assert all(not r.kept for r in got if r.base_failed)


def test_tiny_and_empty_tables(docs):
    assert outliers.judge(docs([])).count() == 0
    got = outliers.judge(docs([(1, " ".join(f"w{i}" for i in range(60))), (2, None)])).collect()
    assert {(r.doc_id, r.kept, r.distance) for r in got} == {(1, True, None), (2, False, None)}


def mcd(x, coverage, steps):
    """The same estimate in numpy: median start, concentration steps, reweighting."""
    floors = np.array(outliers.FLOORS)
    med = np.round(x * 64)
    med = np.sort(med, axis=0)[int(np.ceil(0.5 * len(x))) - 1] / 64
    dev = np.sort(np.round(np.abs(x - med) * 64), axis=0)[int(np.ceil(0.5 * len(x))) - 1]
    m, w = med, np.diag(1 / np.maximum(1.4826 * dev / 64, floors))
    dist = lambda: (((x - m) @ w.T) ** 2).sum(axis=1)
    for step in range(steps + 1):
        if step < steps:
            bins = np.floor(32 * np.log(dist() + 1e-6))
            inside = bins <= np.sort(bins)[int(np.ceil(coverage * len(x))) - 1]
        else:
            inside = dist() <= 12.83
        some = x[inside]
        m = some.mean(axis=0)
        c = (some.T @ some / len(some) - np.outer(m, m)) * (outliers.CONSISTENCY if step == steps - 1 else 1.0)
        w = np.linalg.inv(np.linalg.cholesky(c + np.diag(floors**2)))
    return dist()


def test_distances_match_numpy(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 5)) * [1, 0.5, 0.2, 0.3, 0.6] + 3
    x[:40] += 8
    rows = spark.createDataFrame([("g", i, *map(float, v)) for i, v in enumerate(x)], "g string, i int, " + ", ".join(f"{c} double" for c in outliers.X))
    found = outliers.estimates(rows, True)
    got = outliers._attach(rows, found, rows["g"] == found["_g"], True).select("i", outliers._distance().alias("d")).toPandas().sort_values("i").d
    want = mcd(x, outliers.COVERAGE, outliers.STEPS)
    assert np.allclose(got, want, rtol=1e-6) and want[:40].min() > outliers.CUTOFF > want[40:].max()


def test_no_python_in_the_plan(docs):
    plan = outliers.judge(docs(corpus()[:50]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_words_next_to_unicode_breaks_and_long_blanks(spark):
    from opskit.llm.common import words_of

    texts = {"a b \x85": 3, "\x85": 1, "a\u2028": 1, " \t\n\x0b\x0c\r": 0, "": 0, None: 0, "a" + " " * 1_000_000 + "b" + "\n" * 1_000_000: 2}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.size(words_of(F.col("t"))).alias("n"))
    assert [r["n"] for r in df.collect()] == list(texts.values())
