"""The licence scan against comparing every licence at every place, and its index."""

import math
import re

import pytest

from opskit.llm import licences, queries

BASE = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(rows):
    """Naming phrases and licence texts at every place of every document."""
    texts = [words(t) for _, t in rows]
    n = len(texts)
    df = {}
    for t in texts:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    idf = lambda w: math.log1p((n + 1) / (df.get(w, 0) + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        base = [(i, label) for label, p in BASE.items() for i in range(len(t)) if t[i : i + len(p.split())] == p.split()]
        labels, best = {x for _, x in base}, 1.0 if base else 0.0
        for lic in licences.TEXTS:
            want = words(lic.text)
            total = sum(map(idf, want))
            for i in range(len(t) - len(want) + 1):
                share = sum(idf(w) for w, x in zip(want, t[i:], strict=False) if w == x) / total
                must = all(any(want[j : j + len(p)] == p and t[i + j : i + j + len(p)] == p for j in range(len(want))) for p in map(words, lic.phrases))
                if must and share >= licences.SHARE - 1e-9:
                    labels.add(lic.label)
                    best = max(best, share)
        at = [i for i, _ in base]
        out.append((doc_id, len(t), len(base), min(at, default=None), max(at, default=None),
                    ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), round(best, 9)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((*r[:-1], round(r[-1], 9)) for r in df.collect()), key=repr)


@pytest.fixture
def corpus(prose):
    long = prose(4, 3000)
    rows = [
        (1, "Released under the MIT License."), (2, "UNDER THE mit-license, under the mit\tlicense!"), (3, "Licensed under CC BY-NC 4.0. cc by nc"),
        (4, "This work is licensed under the GNU General Public License, version 3."), (5, "under the mit licenses"), (6, "under the mit"), (7, "license"),
        (8, None), (9, ""), (10, " \n.,"), (None, "Apache License, Version 2.0"), (None, "Apache License, Version 2.0"), (1, "Released under the MIT License."),
        (11, "é under the MIT License é Apache\x85License Version 2"), (12, long + " " + licences.TEXTS[0].text + " " + long),
        (13, "license " * 5000), (14, "the gnu general public license version 3 gnu gnu"), (15, "under the MIT Licenseé"),
    ]
    rows += [(100 + i, f"x {lic.text} y") for i, lic in enumerate(licences.TEXTS)]
    for i, lic in enumerate(licences.TEXTS):  # changed words: one each, at every place of the first ones
        w = lic.text.split()
        rows += [(1000 + 100 * i + k, " ".join([*w[:k], "changed", *w[k + 1 :]])) for k in range(0, len(w), 1 if i < 3 else 4)]
        rows += [(5000 + i, " ".join(w[: len(w) // 2]))]
    return rows


def test_equals_every_place(corpus, docs):
    assert got(licences.report(docs(corpus))) == brute(corpus)


def test_texts_meet_across_chunks(docs, monkeypatch, corpus):
    rows = corpus[:20]
    monkeypatch.setattr(licences, "ranges", lambda offsets: ((i, i + 1) for i in range(len(offsets) - 1)))
    assert got(licences.report(docs(rows).coalesce(1))) == brute(rows)


def test_no_documents(docs):
    assert licences.report(docs([])).count() == 0


def test_whole_table_against_every_place(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
    assert got(queries.QUERIES["op13_rare_token_licences"](spark, sf_dir)) == brute(rows)
