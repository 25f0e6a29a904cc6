"""The potential audit against counting document by document in every order."""

import re
from itertools import permutations

import pytest

from opskit.llm import filter_audit, queries

LABELS = "doc_id bigint, quality int, toxic int, part string"


def brute(rows, labels):
    good = {i for i, q, _, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, _ in labels if t == 1 and i is not None}
    docs = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        upper = len(re.findall("[A-Z]", text))
        fails = set()
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * upper > 3 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows):
            fails |= {"E"}
        docs.append((lang or "", fails, doc_id in good, doc_id in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = here
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[1] for d in here) - len(gone), sum(d[1] == {f} for d in here),
                    sum(d[2] for d in gone), sum(d[3] for d in gone)]
    for part in {d[0] for d in docs}:
        for f in "ABCDE":
            total = sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == f)
            for (p, o, s), v in out.items():
                if p == part and o[s - 1] == f:
                    v.append(total)
    return out


@pytest.fixture
def corpus(docs, prose):
    long = prose(1, 250)
    rows = [
        (1, long, "en", "s"), (2, long, "de", "s"), (3, long, "en", "s"), (3, long, "en", "s"), (None, long, "en", "s"), (0, "a a a a", None, "s"),
        (4, None, "en", "s"), (5, "", "de", "s"), (6, " \t\n", "", "s"), (7, "SHOUT " * 300, "en", "s"), (8, prose(2, 300) + " 5%", "en", "s"),
        (9, prose(2, 300) + " 5%", "en", "s"), (10, "x\x85y " * 220, "de", "s"), (11, " " * 100_000 + prose(3, 400), "de", "s"), (None, None, None, None),
    ]
    return [r[:3] for r in rows], docs(rows)


def test_audit_equals_counting(spark, corpus):
    rows, df = corpus
    labels = [(1, 1, 0, "x"), (1, 0, 1, "x"), (3, 1, None, "x"), (8, 0, 1, "x"), (9, 1, 1, "x"), (None, 1, 1, "x"), (99, 1, 1, "x")]
    got = {tuple(r[:3]): list(r[3:]) for r in filter_audit.audit(df, spark.createDataFrame(labels, LABELS)).collect()}
    assert got == brute(rows, labels)


def test_potential_is_recursive(spark, corpus):
    game = filter_audit.games(filter_audit.patterns(corpus[1], spark.createDataFrame([], LABELS))).collect()
    assert game
    for g in game:
        for s in range(1, filter_audit.COALITIONS):
            inside = [i for i in range(5) if s >> i & 1]
            assert len(inside) * g["potential"][s] == 120 * g["docs"][s] + sum(g["potential"][s - (1 << i)] for i in inside)
        assert sum(g["shapley"]) == 120 * g["docs"][-1]


def test_no_documents(spark, docs):
    assert filter_audit.audit(docs([]), spark.createDataFrame([], LABELS)).count() == 0


def test_matches_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    got = queries.QUERIES["op11_potential_audit"](spark, sf_dir)
    want = con.sql(queries.SQL["op11_potential_audit"])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
