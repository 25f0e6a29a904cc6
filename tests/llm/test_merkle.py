"""The Merkle manifest against trees built row by row, and against SQL."""

import hashlib
import zlib

import pytest

from opskit.llm import merkle, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    doc_id, text, lang, source, n = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    shown = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)]
    return sha("".join(shown))


def tree(nodes, at):
    """(root, siblings left and right per level) of the node at a place."""
    path = []
    while len(nodes) > 1:
        a = at - at % 16
        path.append(("".join(nodes[a:at]), "".join(nodes[at + 1 : a + 16])))
        nodes, at = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)], at // 16
    return nodes[0], path


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    for part in by.values():
        part.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    sub = {s: tree([leaf(r) for r in by[s]], 0)[0] for s in order}
    out = []
    for i, s in enumerate(order):
        root, upper = tree([sub[x] for x in order], i)
        hashes = [leaf(r) for r in by[s]]
        for k, r in enumerate(by[s]):
            path = tree(hashes, k)[1] + upper
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            h = leaf(r, tampered)
            for a, b in path:
                h = sha(a + h + b)
            out.append((r[0], leaf(r), sub[s], root, sha("".join(a + b for a, b in path)), h, h == root))
    return sorted(out, key=repr)


def table(rows):
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


EDGES = [
    (1, "One", "en", "é"), (2, "two", None, "é"), (1, "One", "en", "é"), (1, "Other", "en", "é"), (None, "NULL id", "en", None),
    (None, None, None, None), (11, "", "de", ""), (12, None, "de", "z"), (-13, "A" * 100_000, "en", "z"), (14, "text\nÄ", "en", "Z"), (15, "B", "en", "Z"),
]


def test_edges(docs):
    got = merkle.verify(docs(EDGES)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(table(EDGES))


@pytest.mark.parametrize("sizes", [(1,), (16,), (17,), (256, 257), (4096, 4097), (65,) * 40])
def test_sizes(docs, sizes):
    rows, i = [], 0
    for s, n in enumerate(sizes):
        for _ in range(n):
            i += 1
            rows.append((i * 7 % 100_003, f"Text {i}", "en", f"s{s}"))
    got = merkle.verify(docs(rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(table(rows))


def test_upper_rounds(docs, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)  # many rounds with few rows
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = [(i, f"T{i}", "en", "a" if i % 3 else f"b{i}") for i in range(900)]
    got = merkle.verify(docs(rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(table(rows))


def test_versions_share_untouched_nodes(docs):
    rows = [(i, f"Text {i}", "en", "s") for i in range(5000)]
    df = docs(rows)
    base = {(r["level"], r["pos"]): r["node"] for r in merkle.nodes(df).collect()}
    assert len(base) == 5000 + 313 + 20 + 2 + 1
    made = {}
    for r in merkle.versions(df).collect():
        made.setdefault(r["leaf"], {})[r["height"]] = r["node"]
    assert set(made) == {i for i in range(5000) if zlib.crc32(str(i).encode()) % 5 == 0}
    for at, new in list(made.items())[:50]:
        assert len(new) == 5  # one copied node a level, whatever the size of the tree
        for level in range(4):
            first = (at >> 4 * level) - (at >> 4 * level) % 16
            run = [base.get((level, first + k)) for k in range(16)]
            run[(at >> 4 * level) % 16] = new[level]
            assert sha("".join(x for x in run if x)) == new[level + 1]


def test_no_documents(docs):
    assert merkle.verify(docs([])).count() == 0


def test_matches_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.sql(queries.SQL["op12_persistent_merkle"])
    got = queries.QUERIES["op12_persistent_merkle"](spark, sf_dir)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
