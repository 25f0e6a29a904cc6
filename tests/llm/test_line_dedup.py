import hashlib
import random
import re

from opskit.llm import line_dedup


def words(line):
    return len([w for w in re.split(r"[\x20\x09-\x0D]+", line) if w])


def brute(rows, least):
    """Lines in a run with enough words that has an earlier copy, by comparing all runs."""
    seqs = {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        if t is not None:
            seqs[d] = [(i, x) for i, x in enumerate(t.split("\n")) if words(x)]
    first, gone = {}, {d: set() for d in seqs}
    for d, seq in seqs.items():
        for a in range(len(seq)):
            run, n = [], 0
            for b in range(a, len(seq)):
                run.append(seq[b][1])
                n += words(seq[b][1])
                if n >= least and first.setdefault(tuple(run), (d, a)) != (d, a):
                    gone[d] |= {i for i, _ in seq[a : b + 1]}
    out = []
    for d, t in rows:
        lines = [] if t is None else t.split("\n")
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone.get(d, ()))
        dropped = gone.get(d, ())
        out.append((d, len(lines), len(dropped), hashlib.sha256(kept.encode()).hexdigest(), not dropped or bool(words(kept))))
    return sorted(out)


def corpus():
    rng = random.Random(4)
    lines = [" ".join(f"v{rng.randint(0, 99)}" for _ in range(rng.choice([1, 2, 3, 5, 9]))) for _ in range(40)]
    rows = []
    for i in range(60):
        body = []
        while len(body) < rng.randint(1, 25):
            if rng.random() < 0.6:
                a = rng.randrange(40)
                body += lines[a : a + rng.randint(1, 8)]
            else:
                body.append(rng.choice(["", "  ", f"own {i} {rng.random()}"]))
        rows.append((i, "\n".join(body)))
    return rows + [(60, rows[3][1]), (61, None), (62, ""), (63, "\n\n \n"), (64, "same\n" * 40), (65, "one line " * 30), (66, "one line " * 30)]


def test_matches_comparison_of_all_runs(docs):
    for least in (6, 12):
        got = sorted(tuple(r) for r in line_dedup.report(docs(corpus()), least).collect())
        assert got == brute(corpus(), least)


def test_long_document_repeated_rows_and_null_ids(docs):
    long = "\n".join(f"a{i % 700} b c d e" for i in range(3000))
    rows = [(1, long), (2, "x " * 60), (2, "x " * 60), (None, "x " * 60), (None, "y " * 60), (7, "y " * 60 + "\nrest")]
    got = {(r.doc_id, r.n_lines): r for r in line_dedup.report(docs(rows), 50).collect()}
    assert got[1, 3000].n_deleted == 2300
    # null ids come first, so they hold the earlier copies
    assert got[None, 1].kept and not got[2, 1].kept
    assert got[7, 2].n_deleted == 1 and got[7, 2].kept


def test_runs_of_short_lines_in_repeated_rows(docs):
    run = [f"{i} " + "b c d e f g h i j" for i in range(10)]
    text = "\n".join(["own first", *run, "own last"])
    later = "\n".join(["other first", *run[:8], "other last"])
    last = "\n".join(["third first", *run, "third last"])
    rows = [(5, text), (5, text), (9, later), (9, later), (12, last), (None, "\n".join(run[3:])), (None, "\n".join(run[3:])), (None, "\n".join(run[3:]))]
    got = sorted(tuple(r) for r in line_dedup.report(docs(rows)).collect() if r.doc_id is not None)
    # null ids come first: runs that lie in their text have their earlier copy there
    want = {(d, n) for d, _, n, _, _ in got}
    assert want == {(5, 7), (9, 8), (12, 10)} and len(got) == 5
    assert {r.n_deleted for r in line_dedup.report(docs(rows)).collect() if r.doc_id is None} == {0}
    alone = sorted(tuple(r) for r in line_dedup.report(docs(rows[:5])).collect())
    assert alone == sorted([brute(rows[:5:2], 50)[0]] * 2 + [brute([rows[0], rows[2], rows[4]], 50)[1]] * 2 + [brute([rows[0], rows[2], rows[4]], 50)[2]])
    # a text that only repeated rows hold is kept whole
    assert {r.n_deleted for r in line_dedup.report(docs(rows[:2])).collect()} == {0}


def test_stage(docs):
    rows = corpus()
    kept = line_dedup.deduplicate(docs(rows), 12)
    assert kept.columns == docs([]).columns
    want = {d: s for d, _, _, s, k in brute(rows, 12) if k}
    got = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in kept.collect()}
    assert got == want
    assert line_dedup.deduplicate(docs([])).count() == 0


def test_no_python_in_the_plan(docs):
    plan = line_dedup.report(docs(corpus()), 12)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_columns_with_names_in_use_inside(docs):
    run = "\n".join(" ".join(f"w{10 * i + k}" for k in range(10)) for i in range(8))
    names = {"key": "_lines", "node": "_rest", "part": "_doc", "root": "_text", "source": "_row"}
    df = docs([(1, run), (2, "own\n" + run), (None, None)]).withColumnsRenamed(names)
    out = line_dedup.deduplicate(df)
    assert out.schema == df.schema
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[2]["text"] == "own" and got[2]["_lines"] == "k" and got[2]["_row"] == "s" and got[1]["text"] == run and got[None]["text"] is None
