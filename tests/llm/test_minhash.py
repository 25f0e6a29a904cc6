import itertools
import random

from opskit.llm import minhash


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both, all_ = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if both and 100 * both >= 75 * all_:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sorted((d, len(s), find(d), find(d) == d) for d, s in sets.items())


def variants(prose):
    """A family around one text, chains of small edits, exact copies and short texts."""
    rng, rows = random.Random(5), []
    base = prose(1, 200).split()
    for _ in range(40):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"x{rng.random()}"
        rows.append(" ".join(words))
    words = prose(2, 150).split()
    for _ in range(25):
        words[rng.randrange(150)] = f"y{rng.random()}"
        words[rng.randrange(150)] = f"y{rng.random()}"
        rows.append(" ".join(words))
    rows += [prose(3, 90)] * 30 + [prose(4, 90).upper()] * 2 + [prose(4, 90)] + [prose(10 + i, 60) for i in range(20)]
    rows += ["one two", "one  two\n", "two one", "", "  \t", "one two three four five", "lone"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_components_match_brute_force(docs, prose):
    rows = variants(prose)
    got = sorted(tuple(r) for r in minhash.links(docs(rows)).collect())
    assert got == brute(rows)


def test_null_empty_and_repeated_rows(docs, prose):
    text = prose(7, 50)
    rows = [(1, None), (2, ""), (5, text), (5, text), (9, text), (None, text), (None, prose(8, 20)), (3, "a\u0001b c")]
    got = sorted((tuple(r) for r in minhash.links(docs(rows)).collect()), key=repr)
    n = 46
    want = [(1, 0, 1, True), (2, 0, 2, True), (5, n, 5, True), (5, n, 5, True), (9, n, 5, False), (None, n, 5, False), (None, 16, None, True), (3, 1, 3, True)]
    assert got == sorted(want, key=repr)


def test_empty_table(docs):
    assert minhash.links(docs([])).count() == 0


def test_one_document_of_each_group_stays(docs, prose):
    text = prose(9, 80)
    kept = minhash.deduplicate(docs([(4, text), (2, text + " end"), (8, prose(10, 80)), (6, None)]))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 6, 8]
    assert kept.columns == docs([]).columns


def test_pair_links_across_open_components(spark):
    """Whatever the earlier rounds joined, the prefix filter finds every link between different roots."""
    rng = random.Random(11)
    sets = []
    for family in range(6):
        base = [rng.getrandbits(50) for _ in range(rng.randint(20, 60))]
        for _ in range(15):
            own = rng.randint(0, len(base) // 4)
            sets.append(sorted(set(rng.sample(base, len(base) - rng.randint(0, 5))[own // 2 :] + [rng.getrandbits(50) for _ in range(own)])))
    roots = {i: rng.choice([i, i % 15, i // 15]) for i in range(len(sets))}
    frame = spark.createDataFrame(list(enumerate(sets)), "node bigint, members array<bigint>")
    nodes = spark.createDataFrame(list(roots.items()), "node bigint, root bigint")
    got = {(r.a, r.b) for r in minhash._prefix_pairs(frame, nodes, 75).collect()}
    want = set()
    for b, a in itertools.combinations(range(len(sets)), 2):
        both = len(set(sets[a]) & set(sets[b]))
        if roots[a] != roots[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            want.add((a, b))
    assert want and want <= got and len(got) < 3 * len(want)


def test_alike_but_unlinked_families_build_no_pairs(spark):
    rng = random.Random(12)
    base = [rng.getrandbits(50) for _ in range(300)]
    sets = [sorted(base[:] + [rng.getrandbits(50) for _ in range(60)]) for _ in range(60)]  # similarity 300 / 420
    frame = spark.createDataFrame(list(enumerate(sets)), "node bigint, members array<bigint>")
    nodes = spark.createDataFrame([(i, i) for i in range(60)], "node bigint, root bigint")
    assert minhash._prefix_pairs(frame, nodes, 75).count() == 0


def test_repeated_rows_and_rows_without_an_id_are_told_apart_by_text(docs, prose):
    a, b, c = prose(21, 80), prose(22, 80), prose(23, 80)
    rows = [(5, a), (5, a), (7, a + " end"), (6, b), (6, c), (None, a), (None, c + " end"), (None, "one two"), (None, "one two"), (9, None), (9, None)]
    kept = minhash.deduplicate(docs(rows))
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert len(got) == 5 and (7, a + " end") in got and (6, b) in got and (None, "one two") in got and (9, None) in got
    assert sum(t in (c, c + " end") for _, t in got) == 1


def test_names_in_use_do_not_clash(spark, prose):
    text = prose(24, 60)
    frame = spark.createDataFrame([(1, text, 3, 4), (1, text, 3, 4), (None, text, 5, 6)], "doc_id bigint, text string, `key.x` int, _key int")
    kept = minhash.deduplicate(frame)
    assert kept.columns == frame.columns and kept.count() == 1
