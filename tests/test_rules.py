"""Rules the given tables do not show: resets, clears, cycles, missing successes, text shapes."""

from datetime import datetime, timedelta
from functools import reduce

import pytest
from pyspark.sql import DataFrame, functions as F

from opskit.functions import clock, text, units
from opskit.operators import alerts as al
from opskit.operators import joins as jn
from opskit.operators import reshape as rs
from opskit.operators import rollup as ro
from opskit.operators import sessions as ss
from opskit.operators import telemetry as tm

T0 = datetime(2024, 1, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def test_wait_texts(spark):
    cases = {
        "(8x: 268671/268733/268892ms)LCK_M_S": ("LCK_M_S", 8, 268892),
        "(1x: 117888ms)LCK_M_IX": ("LCK_M_IX", 1, 117888),
        "(2x: 162762/164363ms)LCK_M_S": ("LCK_M_S", 2, 164363),
        "(591ms)LCK_M_U": ("LCK_M_U", 1, 591),
        "(5ms)PAGEIOLATCH_SH, (3x: 1/2/9ms)LCK_M_X": ("LCK_M_X", 3, 9),
        None: None,
        "(5ms)PAGEIOLATCH_SH": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "w string").select("w", text.lock_wait("w").alias("l"))
    assert {r["w"]: tuple(r["l"]) if r["l"] else None for r in df.collect()} == cases


def test_boundaries_and_rounding(spark):
    a, b = F.lit("2024-01-01 00:00:59").cast("timestamp_ntz"), F.lit("2024-01-01 00:01:01").cast("timestamp_ntz")
    assert one(spark, clock.datediff_boundary("minute", a, b), clock.datediff_boundary("hour", a, b)) == (1, 0)
    up = F.lit("2024-01-01 00:00:30").cast("timestamp_ntz")
    assert one(spark, clock.to_smalldatetime(up).cast("string")) == ("2024-01-01 00:01:00",)
    assert one(spark, clock.hhmmss_to_minutes(F.lit(1002930)), clock.hhmmss_to_minutes(F.lit(1002930), "plus31")) == (100 * 60 + 30, 100 * 60 + 30)
    assert one(spark, clock.hhmmss_to_minutes(F.lit(29)), clock.hhmmss_to_minutes(F.lit(30)), clock.hhmmss_to_minutes(F.lit(29), "plus31")) == (0, 1, 1)
    assert one(spark, units.int_div(F.lit(-7), F.lit(2)), units.int_div(F.lit(7), F.lit(0))) == (-3, None)
    assert one(spark, clock.fmt_duration(F.lit(93784)), clock.parse_duration(F.lit("01 02:03:04.500"))) == ("01 02:03:04", 93784)


def test_names_and_sizes(spark):
    assert one(spark, text.name_part(F.lit("srv.[db].dbo.t"), 1), text.name_part(F.lit("srv.[db].dbo.t"), 3), text.name_part(F.lit("t"), 2)) == ("t", "db", None)
    assert one(spark, text.host(F.lit("h1.corp.net\\I2")), text.domain(F.lit("h1.corp.net\\I2")), text.instance(F.lit("h1.corp.net"))) == ("h1", "corp.net", None)
    assert one(spark, text.like_class(F.lit("E:\\Data7\\"), "[A-Z]:\\Data[0-9]\\"), text.like_class(F.lit("E:\\Datax\\"), "[A-Z]:\\Data[0-9]\\")) == (True, False)
    assert one(spark, units.parse_size(F.lit("2 MB")), units.fmt_size(F.lit(3 * 1024**3 + 5)), units.fmt_size(F.lit(0))) == (2 * 1024**2, "3 gb", "0")
    assert one(spark, text.statement_slice(F.lit("select 1"), F.lit(0), F.lit(-1)), text.statement_slice(F.lit("select 1"), F.lit(2), F.lit(6))) == ("select 1", "ele")


def counter(spark, points):
    return spark.createDataFrame([("s", at(m), v) for m, v in points], "k string, ts timestamp_ntz, v bigint")


def test_resets_and_gaps(spark, rows):
    df = counter(spark, [(0, 10), (5, 30), (10, 4), (71, 9), (72, 12)])
    delta = lambda **kw: [tuple(r) for r in tm.counter_delta(df, ["k"], "ts", ["v"], **kw).orderBy("ts").select("v", "v_delta").collect()]
    assert delta() == [(30, 20), (4, -26), (12, 3)]  # the 61-minute gap is left out
    assert delta(on_reset="drop") == [(30, 20), (12, 3)]
    assert delta(on_reset="restart") == [(10, 0), (30, 20), (4, 4), (9, 5), (12, 3)]
    assert delta(max_gap=None) == [(30, 20), (4, -26), (9, 5), (12, 3)]


def test_sum_of_deltas_is_last_minus_first(spark):
    df = counter(spark, [(i, i * i) for i in range(0, 300, 7)])
    total = tm.counter_delta(df, ["k"], "ts", ["v"], on_reset="drop").agg(F.sum("v_delta")).first()[0]
    assert total == 294**2


@pytest.mark.parametrize("clears, want", [([], [(1, 90)]), ([30], [(1, 20), (2, 50)]), ([30, 60], [(1, 20), (2, 10), (3, 20)])])
def test_wait_delta_splits_at_clears(spark, clears, want):
    snaps = spark.createDataFrame(
        [(1, at(m), "LCK", m * 1000, 0, m + 1) for m in range(0, 100, 10)],
        "s int, t timestamp_ntz, wait_type string, wait_time_ms bigint, signal_wait_time_ms bigint, waiting_tasks_count bigint")
    clear = spark.createDataFrame([(1, at(c)) for c in clears] + [(1, None)], "s int, c timestamp_ntz")
    d = tm.wait_delta(snaps, clear, ["s"], "t", "c", F.lit(T0), F.lit(at(90)))
    # edges at clear times are exclusive, the outer two inclusive
    assert sorted((r["range_id"], r["wait_time_ms"] // 1000) for r in d.collect()) == want


def test_blocking_tree_with_cycle_and_two_heads(spark):
    edges = [(1, None), (2, 1), (3, 2), (1000, None), (1001, 1000), (7, 8), (8, 7), (9, 7), (5, 5), (6, 5), (4, None)]
    df = spark.createDataFrame([(T0, a, b) for a, b in edges], "collection_time timestamp_ntz, session_id bigint, blocking_session_id bigint").withColumns(
        {"sql_command": F.lit("q"), "wait_info": F.lit("(7000ms)LCK_M_S")})
    tree = {r["session_id"]: r for r in ss.blocking_tree(df).collect()}
    assert {k for k, r in tree.items() if r["cycle"]} == {7, 8, 9}
    assert tree[3]["depth"] == 2 and tree[3]["head"] == 1 and tree[6]["head"] == 5
    assert 4 not in tree  # blocks nobody
    assert tree[1]["path"] < tree[2]["path"] < tree[3]["path"] < tree[1000]["path"]
    assert tree[2]["blocking_tree"].endswith("|------  2 q") and tree[1]["blocking_tree"].strip().startswith("HEAD -  1")
    below = {r["session_id"]: r["blocked_session_count"] for r in ss.blocked_count(df).collect()}
    assert below == {1: 2, 2: 1, 1000: 1, 5: 1, 7: 2, 8: 2}


def forest(spark, pairs, key=1):
    return spark.createDataFrame([(key, n, p) for n, p in pairs], "s int, n bigint, p bigint")


def walk(pairs):
    """(depth, head) of nodes under a head, nodes on or under a cycle, and nodes under every node, one step at a time."""
    up = {}
    for n, p in sorted(pairs, key=lambda x: (x[1] is None, x[1] == x[0], x[1] or 0)):
        up.setdefault(n, p)
    parents = {p for n, p in up.items() if p is not None and p != n}
    reached, cyclic, below = {}, set(), {}
    for n in up:
        seen, at = [n], n
        while up.get(at) is not None and up[at] != at and up[at] not in seen:
            at = up[at]
            seen.append(at)
            below.setdefault(at, set()).add(n)
        if at in up and (up[at] is None or up[at] == at):
            if at in parents:
                reached[n] = (len(seen) - 1, at)
        elif at in up:
            cyclic.add(n)
    return reached, cyclic, {k: len(v - {k}) for k, v in below.items() if v - {k}}


def test_hierarchies_of_any_shape(spark):
    import random

    rng = random.Random(5)
    shapes = [
        [(i, i - 1 if i > 1 else None) for i in range(1, 200)], [(i, i // 2 or None) for i in range(1, 300)], [(i, 1 if i > 1 else None) for i in range(1, 300)],
        [(i, i % 7 + 1) for i in range(1, 8)] + [(100 + i, 99 + i if i else 3) for i in range(60)], [(1, 1), (2, 1), (3, 77), (4, 3)], [(5, None)], [(1, 2), (2, 1), (1, 2)],
        [(i, rng.randrange(1, 150) if rng.random() < 0.97 else None) for i in range(1, 150)], [(i, rng.randrange(1, i) if i > 1 else None) for i in range(1, 200)] * 2,
    ]
    df = reduce(DataFrame.unionByName, [forest(spark, x, k) for k, x in enumerate(shapes)]).unionByName(
        spark.createDataFrame([(None, 1, None), (None, 2, 1)], "s int, n bigint, p bigint"))
    tree, below, up = {}, {}, {}
    for r in rs.hierarchy(df, ["s"], "n", "p").collect():
        assert (r["s"], r["node"]) not in tree
        tree[r["s"], r["node"]] = r
    for r in rs.below_counts(df, ["s"], "n", "p").collect():
        below[r["s"], r["node"]] = r["below"]
    seeds = df.filter("n % 10 = 3").select("s", F.col("n").alias("node"))
    for r in rs.ancestors(df, ["s"], "n", "p", seeds).collect():
        up.setdefault(r["s"], set()).add(r["node"])
    for k, pairs in [*enumerate(shapes), (None, [(1, None), (2, 1)])]:
        reached, cyclic, under = walk(pairs)
        assert {n: (r["depth"], r["head"]) for (s, n), r in tree.items() if s == k and r["head"] is not None} == reached
        assert {n for (s, n), r in tree.items() if s == k and r["cycle"]} == cyclic
        assert {n: v for (s, n), v in below.items() if s == k} == under
        for (s, n), r in tree.items():
            if s == k and r["depth"]:
                assert r["path"].startswith(tree[s, r["parent"]]["path"]) and len(r["path"]) == 10 * (r["depth"] + 1)
        want, todo = set(), [n for n, _ in pairs if n % 10 == 3]
        while todo:
            n = todo.pop()
            if n not in want:
                want.add(n)
                todo += [p for m, p in pairs if m == n and p is not None]
        assert up.get(k, set()) == want


def test_chain_of_five_thousand_nodes(spark, monkeypatch):
    chain = forest(spark, [(i, i - 1 if i > 1 else None) for i in range(1, 5001)] + [(9001, 9002), (9002, 9001)])
    rounds = []
    monkeypatch.setattr(rs, "durable", lambda df, f=rs.durable: rounds.append(1) or f(df))
    top = rs.hierarchy(chain, ["s"], "n", "p").agg(F.max("depth"), F.sum(F.col("cycle").cast("int")), F.max(F.length("path"))).first()
    assert tuple(top) == (4999, 2, 50_000) and len(rounds) < 20
    rounds.clear()
    got = {r["node"]: r["below"] for r in rs.below_counts(chain, ["s"], "n", "p").collect()}
    assert got == {**{i: 5000 - i for i in range(1, 5000)}, 9001: 1, 9002: 1} and len(rounds) < 100
    assert rs.ancestors(chain, ["s"], "n", "p", chain.filter("n = 4321").select("s", F.col("n").alias("node"))).count() == 4321


def test_paths_of_long_ids_sort_like_the_ids(spark):
    ids = [7, 10**9, 9_999_999_990, 10**10, 123456789012, 999999999999, 10**18]
    path = {r["node"]: r["path"] for r in rs.hierarchy(forest(spark, [(1, None)] + [(i, 1) for i in ids] + [(i + 1, i) for i in ids]), ["s"], "n", "p").collect()}
    order = sorted(path, key=lambda n: path[n])
    assert order == [1] + [x for i in ids for x in (i, i + 1)]


def test_consecutive_failures(spark):
    runs = {"never": [0, 0, 0], "newest ok": [0, 0, 1], "two": [0, 1, 0, 0], "other": [1, 3, 0]}
    df = spark.createDataFrame([(j, i, s) for j, ss_ in runs.items() for i, s in enumerate(ss_)], "j string, id int, st int")
    got = {r["j"]: r["failures"] for r in al.consecutive_failures(df, "j", "id", "st").collect()}
    assert got == {"never": 3, "newest ok": 0, "two": 2, "other": 2}
    compat = {r["j"]: r["failures"] for r in al.consecutive_failures(df, "j", "id", "st", compat=True).collect()}
    assert compat["never"] == 0


def test_flapping(spark):
    states = {"flaps": "ABBBABBBABBB", "steady": "AAAAAAAAAAAA", "wild": "ABABABABABAB"}
    df = spark.createDataFrame([(k, at(i * 5), s) for k, x in states.items() for i, s in enumerate(x)], "c string, ts timestamp_ntz, s string")
    log = al.status_changes(df, "c", "ts", "s")
    got = {r["c"]: r["is_flapping"] for r in al.flapping(log, "c", "ts", F.lit(at(60))).collect()}
    assert got == {"flaps": True, "steady": False, "wild": False}


def test_lost_tokens(spark):
    df = spark.createDataFrame([(1, "p", at(0), False), (2, "p", at(5), True), (3, "p", at(9), False), (4, "q", at(0), False)],
                               "id int, publication string, publisher_commit timestamp_ntz, is_processed boolean")
    assert {r["id"] for r in al.close_lost(df).filter("lost").collect()} == {1}


def test_not_in(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    values = lambda *v: spark.createDataFrame([(i,) for i in v], "y int")
    got = lambda other: [r[0] for r in jn.not_in(df, "x", other, "y").collect()]
    assert got(values(1)) == [2]
    assert got(values(1, None)) == []
    assert sorted(got(values().limit(0)), key=str) == [1, 2, None]


def test_contains_join_matches_brute_force(spark):
    docs = ["the quick brown fox", "a.b/c d-e", "xyz", "quick", "brown fox jumps over", "über größe straße", "aaaaaaaa"]
    terms = ["quick brown fox", "b/c d", "y", "fox jumps ov", "größe", "quick", "aaaaaaa", "zz", "ö"]
    d = spark.createDataFrame(list(enumerate(docs)), "id int, txt string")
    t = spark.createDataFrame(list(enumerate(terms)), "tid int, term string")
    want = {(i, j) for i, x in enumerate(docs) for j, y in enumerate(terms) if y in x}
    for limit in (100, 0):  # listed terms, then the token and q-gram joins
        assert {tuple(r) for r in jn.contains_join(d, "id", "txt", t, "tid", "term", max_terms=limit).collect()} == want


def test_longest_prefix(spark):
    p = spark.createDataFrame([(1, "E:/a/b/c.mdf"), (2, "E:/x.mdf"), (3, "F:/a/q"), (4, "noslash")], "id int, path string")
    v = spark.createDataFrame([("E:/", 1), ("E:/a/", 2), ("E:/a/b/", 3)], "vol string, cap int")
    got = {r["id"]: r["cap"] for r in jn.longest_prefix_join(p, "id", "path", v, "vol", ["cap"], "/").collect()}
    assert got == {1: 3, 2: 1, 3: None, 4: None}


def test_rollup_truncates_and_tiers_do_not_overlap(spark):
    df = spark.createDataFrame([(at(m), "c", m) for m in range(0, 60 * 24 * 12, 30)], "ts timestamp_ntz, k string, v bigint")
    assert ro.rollup_avg(df.limit(2), ["k"], "ts", 60, ["v"]).first()["v"] == 15
    policy = ro.TierPolicy([ro.Tier("raw", 0, 2), ro.Tier("hour", 60, 5)], ["k"], "ts", ["v"])
    tiers = {n: d.agg(F.count("*"), F.min("ts"), F.max("ts")).first() for n, d in policy.apply(df, F.lit(T0 + timedelta(days=12))).items()}
    assert tiers["raw"][0] == 96 and tiers["hour"][0] == 72
    assert tiers["hour"][2] < tiers["raw"][1]


def test_selector_grammar(spark):
    df = spark.createDataFrame([("master", "S"), ("sales", "U"), ("sales_old", "U"), ("hr", "U")], "n string, k string")
    pick = lambda e: sorted(r["n"] for r in rs.select_names(df, "n", "k", e).collect())
    assert pick("USER, -sales%") == ["hr"]
    assert pick("ALL,-[hr]") == ["master", "sales", "sales_old"]
    assert pick("sales") == ["sales"] and pick("-hr") == []


def test_terms_with_one_beginning_meet_on_different_keys(spark):
    """Terms are filed under their rarest piece; equal beginnings and common words are no common key."""
    terms = [f"commonbeginning{i:05}" for i in range(3000)] + [f"in the word{i} of it" for i in range(500)]
    docs = [f"x {terms[i]} y in the of it" for i in range(0, 3500, 7)] + ["commonbeginning", "in the word of it"]
    d = spark.createDataFrame(list(enumerate(docs)), "id int, txt string")
    t = spark.createDataFrame(list(enumerate(terms)), "tid int, term string")
    got = sorted(tuple(r) for r in jn.contains_join(d, "id", "txt", t, "tid", "term", max_terms=0).collect())
    assert got == sorted((i, j) for i, x in enumerate(docs) for j, y in enumerate(terms) if y in x)


def test_signatures_tell_lists_apart(spark):
    lists = {"a": ["x", "y"], "b": ["y", "x"], "c": ["x,y"], "d": ["x", "y"], "e": ["x", None], "f": ["x"], "g": ["x", ""], "h": ["x", "x"]}
    rows_ = [(k, 10 * i if k == "d" else i, x) for k, v in lists.items() for i, x in enumerate(v)] + [(None, 0, "x"), (None, 1, "y")]
    df = spark.createDataFrame(rows_, "k string, i int, x string")
    sig = {r["k"]: r["signature"] for r in rs.signature(df, ["k"], "x", "i").collect()}
    assert sig["a"] == sig["d"] == sig[None] and len(set(sig.values())) == 7


def test_signature_report_lists_every_item_in_order(spark, tmp_path):
    from opskit.plans import catalog

    rows_ = [(1, 3, "R"), (1, 1, "A"), (1, 1, "N"), (1, 2, None), (2, 1, "x,y"), (3, 1, "x"), (3, 2, "y"), (4, None, "\\"), (None, 7, "")]
    spark.createDataFrame(rows_, "l_suppkey bigint, l_linenumber int, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r["l_suppkey"]: r["signature"] for r in catalog.QUERIES["H16_signature"](spark, str(tmp_path)).collect()}
    assert got == {1: "N,\\N,R", 2: "x\\,y", 3: "x,y", 4: "\\\\", None: ""}
    import duckdb

    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW lineitem AS FROM '{tmp_path}/lineitem.parquet/*.parquet'")
        assert dict(con.sql(catalog.SQL["H16_signature"]).fetchall()) == got


def test_pivot_of_three_thousand_labels(spark):
    df = spark.range(6000).selectExpr("id % 2 as k", "if(id = 5999, null, concat('c', lpad(id div 2, 4, '0'))) as label", "id as v")
    d = rs.pivot_dynamic(df, ["k"], "label", F.max("v"))
    assert len(d.columns) == 3002
    rows_ = {r["k"]: r for r in d.collect()}
    assert rows_[0]["c0000"] == 0 and rows_[1]["c1234"] == 2469 and rows_[0]["c2999"] == 5998 and rows_[1]["c2999"] is None and rows_[1]["null"] == 5999


def test_thresholds(spark):
    rules = [(">90", 91.0, True), (">90", 90.0, False), ("<>1", 2.0, True), ("=3", 3.0, True), ("<=5", 5.0, True), ("", 5.0, False)]
    df = spark.createDataFrame(rules, "t string, v double, want boolean")
    assert df.filter(al.breaches("t", "v") != F.col("want")).count() == 0


def test_cumulative_tiers_keep_every_series(spark):
    df = spark.createDataFrame([(at(0), "s1", 1), (at(0.05), "s2", 2), (at(5), "s1", 3)], "ts timestamp_ntz, k string, v bigint")
    policy = ro.TierPolicy([ro.Tier("hour", 60, 5)], ["k"], "ts", ["v"], gauge=False)
    got = policy.apply(df, F.lit(T0 + timedelta(days=1)))["hour"].collect()
    assert sorted((r.k, r.v) for r in got) == [("s1", 1), ("s2", 2)]


def test_job_names_by_the_last_ten_hex_digits(spark):
    programs = spark.createDataFrame([("Agent - JobStep 0xFFEEab12CD34ef56 : 1",), ("app",), ("Agent - JobStep 0x000000000F : 2",)], "program string")
    jobs = spark.createDataFrame([("0012CD34EF56", "nightly"), ("f", "short")], "id string, name string")
    got = sorted(r.program for r in ss.resolve_job_name(programs, "program", jobs, "id", "name").collect())
    assert got == ["Job = nightly", "Job = short", "app"]


def test_long_ids_are_not_cut(spark):
    got = [r[0] for r in spark.createDataFrame([(123456789012,), (7,)], "i bigint").select(text.pad_id("i")).collect()]
    assert got == ["123456789012", "0000000007"]
