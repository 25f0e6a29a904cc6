"""Sinks, sources and streams: round trips, repeats and late rows."""

import re
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from opskit.sources import readers as rd
from opskit.sources import writers as wr
from opskit.streaming import ingest as ing
from opskit.streaming import stateful as st

T0 = datetime(2024, 1, 1)


def test_append_new_is_idempotent(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    for _ in range(3):
        wr.append_new(df, path, ["k"])
    assert len(rows(spark.read.parquet(path))) == 3


@pytest.fixture
def staged(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c"), (None, None)], "k int, v string")
    df.repartition(3).write.parquet(str(tmp_path / "s"))
    return df, str(tmp_path / "s"), str(tmp_path / "h")


def test_archive_keeps_every_row(spark, staged, rows):
    df, staging, history = staged
    wr.archive_and_clear(spark, staging, history)
    wr.archive_and_clear(spark, staging, history)  # nothing is staged: no batch is written
    assert rows(spark.read.parquet(history).select("k", "v")) == rows(df)
    assert spark.read.parquet(staging).count() == 0 and len(list(Path(history).glob("batch=*"))) == 1
    df.coalesce(1).write.mode("append").parquet(staging)
    wr.archive_and_clear(spark, staging, history)
    assert spark.read.parquet(history).count() == 10 and spark.read.parquet(staging).count() == 0
    assert len(list(Path(staging).glob("part-*"))) == 1 and not list(Path(history, "_moves").iterdir())


@pytest.mark.parametrize("arrives", [False, True])
def test_archive_dies_after_every_step(spark, staged, rows, tmp_path, arrives):
    """Killed after step 1, 2, 3, ... and run again: every row is archived once."""
    df, staging, history = staged
    names = list(wr.archive_steps(spark, staging, history))
    assert [n for i, n in enumerate(names) if n not in names[:i]] == ["manifest", "listed", "batch", "copied", "schema", "cleared", "closed"]
    for dies in range(1, len(names) + 1):
        staging, history = str(tmp_path / f"s{dies}"), str(tmp_path / f"h{dies}")
        df.repartition(3).write.parquet(staging)
        steps = wr.archive_steps(spark, staging, history)
        for _ in range(dies):
            next(steps)
        steps.close()
        if arrives:
            spark.createDataFrame([(9, "late")], "k int, v string").coalesce(1).write.mode("append").parquet(staging)
        wr.archive_and_clear(spark, staging, history)
        want = rows(df) + ([(9, "late")] if arrives else [])
        assert rows(spark.read.parquet(history).select("k", "v")) == sorted(want, key=repr), names[dies - 1]
        assert spark.read.parquet(staging).count() == 0


def test_archive_of_a_partitioned_table(spark, tmp_path, rows):
    staging, history = str(tmp_path / "s"), str(tmp_path / "h")
    spark.createDataFrame([(1, "a b/c"), (2, "d")], "k int, day string").write.partitionBy("day").parquet(staging)
    wr.archive_and_clear(spark, staging, history)
    assert rows(spark.read.parquet(history).select("k", "day")) == [(1, "a b/c"), (2, "d")]


def test_replace_table_with_its_own_content(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.range(4).write.parquet(path)
    wr.replace_table(spark.read.parquet(path).filter("id > 1"), path)
    assert rows(spark.read.parquet(path)) == [(2,), (3,)]


def test_merge_and_upsert(spark, rows):
    t = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (4, "z")], "k int, v string")
    s = spark.createDataFrame([(2, "Y"), (3, None), (4, None), (5, "n")], "k int, v string")
    assert rows(wr.merge_full(t, s, ["k"], ["v"])) == [
        (1, "x", "delete"), (2, "Y", "update"), (3, None, "keep"), (4, None, "update"), (5, "n", "insert")]
    up = wr.upsert_changed(t, s, "k", ["v"], F.lit("now"))
    assert rows(up) == [(1, "x", None), (2, "Y", "now"), (3, None, None), (4, "z", None)]


def test_purge_drops_whole_days(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(5).withColumn("date", F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")))
    days.write.partitionBy("date").parquet(path)
    assert wr.purge(spark, path, "2024-01-03") == ["2024-01-01", "2024-01-02"]
    assert spark.read.parquet(path).count() == 3


def test_batch_load_tolerance(spark, rows):
    target = spark.createDataFrame([("a", T0, 3)], "k string, t timestamp_ntz, batch_number bigint")
    staged = spark.createDataFrame(
        [("a", T0 + timedelta(minutes=1), 1), ("a", T0 + timedelta(minutes=2), 2), ("a", T0 + timedelta(minutes=2), 3), ("b", T0, 4)], "k string, t timestamp_ntz, id int")
    got = wr.load_batch(target, staged, ["k"], "t", "id").select("k", "id", "batch_number")
    assert rows(got) == [("a", 2, 4), ("b", 4, 4)]


def test_fan_out_reports_failures(spark, tmp_path):
    """Missing when planned, broken when read, failing when computed: the others complete."""
    path, broken = str(tmp_path / "ok"), tmp_path / "broken"
    spark.range(3).write.parquet(path)
    spark.range(8).repartition(4).write.parquet(str(broken))
    next(broken.glob("part-*")).write_text("no parquet")
    sources = {"a": path, "b": str(tmp_path / "none"), "c": str(broken), "d": path, "e": path}
    seen = []

    def query(p):
        seen.append(p)
        d = spark.read.schema("id bigint").parquet(p)
        return d.select((1 / (F.col("id") - 1)).cast("bigint").alias("id")) if seen.count(path) == 2 and p == path else d

    good, bad = rd.fan_out(spark, sources, query, at_once=1)
    failed = {r["source_name"]: r["error"] for r in bad.collect()}
    assert {r["source_name"] for r in good.collect()} == {"a", "e"} and good.count() == 6
    assert set(failed) == {"b", "c", "d"} and all(failed.values())


def test_documents_have_one_shape_at_any_size(spark, tmp_path):
    df = spark.range(60_000).selectExpr("if(id < 50000, 'hot \"&\" one', concat('p', id % 7)) as p", "id as c", "if(id % 3 = 0, null, 'a<b\n') as t")
    wr.write_documents(df.repartition(5), str(tmp_path / "d"), ["p"], ["c", "t"], "parent", "child")
    lines = [x for f in sorted((tmp_path / "d").glob("part-*")) for x in f.read_text().splitlines()]
    assert len(lines) == 60_000 + 2 * 8 and max(map(len, lines)) < 100 and lines[1] == '  <child c="0"/>'
    docs = [r["text"] for r in rd.read_documents(spark, str(tmp_path / "d"), "parent").collect()]
    hot = next(x for x in docs if x.startswith('<parent p="hot &quot;&amp;&quot; one">'))
    assert len(docs) == 8 and hot.count("<child ") == 50_000 and hot.endswith("</parent>") and '  <child c="1" t="a&lt;b&#10;"/>' in hot


def test_xml_events_are_numbered(spark, tmp_path):
    df = spark.range(50).select(F.col("id").alias("_id"), F.concat(F.lit("n"), "id").alias("name"))
    wr.write_xml_events(df.repartition(3), str(tmp_path / "x"))
    got = rd.read_xml_events(spark, str(tmp_path / "x"), "event", "_id bigint, name string").collect()
    assert sorted(r["event_no"] for r in got) == list(range(1, 51)) and {r["_id"] for r in got} == set(range(50))


def test_xml_events_are_numbered_in_their_files(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("_id"), F.concat(F.lit("n "), "id").alias("name"), F.array(F.lit("a"), F.lit(None)).alias("tag"))
    path = tmp_path / "x"
    wr.write_xml_events(df.repartition(5, "id"), str(path))
    files = sorted(path.glob("part-*"))
    assert sum(len(f.read_text().splitlines()) for f in files) <= 1000 + 3 * len(files)  # no indentation
    ids = [int(x) for f in files for x in re.findall(r'<event id="(\d+)"', f.read_text())]
    schema = "_id bigint, name string, tag array<string>"
    whole, some = rd.read_xml_events(spark, str(path), "event", schema), rd.read_xml_events(spark, str(path), "event", schema, columns=["_id"])
    assert whole.columns == ["_id", "name", "tag", "file", "event_no"] and some.columns == ["_id", "file", "event_no"]
    for d in (whole, some):
        assert [r["_id"] for r in d.orderBy("event_no").collect()] == ids and d.agg(F.max("event_no")).first()[0] == 1000
    assert {(r["_id"], r["name"]) for r in whole.collect()} == {(i, f"n {i}") for i in range(1000)}


@pytest.fixture
def small_splits(spark):
    """Files are read by splits of 100 bytes, so that records lie across several of them."""
    names = {"spark.sql.files.maxPartitionBytes": "100b", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("max_open", [100_000, 0])
def test_trace_is_read_by_many_tasks_like_by_one(spark, tmp_path, rows, small_splits, monkeypatch, max_open):
    import random
    from functools import partial

    from opskit.sources import records as rc

    rng = random.Random(2)
    words = ['say ""x""', "a\nb", "\n", ",", "select 1", " ", "é", '""', "\n\n-- " + "long " * 60]
    for f in range(2):
        out = ["statement,executions,cpu,reads,writes,duration,event_class"]
        for i in range(120):
            text = "".join(rng.choice(words) for _ in range(rng.randrange(5)))
            out.append(f'"{text}",{i},{i},{f},,5,41' if i % 3 else f"plain {i},{i},{i},{f},,5,41")
        (tmp_path / f"t{f}.csv").write_text("\n".join(out) + ("\n" if f else ""))
    (tmp_path / "empty.csv").write_text("")
    monkeypatch.setattr(rd, "records", partial(rc.records, max_open=max_open))
    got = rd.read_trace(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path / "t0.csv")).rdd.getNumPartitions() > 50
    want = spark.read.csv(str(tmp_path), schema=got.schema, header=True, multiLine=True, escape='"')
    assert rows(got) == rows(want) and got.count() == 240


def test_log_entries_across_splits(spark, tmp_path, rows, small_splits):
    lines, want = ["lost line"], []
    for i in range(200):
        more = [f"  detail {i} {k} " + "x" * (i % 7 * 40) for k in range(i % 4)] + ([""] if i % 5 == 0 else [])
        text = f"Error {i % 10}"
        lines += [f"2024-01-01 00:{i // 60:02}:{i % 60:02}.5  spid{i}   {text}", *more]
        want.append((T0 + timedelta(seconds=i, microseconds=500_000), f"spid{i}", "\n".join([text, *more])))
    (tmp_path / "a.log").write_text("\n".join(lines[:300]) + "\n")
    (tmp_path / "b.log").write_text("\n".join(lines[300:]) + "\n")
    assert rows(rd.read_log(spark, str(tmp_path))) == sorted(want, key=repr)
    late = rd.read_log(spark, str(tmp_path), ["Error 3", "detail"], F.lit(T0 + timedelta(seconds=50)).cast("timestamp_ntz"))
    assert rows(late) == sorted([w for i, w in enumerate(want) if i >= 50 and "Error 3" in w[2] and "detail" in w[2]], key=repr)
    plan = late._jdf.queryExecution().simpleString()
    assert "rangepartitioning" not in plan


def feed(spark, path, batches, schema):
    for rows_ in batches:
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(path)
    return ing.file_stream(spark, path, spark.createDataFrame([], schema).schema, "ts", 1)


SCHEMA = "k string, ts timestamp_ntz, v bigint, id bigint"


def test_delta_continues_over_batches_and_flags_late_rows(spark, tmp_path):
    at = lambda m: T0 + timedelta(minutes=m)
    batches = [[("a", at(0), 5, 1), ("a", at(1), 9, 2)], [("a", at(2), 3, 3), ("b", at(0), 7, 4)], [("a", at(1), 8, 5), ("b", at(3), 10, 6)]]
    stream = feed(spark, str(tmp_path / "in"), batches, SCHEMA)
    st.run_stateful(stream, st.delta_step(["k"], "ts", "v", "id"), str(tmp_path / "cp"), str(tmp_path / "state"), str(tmp_path / "out"))
    got = {r["id"]: (r["delta"], r["late"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: (0, False), 2: (4, False), 3: (3, False), 4: (0, False), 5: (None, True), 6: (3, False)}


def suppressed(batches, gap):
    """Notices and late alerts, one alert after the other."""
    last, sent, late = {}, [], []
    for batch in batches:
        before, first = dict(last), {}
        for k, m, s in sorted(batch, key=lambda x: x[1:]):
            if k in before and m < before[k]:
                late.append((k, m, s, True))
                continue
            first.setdefault((k, m), s)
        for k, m in sorted(first, key=lambda x: x[1]):
            if k not in last or m - last[k] >= gap:
                last[k] = m
                sent.append((k, m, first[k, m], False))
    return sorted(sent + late, key=repr)


def test_suppression_over_batches_flags_late_alerts(spark, tmp_path):
    import random

    rng = random.Random(3)
    batches = [[("a", 0, 0), ("a", 4, 1), ("a", 9, 0), ("a", 10, 1), ("a", 10, 0)], [("a", 11, 2), ("a", 19, 1), ("a", 3, 0), (None, 5, 0)], [("a", 20, 1), ("a", 21, 0), ("a", 35, 2), (None, 1, 7)]]
    for i in range(3):
        batches[i] += [(rng.choice(["hot", "hot", "hot", "b", "c"]), rng.randrange(100 * i, 100 * i + 130), rng.randrange(60)) for _ in range(150)]
    rows_ = [[(k, T0 + timedelta(minutes=m, seconds=s), 0, i) for i, (k, m, s) in enumerate(b)] for b in batches]
    stream = feed(spark, str(tmp_path / "in"), rows_, SCHEMA)
    st.run_stateful(stream, st.suppress_step("k", "ts", 10), str(tmp_path / "cp"), str(tmp_path / "state"), str(tmp_path / "out"))
    got = []
    for r in spark.read.parquet(str(tmp_path / "out")).collect():
        at = int((r["ts"] - T0).total_seconds())
        got.append((r["k"], at // 60, at % 60, r["late"]))
    assert sorted(got, key=repr) == suppressed(batches, 10) and any(x[3] for x in got)


def test_stream_restart_continues(spark, tmp_path):
    path = str(tmp_path / "in")
    args = [str(tmp_path / x) for x in ("cp", "state", "out")]
    first = feed(spark, path, [[("a", T0, 5, 1)]], SCHEMA)
    st.run_stateful(first, st.delta_step(["k"], "ts", "v", "id"), *args)
    second = feed(spark, path, [[("a", T0 + timedelta(minutes=1), 12, 2)]], SCHEMA)
    st.run_stateful(second, st.delta_step(["k"], "ts", "v", "id"), *args)
    assert {r["id"]: r["delta"] for r in spark.read.parquet(args[2]).collect()} == {1: 0, 2: 7}


@pytest.mark.parametrize("step, n", [(10, 7), (60, 2)])
def test_time_dimension(spark, step, n):
    d = rd.time_dimension(spark, T0, T0 + timedelta(seconds=60), step)
    assert d.count() == n and d.agg(F.max("time")).first()[0] == T0 + timedelta(seconds=60)
