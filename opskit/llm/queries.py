"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opskit.llm import chat, decontaminate, disclosure, filter_audit, langid, licences, line_dedup, merkle, minhash, outliers, packing, suffix_dedup, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_mcd_outliers")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(table(spark, sf_dir, "documents"))


@query("op2_disclosure_sanitisation")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.report(table(spark, sf_dir, "documents"))


@query("op3_ftrl_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op4_prefix_target_expansion",
    r"""
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
      UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    e AS (
      SELECT *, 24 + length(role) + length(regexp_replace(text,
          '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g')) AS size,
        row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
    f AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM e)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
      coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
      (sum(upto) FILTER (role = 'assistant' OR k = n))::BIGINT AS formatted_chars
    FROM f GROUP BY conv_id
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", hard), (-7, 1, "assistant", hard)]
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(chat.examples(turns.unionByName(extra)))


@query("op5_hyperdimensional_language")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.held_out_predictions(table(spark, sf_dir, "documents"))


@query("op6_deep_shallow_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents")).drop("kept")


@query("op7_line_run_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


@query("op8_vector_best_fit")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op9_bm25_wand_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op10_tensored_minhash",
    r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
      FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]) END AS sh FROM w),
    n AS (SELECT doc_id, len(sh)::BIGINT AS n_shingles FROM s),
    e AS (SELECT doc_id, unnest(sh) AS g FROM s),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
        WHERE 100 * inter >= 75 * (x.n_shingles + y.n_shingles - inter)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
    SELECT n.doc_id, n.n_shingles, m.component_id, n.doc_id = m.component_id AS kept
    FROM n JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) m USING (doc_id)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.links(table(spark, sf_dir, "documents"))


@query(
    "op11_potential_audit",
    r"""
    WITH t AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    d AS (
      SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        (CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END)
        || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END)
        || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
        || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS failed
      FROM t LEFT JOIN l USING (doc_id)),
    c AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY ALL),
    f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
    o AS (SELECT a.f || b.f || x.f || y.f || z.f AS filter_order FROM f a, f b, f x, f y, f z
      WHERE len(list_distinct([a.f, b.f, x.f, y.f, z.f])) = 5),
    s AS (SELECT filter_order, step::INTEGER AS step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS earlier
      FROM o, range(1, 6) r(step)),
    r AS (
      SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (translate(failed, earlier || f, '') = failed), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (contains(failed, f) AND translate(failed, earlier, '') = failed), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (contains(failed, f) AND translate(failed, earlier, '') <> failed), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (failed = f), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (contains(failed, f) AND translate(failed, earlier, '') = failed), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (contains(failed, f) AND translate(failed, earlier, '') = failed), 0)::BIGINT AS toxic_lost
      FROM c, s GROUP BY ALL)
    SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _merkle_sql(levels: int) -> str:
    """Levels one by one, first inside sources, then over them; a tree of one node stays as it is."""

    def tree(name: str, start: str, value: str) -> tuple[str, str]:
        ctes, last = [], start
        for k in range(levels):
            run = "PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN"
            ctes.append(f"""{name}{k} AS (SELECT tree, pos, h, count(*) OVER (PARTITION BY tree) AS n,
                coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {last})""")
            last = (f"(SELECT tree, pos // 16 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(h) "
                    f"ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {name}{k} GROUP BY tree, pos // 16)")  # fmt: skip
        ctes.append(f"{name}root AS (SELECT tree, h FROM {last})")
        joins = " ".join(f"JOIN {name}{k} ON {name}{k}.tree IS NOT DISTINCT FROM {value}.tree AND {name}{k}.pos = {value}.pos // {16**k}" for k in range(levels))
        return ", ".join(ctes), joins

    sub, sub_joins = tree("a", "leaves", "leaves")
    top, top_joins = tree("b", "places", "places")
    fold, proof = "CASE WHEN tampered THEN changed ELSE h END", []
    steps = []
    for name in [f"a{k}" for k in range(levels)] + [f"b{k}" for k in range(levels)]:
        proof.append(f"{name}l || {name}r")
        steps.append(name)
    picked = lambda names: ", ".join(f"{x}.n AS {x}n, {x}.l AS {x}l, {x}.r AS {x}r" for x in names)
    a, b = steps[:levels], steps[levels:]
    chain, last = [], "whole"
    for i, x in enumerate(steps):
        chain.append(f"f{i} AS (SELECT * REPLACE (CASE WHEN {x}n = 1 THEN v ELSE sha256({x}l || v || {x}r) END AS v) FROM {last})")
        last = f"f{i}"
    return f"""
    WITH crc AS (
      SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
        coalesce(xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(doc_id::VARCHAR, '.'), lambda x: ascii(x)::BIGINT),
          lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) % 5 = 0, false) AS tampered
      FROM documents),
    e AS (
      SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM crc),
    d AS (
      SELECT doc_id, source AS tree, tampered, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
        sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS changed FROM e),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM d),
    {sub},
    places AS (SELECT 0 AS tree, tree AS source, h, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos FROM aroot),
    {top},
    above AS (SELECT places.source, places.h AS subroot, (SELECT h FROM broot) AS root, {picked(b)} FROM places {top_joins}),
    whole AS (
      SELECT leaves.doc_id, leaves.h AS leaf, {fold.replace("h END", "leaves.h END")} AS v, {picked(a)}, above.*
      FROM leaves {sub_joins} JOIN above ON above.source IS NOT DISTINCT FROM leaves.tree),
    {", ".join(chain)}
    SELECT doc_id, leaf, subroot, root, sha256({" || ".join(proof)}) AS proof_sha256, v AS folded_root, v = root AS verified FROM {last}
    """


@query("op12_persistent_merkle", _merkle_sql(5))
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


@query("op13_rare_token_licences")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.report(table(spark, sf_dir, "documents"))
