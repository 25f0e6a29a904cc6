"""Copies of the given tables in which one key, source or group holds a third of all rows."""

from __future__ import annotations

import os
import shutil

import duckdb

HOT = {
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id, CASE WHEN event_id % 3 = 0 THEN 'error' ELSE event_type END AS event_type)",
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 1 THEN 61 ELSE o_custkey END AS o_custkey)",
    "lineitem": "* REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey, CASE WHEN l_suppkey % 3 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey)",
    "documents": "* REPLACE (CASE WHEN doc_id % 3 = 0 THEN 'src1' ELSE source END AS source)",
    "customer": "* REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 4 ELSE c_nationkey END AS c_nationkey)",
    "part": "* REPLACE (CASE WHEN p_partkey % 3 = 0 THEN 'Brand#7' ELSE p_brand END AS p_brand)",
}


def build(source: str, target: str) -> str:
    os.makedirs(target, exist_ok=True)
    con = duckdb.connect()
    for name in sorted(os.listdir(source)):
        table = name.removesuffix(".parquet")
        if table in HOT:
            con.execute(f"COPY (SELECT {HOT[table]} FROM read_parquet('{source}/{name}')) TO '{target}/{name}' (FORMAT parquet)")
        else:
            shutil.copy(f"{source}/{name}", f"{target}/{name}")
    return target
