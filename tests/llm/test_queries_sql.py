"""The registered corpus queries against their SQL twins, and the shape of all of them."""

import duckdb
import pytest

import __spark_entry__ as entry
from crowdpulse.llm.queries import ORACLE_SQL, QUERIES

SHAPES = {
    "op1": {"doc_id", "held_out", "lang_pred", "score"},
    "op2": {"doc_id", "fingerprint", "component_id"},
    "op3": {"page_id", "url", "text", "n_chars"},
    "op4": {"vec_id", "n_links", "component_id", "kept"},
    "op5": {"doc_id", "size", "source_size", "target", "taken"},
    "op6": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op7": {"query_id", "rank", "vec_id", "score"},
    "op8": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op9": {"doc_id", "n_lines", "n_dropped", "kept_sha256"},
    "op10": {"doc_id", "held_out", "score", "predicted"},
    "op11": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op12": {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"},
    "op13": {"lang", "rank", "phrase", "a", "l", "r", "n", "score"},
}


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == set(SHAPES)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_twin(spark, small, name):
    df = QUERIES[name](spark, small)
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    found = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns) and SHAPES[name.split("_")[0]] <= set(columns)
    key = lambda names: lambda r: tuple(repr(r[names.index(c)]) for c in sorted(names))
    assert sorted(map(key(df.columns), (tuple(r) for r in df.collect()))) == sorted(map(key(columns), found.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_shape(spark, small, name):
    assert SHAPES[name.split("_")[0]] <= set(QUERIES[name](spark, small).columns)


def test_line_dedup_is_native(spark, small):
    plan = QUERIES["op9_line_dedup"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and "Pandas" not in plan
