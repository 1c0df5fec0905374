"""The registered queries over the smallest given tables."""

import re

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, rows
from llm.conftest import SF
from lumbung.llm import queries as q

CONTRACT = {
    "op2": "query_id:bigint rank:int vec_id:bigint score:double",
    "op3": "doc_id:bigint size:bigint source_size:bigint target:double taken:bigint",
    "op4": "doc_id:bigint held_out:boolean lang_pred:string score:double",
    "op5": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op6": "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint n_repeat_words:bigint"
    " base_failed:boolean kept:boolean",
    "op8": "doc_id:bigint n_words:bigint n_base:bigint first_word:bigint last_word:bigint base_labels:string"
    " labels:string score:double",
    "op9": "doc_id:bigint fingerprint:string component_id:bigint",
    "op11": "doc_id:bigint n_a:bigint n_b:bigint n_groups:bigint n_links:bigint n_best:bigint count_sum:bigint"
    " groups_sha256:string",
    "op12": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op13": "doc_id:bigint leaf:string subroot:string root:string proof_sha256:string folded_root:string"
    " verified:boolean",
    "op10": "page_id:bigint host:string path:string rule:string verdict:string",
}


def test_all_operators_and_the_pipeline_are_registered():
    names = contract.queries()
    assert sorted(int(m[1]) for name in names if (m := re.match(r"op(\d+)_", name))) == list(range(1, 14))
    assert "pipeline" in names


@pytest.mark.parametrize("name", [n for n in q.QUERIES if n not in q.ORACLES])
def test_rows_and_columns(spark, name):
    df = q.QUERIES[name](spark, SF)
    shown = [f"{n}:{t}" for n, t in df.dtypes]
    assert set(CONTRACT.get(name.split("_")[0], "").split()) <= set(shown)
    assert df.count() > 0


@pytest.mark.parametrize("name", list(q.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = q.QUERIES[name](spark, SF)
    result = con.execute(q.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(columns, result.fetchall())
