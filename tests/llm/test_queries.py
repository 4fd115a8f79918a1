"""Registered queries at the smallest scale; those with SQL must match DuckDB."""

import duckdb
import pytest
from webloom.llm.registry import ORACLES, QUERIES

from .helpers import SF

COLUMNS = {
    "op1": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op2": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op3": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op4": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op5": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6": {"doc_id": "bigint", "group_id": "bigint", "group_size": "bigint", "kept": "boolean"},
    "op7": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op8": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op9": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op10": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op11": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    "op12": {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"},
    "op13": {
        "doc_id": "bigint", "n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output_sha256": "string", "restored_sha256": "string",
    },
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    types = dict(QUERIES[name](spark, SF).dtypes)
    want = COLUMNS[name.split("_")[0]]
    assert {k: types.get(k) for k in want} == want


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(ORACLES[name]).df()[list(got.columns)]
    a, b = (x.sort_values(list(x.columns)).round(6).convert_dtypes().reset_index(drop=True) for x in (got, want))
    assert a.astype(str).equals(b.astype(str))
