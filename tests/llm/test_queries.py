"""Each registered query on whole small tables: the columns that its contract names, and a row a document or page."""

import zlib

import duckdb
import pytest

from emberline.llm import decontamination as D
from emberline.llm import line_labels as L
from emberline.llm import simhash as S
from emberline.llm.queries import ORACLE_SQL, QUERIES

CONTRACT = {
    "op1_token_records": "doc_id:bigint start:bigint n_tokens:bigint ids_crc32:bigint", "op2_token_counts": "doc_id:bigint n_bytes:bigint n_tokens:bigint over_limit:boolean",
    "op3_toxicity": "doc_id:bigint held_out:boolean score:double predicted:int", "op4_rule_quality": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op5_line_labels": "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint n_repeat_words:bigint base_failed:boolean kept:boolean",
    "op6_simhash": "doc_id:bigint fingerprint:string component_id:bigint", "op7_site_lines": "page_id:bigint host:string n_lines:bigint", "op8_passages": "doc_id:bigint other_id:bigint start:int end:int n_match:int",
    "op9_mixing": "doc_id:bigint size:bigint source_size:bigint target:double taken:bigint", "op10_decontamination": "doc_id:bigint n_words:bigint n_hit:bigint n_items:bigint items_sha256:string contaminated:boolean",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_contract(spark, small, name):
    out = QUERIES[name](spark, small)
    have = dict(out.dtypes)
    if name == "op7_site_lines":
        have = {n: "bigint" if t == "int" else t for n, t in have.items()}
    assert {tuple(x.split(":")) for x in CONTRACT[name].split()} <= set(have.items())
    rows = out.collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    if name not in ("op7_site_lines", "op8_passages"):
        assert sorted(r.doc_id for r in rows) == sorted(docs)
    if name in ("op3_toxicity", "op4_rule_quality"):
        limit = 0.5 if name == "op3_toxicity" else 0.3
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= limit) and 0 <= r.score <= 1 for r in rows)
    if name == "op5_line_labels":
        assert all((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == L.base_counts(docs[r.doc_id]) and not (r.kept and r.base_failed) for r in rows)
    if name == "op6_simhash":
        assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == S.brute_force(list(docs.items()))
    if name == "op10_decontamination":
        items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
        assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in rows} == dict(zip(docs, D.brute_force(list(docs.values()), items)))
    if name in ORACLE_SQL:
        con = duckdb.connect()
        for t in ("documents", "benchmark", "pages"):
            con.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
        want = con.sql(ORACLE_SQL[name])
        at = [want.columns.index(c) for c in out.columns]
        key = lambda v: tuple(round(x, 6) if isinstance(x, float) else x for x in v)
        assert sorted(map(key, rows)) == sorted(key([r[k] for k in at]) for r in want.fetchall())
