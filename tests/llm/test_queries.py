"""The registered queries on the smallest test tables: against DuckDB where SQL can say it, else
against the public tokenizer, plain Python, held-out labels or the operators one by one."""

from __future__ import annotations

import hashlib
import zlib
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from shoptide.llm import common, queries, tree_bpe

FOLDER = "/root/testdata/sf0.001"
ORACLE = queries.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_all_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = queries.queries()[name](spark, FOLDER)
    relation = duck.sql(ORACLE[name])
    columns = sorted(relation.columns)
    assert columns == sorted(df.columns)
    place = [relation.columns.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in place) for r in relation.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == theirs


def test_bpe_equals_the_library(spark, duck):
    ranks = tree_bpe.parse_ranks(tree_bpe.read_ranks(public_tokenizers.path(queries.RANKS)))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    sha = lambda data: hashlib.sha256(data).hexdigest()
    want = set()
    for doc, text in duck.sql("SELECT doc_id, text FROM documents").fetchall():
        ids = library.encode_ordinary(text or "")
        want.add((doc, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())))
    assert {tuple(r) for r in queries.op9_byte_bpe(spark, FOLDER).collect()} == want


def test_shards_cover_the_table(spark, duck):
    rows = queries.op4_hilbert_shards(spark, FOLDER).collect()
    texts = dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == {
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts.items()
    }
    counts = [sum(r.shard == s for r in rows) for s in range(8)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(texts)


def test_secrets_of_the_table(spark, duck):
    rows = [r for r in queries.op1_secret_scan(spark, FOLDER).collect() if r.is_secret]
    keys = r"(AKIA[A-Z0-9]{16}|password=[0-9a-f]{10,}|token = .[0-9a-f]{40})"
    planted = duck.sql(
        f"SELECT doc_id FROM documents WHERE regexp_matches(text, '{keys}')"
    ).fetchall()
    assert {r.doc_id for r in rows} >= {d for (d,) in planted}


def test_pipeline(spark, duck):
    docs = queries.table(spark, FOLDER, "documents")
    texts = dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    sizes = [len(texts)]
    for name, stage in corpus_pipeline.STAGES:
        out = common.cut(stage(spark, docs, FOLDER))
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= before and len(ids) >= 0.7 * len(before), name
        if name in ("line_dedup", "byte_bpe"):
            assert ids == before
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == docs.columns
        docs = out
        sizes.append(len(ids))
    assert sizes[-1] < sizes[0]
    tokens = tree_bpe.decode(
        docs, public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN
    )
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in tokens.collect())
