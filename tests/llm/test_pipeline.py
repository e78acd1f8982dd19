"""The pipeline against its stages in SQL, chained in DuckDB, and the packing against the tokenizer."""

import zlib
from collections import defaultdict

import duckdb
import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from divtide.llm.registry import tokenizer
from divtide.llm.sql import CONTAINMENT_SQL, JACCARD_SQL, RULES_SQL, SPARED_TEMPLATES_SQL
from tests.llm.conftest import EDGES, prose

SF_DIR = "/root/testdata/sf0.001"


def brute_force() -> dict[int, str]:
    """Texts by id that reach the packing."""
    con = duckdb.connect()
    con.execute(f"CREATE TABLE given AS SELECT doc_id, \"text\" FROM read_parquet('{SF_DIR}/documents.parquet')")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{SF_DIR}/benchmark.parquet')")
    con.execute("CREATE TABLE documents AS SELECT * FROM given")
    for select in (
        f"SELECT d.* FROM documents d JOIN ({RULES_SQL}) x USING (doc_id) WHERE kept",
        f"SELECT doc_id, \"text\" FROM ({SPARED_TEMPLATES_SQL}) WHERE regexp_matches(\"text\", '[^ \\t-\\r]')",
        # A class keeps its least document.
        f"SELECT d.* FROM documents d JOIN ({JACCARD_SQL}) x USING (doc_id) WHERE doc_id = class_id",
        f"SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ({CONTAINMENT_SQL}))",
    ):
        con.execute(f"CREATE TABLE kept AS {select}")
        con.execute("DROP TABLE documents")
        con.execute("ALTER TABLE kept RENAME TO documents")
    return dict(con.execute('SELECT doc_id, "text" FROM documents').fetchall())


def test_run_equals_the_stages_in_sql(spark):
    texts = brute_force()
    assert 0 < len(texts) < 200
    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    parts, sequences = defaultdict(dict), defaultdict(int)
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        parts[r["doc_id"]][r["start"]] = (r["length"], r["ids_crc32"])
        sequences[r["sequence_id"]] += r["length"]
    assert set(parts) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        end = 0
        for start in sorted(parts[doc_id]):
            length, crc = parts[doc_id][start]
            assert start == end and zlib.crc32(ids[start : start + length].tobytes()) == crc
            end += length
        assert end == len(ids)
    assert max(sequences.values()) <= 2048


def test_stages_return_documents(spark, frame):
    """Every stage but the last gives the columns it got, also for edge cases and no rows."""
    for rows in (EDGES, []):
        docs = frame(rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_DIR)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= len(rows)


def test_stage_names():
    assert len(corpus_pipeline.STAGES) == 5
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_returns_the_tokens(spark, frame):
    out = corpus_pipeline.STAGES[-1][1](spark, frame(EDGES), SF_DIR).collect()
    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    parts = defaultdict(dict)
    for r in out:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        parts[r["doc_id"]][r["start"]] = r["ids"]
    for doc_id, text in ((4, "a"), (6, EDGES[7][1])):
        whole = b"".join(parts[doc_id][s] for s in sorted(parts[doc_id]))
        assert whole == np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()


def test_copies_reach_the_search_whole(spark, frame):
    """Near copies of many lines go as a whole, none stays as a fragment; a common passage does go from others."""
    block = prose(900, 40)
    lines = [prose(k, 18) for k in range(20)]
    original, near = "\n".join(lines), "\n".join([*lines[:7], prose(700, 18), *lines[8:]])
    rows = [(1, original), (2, near), (3, original), (4, f"{prose(5, 200)}\n{block}"), (5, f"{block}\n{prose(6, 200)}"), (6, block)]
    docs = corpus_pipeline.line_stage(spark, frame(rows), SF_DIR)
    out = {r["doc_id"]: r["text"] for r in docs.collect()}
    # The block alone is no copy of a document that it is a small part of; nothing is left of it.
    assert out == {1: original, 2: near, 3: original, 4: rows[3][1], 5: prose(6, 200)}
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.near_stage(spark, docs, SF_DIR).collect()}
    assert kept == {i: out[i] for i in (1, 4, 5)}
