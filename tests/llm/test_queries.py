"""The registered queries and the pipeline over the given tables."""
import hashlib
import re
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from airshed.llm import pii, queries


def test_names():
    numbers = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, tables, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables}/{t}.parquet')")
    want = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    rows = sorted(tuple(r) for r in want.fetchall())
    got = entry.queries()[name](spark, tables)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == rows


def test_pipeline(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tables)
        before = {r.doc_id: r.text for r in docs.collect()}
        after = out.collect()
        assert len(after) and {r.doc_id for r in after} <= set(before)
        if name != "tokens":
            assert out.schema.names == ["doc_id", "text", "lang", "source", "n_chars"]
        if name in ("quality", "near_duplicates"):
            assert all(r.text == before[r.doc_id] for r in after) and len({r.doc_id for r in after}) == len(after)
        if name == "personal_data":
            assert len(after) == len(before) and not any(pii.base_spans(r.text) for r in after)
        if name == "tokens":
            for r in after:
                want = library.encode(before[r.doc_id], add_special_tokens=False).ids
                assert list(r.ids) == want and r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
            break
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}-{zlib.crc32(name.encode())}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
