"""The encoder gives the library's ids with any tokenizer, by whichever way."""

import json

import numpy as np
import pytest
from tokenizers import Tokenizer

from emberline.llm import common
from emberline.llm import token_output as T

from .helpers import documents
from .test_tokens import BYTES, TEXTS, WORDS


def variant(tmp_path, change):
    settings = json.loads(Tokenizer.from_file(WORDS).to_str())
    change(settings)
    path = tmp_path / "variant.json"
    path.write_text(json.dumps(settings))
    return str(path)


def cased(s):
    s["normalizer"]["normalizers"] = [x for x in s["normalizer"]["normalizers"] if x["type"] != "Lowercase"]


def bare(s):
    s["normalizer"] = s["pre_tokenizer"] = None


def prefixed(s):
    s["pre_tokenizer"]["pretokenizers"][1]["add_prefix_space"] = True


def short(s):
    s["truncation"] = {"direction": "Right", "max_length": 4, "strategy": "LongestFirst", "stride": 0}


def spaced(s):
    s["pre_tokenizer"]["pretokenizers"][0]["pattern"] = {"Regex": " ?[^\\s]+"}


@pytest.mark.parametrize("change, chunked", [(cased, True), (bare, False), (prefixed, False), (short, True), (spaced, False), (None, False)])
def test_ids_equal_the_library(spark, small, tmp_path, change, chunked):
    path = variant(tmp_path, change) if change else BYTES
    encoder, library = T.ChunkEncoder(path), Tokenizer.from_file(path)
    library.no_truncation()
    assert encoder.chunked == chunked and T.ChunkEncoder(WORDS).chunked
    texts = TEXTS + ["The THE the Été ÉTÉ"] + [r.text or "" for r in documents(spark, small)[:80]]
    for text, ids in zip(texts, encoder.encode_many([t.encode() for t in texts])):
        assert np.frombuffer(ids, encoder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_rows_without_an_id_are_dealt_over_shards(spark):
    docs = spark.createDataFrame([(None, f"text {k}") for k in range(4000)] + [(7, f"same {k}") for k in range(4000)], "doc_id long, text string")
    manifest = T.write_token_records(docs, common.scratch(spark, "null-ids"), WORDS, partitions=8)
    rows = manifest.collect()
    assert len(rows) == 8 and max(r.n_records for r in rows) < 2000
    got = T.read_token_digests(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 4000 + [7] * 4000 and got[-1].start + got[-1].n_tokens == sum(r.n_tokens for r in rows)


def test_stores_are_known_by_hadoops_names(monkeypatch):
    from pyarrow import fs

    asked = []
    monkeypatch.setattr(common, "SCHEMES", common.SCHEMES)
    assert common._store("dbfs:/tmp/x")[1] == "/dbfs/tmp/x" and common._store("file:///tmp/x")[1] == "/tmp/x"

    class Stores:
        LocalFileSystem = fs.LocalFileSystem

        class FileSystem:
            from_uri = staticmethod(asked.append)

    import pyarrow

    monkeypatch.setattr(pyarrow, "fs", Stores, raising=False)
    for uri in ("s3a://bucket/x", "hdfs://node/x"):
        common._store(uri)
    assert asked == ["s3://bucket/x", "hdfs://node/x"]
