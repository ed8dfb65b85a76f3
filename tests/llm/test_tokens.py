import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from emberline.llm import token_counts as C
from emberline.llm import token_output as T
from emberline.llm.common import open_input, open_output, scratch

from .helpers import ODD, documents, empty, odd

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "don't 're x're  y's\n\n\n  we'll\t\tq  ", "!!!<|endoftext|> a <|startoftext|>", "word<|endoftext|>,", "\x1c\x1d a\x1c", "日本語 テスト 😀😀  😀", "   ", "\n", "",
    "İstanbul ΑΣ ÉTÉ été, ÷ × ß ẞ é́", "a" * 50 + " " * 40 + "b" * 9 + "=" * 70, "'r 're'v've 'll'l", "x \n's \n 's", "(z) \"q\" a_b a1, The THE the's",
]


def test_chunk_encoder_equals_the_library(spark, small):
    encoder = T.ChunkEncoder(WORDS)
    texts = TEXTS + [r.text for r in documents(spark, small)]
    for text, ids in zip(texts, encoder.encode_many([t.encode() for t in texts])):
        assert np.frombuffer(ids, encoder.dtype).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_chunk_encoder_takes_long_texts_in_pieces_and_survives_a_full_table():
    encoder = T.ChunkEncoder(WORDS, cap=20)
    text = " ".join(f"w{k}x" for k in range(3000))
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode_many([text.encode()], step=500)[0], encoder.dtype).tolist() == whole


def test_records_round_trip(spark):
    docs = odd(spark)
    path = scratch(spark, "test-records")
    manifest = T.write_token_records(docs, path, WORDS, shard_bytes=2000, partitions=3)
    got = sorted(T.read_token_digests(manifest).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(WORDS)
    want = {}
    for doc_id, text, *_ in ODD:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        want.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert len(got) == len(ODD)
    assert [r.doc_id for r in got] == sorted((r[0] for r in ODD), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in got:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        start += r.n_tokens
    one = got[3]
    shard = manifest.filter((manifest.shard == one.shard) & (manifest.part == one.part)).first().path
    doc_id, ids = T.read_one(shard, one.record)
    assert (doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) == (one.doc_id, one.n_tokens, one.ids_crc32)


def test_damage_is_noticed(spark):
    path = scratch(spark, "test-damage")
    manifest = T.write_token_records(odd(spark), path, WORDS, partitions=1)
    shard = manifest.first().path
    with open_input(f"{shard}.rec") as f:
        data = bytearray(f.read())
    data[len(data) // 2] ^= 1
    with open_output(f"{shard}.rec") as f:
        f.write(bytes(data))
    with pytest.raises(ValueError):
        list(T._records(shard))


def test_empty_table(spark):
    manifest = T.write_token_records(empty(spark), scratch(spark, "test-empty"), WORDS)
    assert T.read_token_digests(manifest).count() == 0
    assert C.prefix_counts(empty(spark), BYTES).count() == 0


def test_every_prefix_count_equals_the_library():
    counter, library = C.PrefixCounter(BYTES), Tokenizer.from_file(BYTES)
    for text in TEXTS:
        counts = C.counts_at(counter.changes(text)).tolist()
        assert counts == [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)], text


def test_counts_of_documents(spark, small):
    library = Tokenizer.from_file(BYTES)
    for r in C.prefix_counts(odd(spark), BYTES).collect():
        texts = [t or "" for i, t, *_ in ODD if i == r.doc_id]
        assert any((r.n_bytes, r.n_tokens, len(r.changes)) == (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids), len(t)) for t in texts)
    counter = C.PrefixCounter(BYTES, cap=50)
    for r in documents(spark, small)[:60]:
        assert C.counts_at(counter.changes(r.text))[-1] == len(library.encode(r.text, add_special_tokens=False).ids)


def test_truncation_point():
    changes = C.PrefixCounter(BYTES).changes("one two three four five")
    library = Tokenizer.from_file(BYTES)
    k = C.longest_prefix(changes, 3)
    assert len(library.encode("one two three four five"[:k]).ids) <= 3 < len(library.encode("one two three four five"[: k + 1]).ids)
