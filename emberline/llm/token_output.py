"""Operator 1: token ids as length-delimited binary records with masked checksums and an offset index.

File format (all numbers little-endian)::

    shard   = magic "EMBTOK1\\0" | u8 bytes per id (2 or 4) | record*
    record  = u64 length | u32 masked crc of those 8 bytes | payload | u32 masked crc of the payload
    payload = u8 has_doc_id | i64 doc_id | ids
    index   = (u64 offset of the record | u64 number of ids)*      in a file of its own

A masked checksum is the CRC-32 ``c`` rotated right by 15 bits plus 0xA282EAD8, so that a checksum of data that
holds checksums stays sound.  Shards hold ascending doc_id ranges; a shard is written under a name that no other
task attempt uses, and only the attempts that Spark accepted are named in the manifest, so retried, speculative
and lost tasks leave no half-read data.
"""

from __future__ import annotations

import codecs
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACES, discard, in_worker, open_input, open_output, scratch, small_batches

MAGIC = b"EMBTOK1\0"
_HEAD, _LEN, _CRC, _ID, _ENTRY = len(MAGIC) + 1, struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<Bq"), struct.Struct("<QQ")
#: Letters (ASCII, or two-byte ones that are in lower case and have no shorter form), then marks that end a piece.
_SIMPLE = re.compile(rb"((?:[A-Za-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]*)").fullmatch
#: How byte-level vocabularies spell each byte: printing ones as themselves, the others as U+0100 and on, in order; a space parts words.
_HIDDEN = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
_SPELL = "".join(" " if b == 0x20 else chr(0x100 + _HIDDEN.index(b)) if b in _HIDDEN else chr(b) for b in range(256))
MANIFEST = "shard int, part int, path string, n_records long, n_tokens long, n_bytes long"


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def _parts(step: dict | None, kind: str) -> list[dict]:
    """The steps of a normalizer or pre-tokenizer, in order."""
    return [] if step is None else step[kind] if step["type"] == "Sequence" else [step]


def drops_space(settings: dict) -> bool:
    """Whether a tokenizer's file says that no step looks across white space, so that chunks can be encoded alone.

    That is so if normalizers only compose, lower and fold white space, if the text is cut into matches of a pattern that
    takes in no white space, and if bytes are then spelled without a space before them.
    """
    for x in _parts(settings["normalizer"], "normalizers"):
        if x["type"] not in ("NFC", "Lowercase") and (x["type"], x.get("pattern"), x.get("content")) != ("Replace", {"Regex": r"\s+"}, " "):
            return False
    steps = _parts(settings["pre_tokenizer"], "pretokenizers")
    if [x["type"] for x in steps] != ["Split", "ByteLevel"] or (steps[0]["behavior"], steps[0]["invert"]) != ("Removed", True):
        return False
    bare = re.sub(r"\[\^\\s[^\]]*\]", "", steps[0]["pattern"].get("Regex", " "))  # less classes that leave white space out
    if re.search(r"\s|\\s|\\S|\\W|\.|\[\^|\(\?[=!<]", bare) or steps[1]["add_prefix_space"] or steps[1]["use_regex"]:
        return False
    return not any(x["lstrip"] or x["rstrip"] or x["normalized"] or x["single_word"] or any(c.isspace() for c in x["content"]) for x in settings["added_tokens"])


class ChunkEncoder:
    """The library's ids of any text with any tokenizer, by the shortest way that the tokenizer's file allows.

    Where its steps never look across white space (``drops_space``), the ids of a text are those of its chunks between ASCII
    spaces in order, and each distinct chunk is encoded once; words of letters are made from the plain word where the file
    lowers them.  With any other tokenizer each text is encoded whole.  ``tests/llm`` holds all ways against the library.
    """

    def __init__(self, path: str, cap: int = 250_000, longest: int = 8):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.cap = Tokenizer.from_file(path), cap
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[bytes, bytes] = {}  # chunks of at most ``longest`` bytes: longer ones hardly ever come again
        self.longest = longest
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        settings = json.loads(self.tokenizer.to_str())
        self.chunked = drops_space(settings)
        lowers = any(x["type"] == "Lowercase" for x in _parts(settings["normalizer"], "normalizers"))
        suffix = settings["model"].get("end_of_word_suffix") if self.chunked and lowers else None
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, k in self.tokenizer.get_vocab().items() if suffix else ():
            self.ends[k] = token.endswith(suffix)
        self.marked = bool(self.ends.any())
        # the merges alone, for plain words: no normalising or splitting by patterns; only if it gives the same
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        trial = ["a", "the", "straße", "éàüß", "zwölf", "être", "rhythm"]
        plain = lambda t, words: [list(t.encode(w, add_special_tokens=False).ids) for w in words]
        self.spelled = plain(self.tokenizer, trial) == plain(self.bare, [codecs.charmap_decode(w.encode(), "strict", _SPELL)[0] for w in trial])

    def _whole(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        out = self.tokenizer.encode([x.decode("utf-8", "replace") for x in chunks], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(out.ids, self.dtype).tobytes()
        ends = (np.searchsorted(np.array(out.word_ids, np.int64), np.arange(1, len(chunks) + 1)) * self.dtype.itemsize).tolist()
        return dict(zip(chunks, map(ids.__getitem__, map(slice, [0, *ends], ends))))

    def _letters(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Words of letters alone, as one text: each is one piece, whose last token marks its end."""
        if not words:
            return {}
        text, tokenizer = b" ".join(words), self.bare if self.spelled else self.tokenizer
        text = codecs.charmap_decode(text, "strict", _SPELL)[0] if self.spelled else text.decode()
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
        ends = ((np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize).tolist()
        if len(ends) != len(words):
            return self._whole(words)
        data = ids.tobytes()
        return dict(zip(words, map(data.__getitem__, map(slice, [0, *ends], ends))))

    def _learn(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        """Ids of chunks that are not known; a word with capitals or marks after it is made of the plain word's ids."""
        known, made, plain, other = self.known, [], set(), set()
        for c in chunks:
            if self.marked and c.isalpha():  # ASCII letters alone
                word = c.lower()
                plain.add(word)
                if word != c:
                    made.append((c, word, b""))
            elif self.marked and (m := _SIMPLE(c)):
                word, marks = m[1].lower(), m[2]
                plain.add(word)
                if marks:
                    other.add(marks)
                if word != c:
                    made.append((c, word, marks))
            else:
                other.add(c)
        out = self._letters([w for w in plain if w not in known])
        if rest := [c for c in other if c not in known]:
            out |= self._whole(rest)
        for c, word, marks in made:
            ids = out[word] if word in out else known[word]
            if marks:
                ids += out[marks] if marks in out else known[marks]
            out[c] = ids
        if len(known) > self.cap:
            known.clear()
        known.update((c, x) for c, x in out.items() if len(c) <= self.longest)
        return out

    def encode_many(self, texts: list[bytes], step: int = 1 << 22) -> list[bytes]:
        """Ids of each text as bytes of ``dtype``; longer texts are taken in pieces that end at a space."""
        out: list[bytes] = []
        start, held = 0, 0
        for i, text in enumerate(texts):
            held += len(text)
            if held >= step or i + 1 == len(texts):
                out += self._encode(texts[start : i + 1], step)
                start, held = i + 1, 0
        return out

    def _encode(self, texts: list[bytes], step: int) -> list[bytes]:
        if not self.chunked:
            return [np.array(self.tokenizer.encode(x.decode("utf-8", "replace"), add_special_tokens=False).ids, self.dtype).tobytes() for x in texts]
        if len(texts) == 1 and len(texts[0]) > 2 * step:
            parts, at, text = [], 0, texts[0]
            while at < len(text):
                end = min(len(text), at + step)
                while end < len(text) and text[end] not in SPACES.encode():
                    end += 1
                parts += self._encode([text[at:end]], end)
                at = end
            return [b"".join(parts)]
        split = [x.split() for x in texts]
        chunks = [c for x in split for c in x]
        ids = list(map(self.known.get, chunks))
        if missing := [i for i, x in enumerate(ids) if x is None]:
            learnt = self._learn({chunks[i] for i in missing})
            for i in missing:
                ids[i] = learnt[chunks[i]]
        out, at = [], 0
        for x in split:
            out.append(b"".join(ids[at : at + len(x)]))
            at += len(x)
        return out


class _Shard:
    def __init__(self, base: str, size: int):
        self.path = f"{base}-{uuid.uuid4().hex}"
        self.out = open_output(f"{self.path}.rec")
        self.out.write(MAGIC + bytes([size]))
        self.at, self.index, self.size, self.tokens = _HEAD, bytearray(), size, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        payload = _ID.pack(doc_id is not None, doc_id or 0) + ids
        head = _LEN.pack(len(payload))
        self.out.write(b"".join((head, _CRC.pack(masked_crc(head)), payload, _CRC.pack(masked_crc(payload)))))
        self.index += _ENTRY.pack(self.at, len(ids) // self.size)
        self.at += len(payload) + 16
        self.tokens += len(ids) // self.size

    def close(self) -> tuple[str, int, int, int]:
        self.out.close()
        with open_output(f"{self.path}.idx") as f:
            f.write(bytes(self.index))
        return self.path, len(self.index) // _ENTRY.size, self.tokens, self.at


def write_token_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, shard_bytes: int = 256 << 20, partitions: int | None = None) -> DataFrame:
    """Writes the ids of every whole ``text``, with ``end_id`` after each, in ascending ``doc_id`` order under ``path``.

    Returns the manifest: shard, part, path, n_records, n_tokens, n_bytes; (shard, part) ascends with doc_id.
    A null text counts as empty: its record holds ``end_id`` alone.  Rows with equal ids all get a record, side by
    side in order of their texts' hashes, by which they are dealt over shards too; rows without an id come first.  An empty table gives an empty manifest.  Other columns are not read.
    ``tokenizer`` is a file that every node has.
    """
    spark = small_batches(docs).sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ("doc_id", F.xxhash64("text"))
    rows = (rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, done, shard = TaskContext.get().partitionId(), [], None
        encoder = in_worker(("chunks", tokenizer), lambda: ChunkEncoder(tokenizer))
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            encoded = encoder.encode_many([(x or "").encode() for x in batch.column(1).to_pylist()])
            for doc_id, data in zip(ids, encoded):
                if shard is None or shard.at >= shard_bytes:
                    if shard:
                        done.append(shard.close())
                    shard = _Shard(f"{path}/data/s{number:06d}-{len(done):04d}", encoder.dtype.itemsize)
                shard.add(doc_id, data + end)
        if shard:
            done.append(shard.close())
        cols = list(zip(*((number, k, *x) for k, x in enumerate(done)))) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()))], names=["shard", "part", "path", "n_records", "n_tokens", "n_bytes"])

    rows.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _records(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Each record of a shard in file order, with both checksums and the index verified."""
    with open_input(f"{path}.idx") as f:
        index = np.frombuffer(f.read(), "<u8").reshape(-1, 2)
    with open_input(f"{path}.rec") as f:
        head = f.read(_HEAD)
        if head[:-1] != MAGIC:
            raise ValueError(f"{path}.rec is no token shard")
        at = _HEAD
        for offset, count in index.tolist():
            if offset != at:
                raise ValueError(f"index and records of {path} differ at byte {at}")
            doc_id, ids = _record(f, path, head[-1])
            if len(ids) != count:
                raise ValueError(f"index and records of {path} differ at byte {at}")
            at = f.tell()
            yield doc_id, ids


def _record(f, path: str, size: int) -> tuple[int | None, np.ndarray]:
    head = f.read(12)
    if len(head) < 12 or _CRC.unpack(head[8:])[0] != masked_crc(head[:8]):
        raise ValueError(f"damaged length in {path} before byte {f.tell()}")
    n = _LEN.unpack(head[:8])[0]
    body = f.read(n + 4)
    if len(body) < n + 4 or _CRC.unpack(body[n:])[0] != masked_crc(body[:n]):
        raise ValueError(f"damaged record in {path} before byte {f.tell()}")
    known, doc_id = _ID.unpack_from(body)
    return (doc_id if known else None), np.frombuffer(body, f"<u{size}", offset=_ID.size, count=(n - _ID.size) // size)


def read_one(path: str, number: int) -> tuple[int | None, np.ndarray]:
    """Record ``number`` of a shard by its index entry alone: what a shuffled reader does."""
    with open_input(f"{path}.idx") as f:
        f.seek(number * _ENTRY.size)
        offset, _ = _ENTRY.unpack(f.read(_ENTRY.size))
    with open_input(f"{path}.rec") as f:
        size = f.read(_HEAD)[-1]
        f.seek(offset)
        return _record(f, path, size)


def read_token_digests(manifest: DataFrame) -> DataFrame:
    """Reads every shard of ``manifest`` back: doc_id, start, n_tokens, ids_crc32, shard, record.

    ``start`` counts the ids before the record.  The running sum over shards sees one row per shard, not per document.
    """
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = manifest.withColumn("before", before.cast("long")).select("shard", "part", "path", "before")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, part, path, at in zip(*(c.to_pylist() for c in batch.columns)):
                rows = []
                for k, (doc_id, ids) in enumerate(_records(path)):
                    rows.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), shard, part, k))
                    at += len(ids)
                    if len(rows) == 20_000:
                        yield _digests(rows)
                        rows = []
                yield _digests(rows)

    return shards.repartition(max(1, manifest.count()), "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, part int, record long")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * 7
    kinds = (pa.int64(),) * 4 + (pa.int32(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "start", "n_tokens", "ids_crc32", "shard", "part", "record"])


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .common import table

    path = scratch(spark, "token-records")
    manifest = write_token_records(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_digests(manifest)


__all__ = ["ChunkEncoder", "discard", "masked_crc", "op1_token_records", "read_one", "read_token_digests", "write_token_records"]
