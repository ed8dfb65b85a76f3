"""Operator 10: benchmark decontamination by winnowing.

Words are hashed, k consecutive word hashes make a k-gram hash, and of each ``w`` consecutive k-grams the ones of
the smallest hash are kept.  Two texts that share ``k + w - 1`` consecutive words keep the same k-gram there, so
joining the kept hashes of documents and benchmark items finds every shared window; each match is extended word
by word in both directions and counts if the shared run is a whole window.  With k = 5 and w = 6 the guaranteed
length is the window's 10 words.  An item of fewer words is one window; for each such length n that occurs, the
documents keep all n-grams (k = n, w = 1), which guarantees n.

Documents and items meet in a join on the kept hashes.  Before it, a Bloom filter of fixed size over the benchmark's hashes
drops what can't meet anything, so that only candidate texts move; a benchmark of any size only lets more through.  A hash
that very many texts hold is dealt over salts by its count.  Each pair of a text and an item is then extended by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_worker, saved, small_batches, table

WINDOW, K, W = 10, 5, 6
#: A-Z become a-z; of the ASCII characters only 0-9 and a-z belong to words, of the others all.
_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Bits of the Bloom filter (8 MB), and texts of one hash that meet its items under one salt.
FILTER_BITS, TEXTS_A_SALT = 26, 8192


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORDS).split() if text else []


class _Hashes(dict):
    """64-bit hash of each word, found once per word."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(in_worker("hashes", _Hashes).__getitem__, words), np.uint64, len(words))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive word hashes; empty if there are fewer."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    step = 0x9E3779B97F4A7C15
    out, n = hashes.copy(), 1  # of n words each: twice as many from two neighbours, one more from the word behind
    for bit in f"{k:b}"[1:]:
        out, n = out[:-n] * np.uint64(pow(step, n, 1 << 64)) + out[n:], 2 * n
        if bit == "1":
            out, n = out[:-1] * np.uint64(step) + hashes[n : n + len(out) - 1], n + 1
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ out >> np.uint64(29)


def winnow(h: np.ndarray, w: int) -> np.ndarray:
    """Places of the smallest hash of each ``w`` neighbours, all places where there are ties; of all, if fewer than ``w``."""
    if w == 1 or len(h) == 0:
        return np.arange(len(h))
    w = min(w, len(h))
    n = len(h) - w + 1
    low = h[:n].copy()
    for j in range(1, w):
        np.minimum(low, h[j : j + n], out=low)
    keep = np.zeros(len(h), bool)
    for j in range(w):
        keep[j : j + n] |= h[j : j + n] == low
    return np.flatnonzero(keep)


class Block:
    """Fingerprints of some benchmark items: for each length class, sorted hashes and where they stand."""

    def __init__(self, items: list[tuple[str | None, str | None]]):
        self.ids, self.words = [], []
        known = _Hashes()
        kept: dict[tuple[int, int, int], list[tuple[np.ndarray, int]]] = {}
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            n, (k, w) = min(WINDOW, len(words)), (K, W) if len(words) >= WINDOW else (len(words), 1)
            h = grams(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), k)
            at = winnow(h, w)
            kept.setdefault((n, k, w), []).append((np.stack([h[at], np.full(len(at), len(self.ids), np.uint64), at.astype(np.uint64)]), len(at)))
            self.ids.append(item_id)
            self.words.append(words)
        self.classes = []
        for (n, k, w), parts in sorted(kept.items()):
            all_ = np.concatenate([p for p, _ in parts], axis=1)
            all_ = all_[:, np.argsort(all_[0], kind="stable")]
            self.classes.append((n, k, w, np.ascontiguousarray(all_[0]), all_[1:].astype(np.int64)))

    def match(self, words: list[bytes], hashes: np.ndarray, bounds: np.ndarray, hit: np.ndarray, found: dict[int, set]) -> None:
        """Marks in ``hit`` the words of any document that stand in a shared window; adds the items to ``found`` by document.

        ``words`` holds several documents one after another, the d-th from ``bounds[d]`` to ``bounds[d + 1]``.
        """
        for n, k, w, sorted_, where in self.classes:
            h = grams(hashes, k)
            at = winnow(h, w)
            left = np.searchsorted(sorted_, h[at])
            left[left == len(sorted_)] = 0
            some = sorted_[left] == h[at]
            done: dict[tuple[int, int], int] = {}
            for p, s in zip(at[some].tolist(), left[some].tolist()):
                value, d = sorted_[s], int(np.searchsorted(bounds, p, "right")) - 1
                first, last = int(bounds[d]), int(bounds[d + 1])
                while s < len(sorted_) and sorted_[s] == value:
                    item, q = where[0, s], where[1, s]
                    s += 1
                    if done.get((item, p - q), -1) > p:
                        continue  # within a run that was found from an earlier match
                    theirs = self.words[item]
                    if p + k > last or words[p : p + k] != theirs[q : q + k]:
                        continue
                    a, b = 0, k
                    while p - a > first and q - a > 0 and words[p - a - 1] == theirs[q - a - 1]:
                        a += 1
                    while p + b < last and q + b < len(theirs) and words[p + b] == theirs[q + b]:
                        b += 1
                    done[item, p - q] = p + b
                    if a + b >= n:
                        hit[p - a : p + b] = True
                        found.setdefault(d, set()).add(self.ids[item])


def fingerprints(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, text, n, hashes): a number, the length class and the distinct kept hashes of every item with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, kept = [], []
            for text in batch.column(2):
                words = words_of(text.as_py())
                n = min(WINDOW, len(words))
                k, w = (K, W) if n == WINDOW else (n, 1)
                h = grams(hash_words(words), k) if n else np.zeros(0, np.uint64)
                lengths.append(n)
                kept.append(np.unique(h[winnow(h, w)]).view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in kept])]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *kept])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths, pa.int32()), listed], names=["item", "item_id", "text", "n", "hashes"])

    rows = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return saved(rows.mapInArrow(run, "item long, item_id string, text string, n int, hashes array<long>").filter("n > 0"), "benchmark-fingerprints")


def bloom(items: DataFrame) -> np.ndarray:
    """One bit for each of ``FILTER_BITS`` leading bits that a hash of ``items`` has: at most 2**20 rows reach the driver."""
    place = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    bits = items.select(F.explode("hashes").alias("hash")).select(place.alias("p")).groupBy(F.expr("p div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits"))
    out = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    found = bits.toArrow()
    out[found["word"].to_numpy()] = np.ascontiguousarray(found["bits"].to_numpy()).view(np.uint64)
    return out


def candidates(texts: DataFrame, items: DataFrame, step: int = 1 << 20) -> DataFrame:
    """(key, text, n, hash) of texts with kept hashes that the filter lets through; ``step`` is the bytes of text at hand."""
    shared = texts.sparkSession.sparkContext.broadcast((bloom(items), sorted(r.n for r in items.select("n").distinct().collect())))  # 8 MB, ten numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, lengths = shared.value

        def found(held: list[str]) -> pa.RecordBatch:
            split = [words_of(t) for t in held]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in split])]).astype(np.int64)
            hashes = hash_words([x for part in split for x in part])
            places, length, kept = [], [], []
            for n in lengths:
                k, w = (K, W) if n == WINDOW else (n, 1)
                h = grams(hashes, k)
                at = winnow(h, w)
                p = h[at] >> np.uint64(64 - FILTER_BITS)
                at = at[(bits[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)]
                d = np.searchsorted(bounds, at, "right") - 1
                whole = at + k <= bounds[d + 1]  # grams within one text; what winnowing keeps of a window that spans two is one more
                places.append(d[whole])
                length.append(np.full(int(whole.sum()), n, np.int32))
                kept.append(h[at[whole]])
            d, n, h = np.concatenate([np.zeros(0, np.int64), *places]), np.concatenate([np.zeros(0, np.int32), *length]), np.concatenate([np.zeros(0, np.uint64), *kept]).view(np.int64)
            rows = np.unique(np.stack([d, n.astype(np.int64), h]), axis=1) if len(d) else np.zeros((3, 0), np.int64)
            docs, start, count = np.unique(rows[0], return_index=True, return_counts=True)
            offsets = pa.array(np.append(start, len(rows[0])).astype(np.int32))
            raw = [held[x] for x in docs.tolist()]
            keys = [hashlib.md5(t.encode()).hexdigest() for t in raw]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(raw, pa.string()), pa.ListArray.from_arrays(offsets, pa.array(rows[1].astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(rows[2]))], names=["key", "text", "n", "hash"]
            )

        for batch in batches:
            held, size = [], 0
            for text in batch.column(0):
                text = text.as_py()
                if not text:
                    continue
                held.append(text)
                size += len(text)
                if size >= step:
                    yield found(held)
                    held, size = [], 0
            if held:
                yield found(held)

    rows = saved(texts.mapInArrow(run, "key string, text string, n array<int>, hash array<long>"), "leak-candidates")
    return rows.dropDuplicates(["key"])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, text, item_id, item_text), a key's together: with each item the words of the text that stand in its windows."""
    known: tuple[str | None, list, np.ndarray] = (None, [], np.zeros(0, np.uint64))
    for batch in batches:
        out = []
        for key, text, item_id, item in zip(*batch.columns):
            key = key.as_py()
            if known[0] != key:
                words = words_of(text.as_py())
                known = key, words, hash_words(words)
            hit = np.zeros(len(known[1]), bool)
            Block([(item_id.as_py(), item.as_py())]).match(known[1], known[2], np.array([0, len(hit)]), hit, {})
            if hit.any():
                out.append((key, item_id.as_py(), np.flatnonzero(hit).tolist()))
        cols = list(zip(*out)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.list_(pa.int32())))], names=["key", "item_id", "hit"])


def with_leaks(docs: DataFrame, benchmark: DataFrame, step: int = 1 << 20, most_bytes: int = 64 << 20) -> DataFrame:
    """Adds ``leak``: struct<n_words, n_hit, item_ids, hit> to every row of ``docs``.

    ``hit`` numbers the words that stand in a window of an item.  Null and empty texts, and texts without words,
    have no words and no hits; items without words match nothing; an item without an id can hit but is not listed;
    items that share an id are listed once.  Repeated rows each get their answer, found once; a column named ``leak`` is
    replaced; empty tables on either side give no hits.  The answers of texts with hits are broadcast up to ``most_bytes``.
    """
    items = fingerprints(small_batches(benchmark))
    found = candidates(docs.select(F.col("text").cast("string").alias("text")), items, step)
    hashes = saved(found.select("key", F.explode(F.arrays_zip("n", "hash")).alias("x")).select("key", F.col("x.n").alias("n"), F.col("x.hash").alias("hash")), "leak-hashes")
    hot = hashes.groupBy("n", "hash").agg(F.ceil(F.count("*") / TEXTS_A_SALT).cast("int").alias("salts")).filter("salts > 1")
    salt = F.pmod(F.xxhash64("key"), F.coalesce("salts", F.lit(1))).cast("int")
    ours = hashes.join(hot, ["n", "hash"], "left").select("key", "n", "hash", salt.alias("salt"))
    theirs = items.select("item", "n", F.explode("hashes").alias("hash")).join(hot, ["n", "hash"], "left")
    theirs = theirs.select("item", "n", "hash", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    pairs = ours.join(theirs, ["n", "hash", "salt"]).select("key", "item").distinct()
    with_item = pairs.join(items.select("item", "item_id", F.col("text").alias("item_text")), "item")
    rows = with_item.join(found.select("key", "text"), "key").select("key", "text", "item_id", "item_text")
    spans = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_spans, "key string, item_id string, hit array<int>")
    hit = F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit"))))
    merged = spans.groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), hit.alias("hit"))
    leaks = saved(merged.select(F.col("key").alias("_leak_key"), F.size("hit").cast("long").alias("_n_hit"), F.col("item_ids").alias("_item_ids"), F.col("hit").alias("_hit")), "leaks")
    n, hits, ids = leaks.agg(F.count("*"), F.coalesce(F.sum("_n_hit"), F.lit(0)), F.coalesce(F.sum(F.size("_item_ids")), F.lit(0))).first()
    if 64 * n + 4 * hits + 64 * ids <= most_bytes:  # beyond that the rows with leaks are joined like any
        leaks = F.broadcast(leaks)

    @F.pandas_udf("long")
    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([len(words_of(t)) for t in batch], dtype="int64")

    text = F.col("text").cast("string")
    keyed = docs.drop("leak").withColumn("_leak_key", F.md5(text.cast("binary"))).withColumn("_n_words", counted(text))
    none = lambda t: F.array().cast(f"array<{t}>")
    leak = F.struct(F.col("_n_words").alias("n_words"), F.coalesce("_n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("_item_ids", none("string")).alias("item_ids"), F.coalesce("_hit", none("int")).alias("hit"))
    return keyed.join(leaks, "_leak_key", "left").withColumn("leak", leak).drop("_leak_key", "_n_words", "_n_hit", "_item_ids", "_hit")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = with_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "leak.n_words", "leak.n_hit", F.size("leak.item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("leak.item_ids", ","), 256).alias("items_sha256"), (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


def brute_force(texts: list[str | None], items: list[tuple[str, str | None]]) -> list[tuple[int, int, int, str]]:
    """The contract word by word, for tests: n_words, n_hit, n_items, items_sha256."""
    wanted: dict[tuple, set] = {}
    for item_id, text in items:
        w = words_of(text)
        n = min(WINDOW, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wanted.setdefault(tuple(w[i : i + n]), set()).add(item_id)
    out = []
    for text in texts:
        w, hit, ids = words_of(text), set(), set()
        for n in {len(x) for x in wanted}:
            for i in range(len(w) - n + 1):
                if x := wanted.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    ids |= x
        out.append((len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()))
    return out


_SQL_WORDS = r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
ORACLE = f"""
with d as (select row_number() over () as r, doc_id, {_SQL_WORDS} as words from documents),
i as (select item_id, {_SQL_WORDS} as words from benchmark),
w as (select item_id, n, array_to_string(list_slice(words, s, s + n - 1), ' ') as gram
  from (select item_id, words, least(10, len(words)) as n, unnest(range(1, len(words) - least(10, len(words)) + 2)) as s from i where len(words) > 0)),
lengths as (select distinct n from w),
g as (select r, n, s, array_to_string(list_slice(words, s, s + n - 1), ' ') as gram
  from (select r, n, words, unnest(range(1, len(words) - n + 2)) as s from d, lengths where len(words) >= n)),
m as (select distinct r, s, n, item_id from g join w using (n, gram)),
hits as (select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + n)) as p from m) group by r),
items as (select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct r, cast(item_id as varchar) as item_id from m) group by r)
select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hits using (r) left join items using (r)
"""
