"""Operator 6: near-duplicates by SimHash, found with a Gray-order hierarchical index.

Fingerprints that differ in at most 4 of 64 bits agree on at least c of 4 + c blocks of bits, so each choice of c blocks is a
table in which linked fingerprints share a key.  c is the least for which a key is expected to hold no more fingerprints
than a task takes: none at first (one index over all), then 5 tables, 15 and 35, whatever the size with the same links.

All fingerprints of a key are searched by one index.  They are sorted by Gray rank, neighbours are grouped, and what bits a
group shares is factored into the group's node, so that a search adds up the differences from the top and leaves a whole
group as soon as they exceed 4.  A node whose members are all in the query's component already is left too: only a spanning
forest of a key's links is needed, and none of the pairs of a large group of copies is ever written.  A key with too many
fingerprints for one task is cut into chunks and every two chunks meet in a task of their own.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import components
from .common import saved, small_batches, table

MOST, FANOUT = 4, 16


def key_masks(c: int) -> list[int]:
    """The bits of each choice of ``c`` of 4 + c blocks that 64 bits are cut into evenly; the one mask of no bits for 0."""
    edges = [64 * k // (MOST + c) for k in range(MOST + c + 1)]
    blocks = [(1 << high) - (1 << low) for low, high in itertools.pairwise(edges)]
    return [sum(x) for x in itertools.combinations(blocks, c)]


def blocks_for(n: int, most: int) -> int:
    """The least number of blocks in a key for which ``n`` fingerprints come to ``most`` a key or fewer; at most 3."""
    return next((c for c in range(3) if n >> c * (64 // (MOST + c)) <= most), 3)


def fingerprint(text: str | None, size: int = 4) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    import xxhash

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined, k = b" ".join(words), min(size, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[k - 1 :].tolist())], "<u8")
    counts = np.zeros(64, np.int64)
    for part in np.array_split(h, 1 + len(h) // 65536):
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint of each whole text as a signed long; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], names=["doc_id", "fp"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def gray_rank(c: Column) -> Column:
    """Place of a fingerprint in the reflected Gray sequence; ``g ^ (g >>> 1)`` leads back."""
    for k in (1, 2, 4, 8, 16, 32):
        c = c.bitwiseXOR(F.shiftrightunsigned(c, k))
    return c


class HierarchicalIndex:
    """Index of distinct fingerprints (uint64, in Gray order) for searches within a number of differing bits."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        every, none = fps.copy(), ~fps  # bits that are 1 in all members, bits that are 0 in all
        self.levels = []
        while len(every) > FANOUT:
            at = np.arange(0, len(every), FANOUT)
            every, none = np.bitwise_and.reduceat(every, at), np.bitwise_and.reduceat(none, at)
            self.levels.append((every | none, every))
        self.levels.reverse()  # top first
        # what a node's parent compares already is taken out of the node's own mask, and of the members' own comparison
        self.rest = ~np.repeat(self.levels[-1][0], FANOUT)[: len(fps)] if self.levels else None
        for k in range(len(self.levels) - 1, 0, -1):
            mask, bits = self.levels[k]
            self.levels[k] = mask & ~np.repeat(self.levels[k - 1][0], FANOUT)[: len(mask)], bits

    def search(self, queries: np.ndarray, labels: np.ndarray | None = None, query_labels: np.ndarray | None = None, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) numbers of all pairs within ``most`` bits; pairs of one label may be left out."""
        n_top = len(self.levels[0][0]) if self.levels else len(self.fps)
        q, node = np.repeat(np.arange(len(queries)), n_top), np.tile(np.arange(n_top), len(queries))
        acc = np.zeros(len(q), np.uint8)
        uniform = self._uniform(labels) if labels is not None else []
        for k, (mask, bits) in enumerate(self.levels):
            acc = acc + np.bitwise_count((queries[q] ^ bits[node]) & mask[node])
            keep = acc <= most
            if labels is not None:
                keep &= uniform[k][node] != query_labels[q]
            q, node, acc = q[keep], node[keep], acc[keep]
            size = len(self.levels[k + 1][0]) if k + 1 < len(self.levels) else len(self.fps)
            child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            q, acc, node = np.repeat(q, FANOUT), np.repeat(acc, FANOUT), child
            inside = node < size
            q, node, acc = q[inside], node[inside], acc[inside]
        diff = queries[q] ^ self.fps[node]
        acc = acc + np.bitwise_count(diff & self.rest[node] if self.rest is not None else diff)
        keep = acc <= most
        if labels is not None:
            keep &= labels[node] != query_labels[q]
        return q[keep], node[keep]

    def _uniform(self, labels: np.ndarray) -> list[np.ndarray]:
        """For each level, the label that all members of a node have, or -1."""
        out, low, high = [], labels, labels
        for _ in self.levels:
            at = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            out.append(np.where(low == high, low, -1))
        return out[::-1]


def forest(fps: np.ndarray, step: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links between distinct fingerprints in Gray order."""
    index, parent = HierarchicalIndex(fps), list(range(len(fps)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    labels = np.arange(len(fps))
    for at in range(0, len(fps), step):
        ask = np.arange(at, min(at + step, len(fps)))
        q, member = index.search(fps[ask], labels, labels[ask])
        pairs = np.unique(labels[ask[q]] * np.int64(len(fps)) + labels[member])
        for a, b in zip((pairs // len(fps)).tolist(), (pairs % len(fps)).tolist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(pairs):
            labels = _roots(np.array(parent))
            parent = labels.tolist()
    moved = np.flatnonzero(labels != np.arange(len(fps)))
    return fps[moved], fps[labels[moved]]


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return up
        parent = up


def _link(keys: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges within runs of equal ``keys``; ``ranks`` are unsigned Gray ranks, ascending in a run, repeats allowed."""
    keep = np.concatenate([[True], (keys[1:] != keys[:-1]) | (ranks[1:] != ranks[:-1])])
    keys, ranks = keys[keep], ranks[keep]
    fps = ranks ^ (ranks >> np.uint64(1))
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for k in np.flatnonzero(sizes > 1):
        x, y = forest(fps[starts[k] : starts[k] + sizes[k]])
        a.append(x)
        b.append(y)
    return np.concatenate(a), np.concatenate(b)


def _edges(rows: DataFrame) -> DataFrame:
    """Links between fingerprints of rows (t, m, i, j, g) that agree on all but g; one task sees all rows of a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out(cols: list[np.ndarray]) -> pa.RecordBatch:
            run_of = np.cumsum(np.concatenate([[0], np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)]))
            a, b = _link(run_of, cols[4].view(np.uint64))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            cols = [np.ascontiguousarray(c.to_numpy(zero_copy_only=False)).astype(np.int64) for c in batch.columns]
            if held:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            if not len(cols[0]):
                continue
            last = np.flatnonzero(np.any([c != c[-1] for c in cols[:4]], axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = [c[cut:] for c in cols]
            if cut:
                yield out([c[:cut] for c in cols])
        if held:
            yield out(held)

    key = ["t", "m", "i", "j"]
    # Gray ranks are unsigned: the sort puts them so
    return rows.repartition(*key).sortWithinPartitions(*key, F.col("g") < 0, "g").mapInArrow(run, "a long, b long")


def fingerprint_links(fps: DataFrame, most: int = 16_384) -> DataFrame:
    """Edges (a, b) that connect what links connect, between the distinct values of column ``fp``.

    ``most`` is the number of fingerprints that share a key in one task; larger keys are cut into chunks of that.
    """
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in key_masks(blocks_for(fps.count(), most))]
    keys = fps.select("fp", gray_rank(F.col("fp")).alias("g")).select("g", F.explode(F.array(*(F.struct(F.lit(t).cast("byte").alias("t"), F.col("fp").bitwiseAND(F.lit(x)).alias("m")) for t, x in enumerate(signed)))).alias("k")).select("k.t", "k.m", "g")
    hot = saved(keys.groupBy("t", "m").agg(F.count("*").alias("n")).filter(F.col("n") > most), "hot-keys")
    alone = (F.lit(0).alias("i"), F.lit(0).alias("j"))
    if not hot.head(1):
        return _edges(keys.select("t", "m", *alone, "g"))
    cold = keys.join(hot, ["t", "m"], "left_anti").select("t", "m", *alone, "g")
    chunks = F.ceil(F.col("n") / most).cast("int")
    own = F.pmod(F.xxhash64("g"), F.col("chunks")).cast("int")
    cut = keys.join(hot.withColumn("chunks", chunks), ["t", "m"]).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return _edges(cold).union(_edges(cut.select("t", "m", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "g")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp (signed long), component_id (smallest doc_id reachable over links) for every row of ``docs``.

    Documents of equal fingerprints are one vertex, so copies cost nothing after the first shuffle.  Null and empty
    texts have fingerprint 0 and link like any other.  Rows without an id get the component of their fingerprint
    (null if none of its documents has an id).  Repeated rows stay; other columns are not read.
    """
    prints = saved(with_fingerprints(docs), "fingerprints")
    distinct = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    roots = components(fingerprint_links(distinct))
    placed = distinct.join(roots, distinct.fp == roots.a, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints.join(placed.join(named, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def brute_force(rows: list[tuple[int, str | None]]) -> dict[int, tuple[str, int]]:
    """Every pair compared, for tests: fingerprint and component by doc_id."""
    prints = np.array([fingerprint(t) for _, t in rows], np.uint64)
    ids, comp = [i for i, _ in rows], list(range(len(rows)))

    def find(x: int) -> int:
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= MOST).tolist():
            a, b = sorted((find(i), find(j)), key=lambda k: ids[k])
            comp[b] = a
    return {ids[i]: (f"{int(prints[i]):016x}", ids[find(i)]) for i in range(len(rows))}
