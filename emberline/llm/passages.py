"""Operator 8: substring dedup by collinear chaining.

Of every text the k-mers of words whose hash a fixed number divides are its seeds: a choice by content alone, so that
two texts that share a k-mer choose it both or neither.  Where ``gap`` k-mers in a row hold no such hash, the smallest of
them is taken too, so that no long run is without seeds.

The holders of a seed are joined in the order of the words that follow it, as in a trie.  Those that agree on the next
``SPAN`` words too are one class of the seed: each is linked to the class's text of the smallest id, whatever the
class's size.  The classes' first texts are linked to the two before them in that order and to the two smallest ids, so a
seed costs rows in proportion to its holders, never their square.  A text that shares ``SPAN`` words or more from a seed on
with any other therefore has a link over that seed to a text that shares as many with it.

Classes that a few thousand texts at hand share are folded before the shuffle and unfolded by a join on the fold, so a
seed in a third of all texts moves a row for thousands of texts and links do not depend on how texts are dealt.

By leaders (``op8_passages``), the classes of a seed meet all with all, by windows: a byte for each word around the seed.
A passage of ``least`` words or more holds a part of ``least`` to twice as many, alike in as large a share of one text's
words, and the windows of a seed in that part bound its matches from above, so texts that the bound parts have no such part there.
Of the others the smallest id leads, and those that meet no leader before lead in turn.  Each is compared with its leader
and with all others that the bound admits and that have another leader.  Where a text and its leader share no passage at the
seed, the text is compared with all others of that leader.  So two texts of one leader are either compared, or stand
both in a passage with their leader there: near copies give rows in proportion to their number, not its square.
Classes of one seed agree on ``least`` words here.  Large groups look for rows that share neighbouring words (``_Twos``) first.

In the plain form two texts are compared if they are of one class of a seed, or if two links of theirs are collinear.  All their shared
k-mers become anchors, which a Fenwick tree chains in order in both texts under a linear gap cost; a chain is aligned
word by word, between its anchors and outward from its ends, into a fuzzy passage.  Exact copies are one class throughout.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, saved_at, small_batches, table
from .decontamination import FILTER_BITS, bloom, grams, hash_words

#: Words of a seed, one of how many k-mers is a seed, and the words after a seed's start that its context hashes.
K, ONE_IN, NEAR, SPAN = 5, 6, 16, 39
#: Links of a class's first text within its seed: to those before it, and to the smallest ids.
BEFORE, SMALLEST = 2, 2
GAP = 0.1
#: Words by which what matches may stand nearer to a seed in one text than in the other, in its window.
DRIFT = 24
PASSAGES = "doc_id long, other_id long, start int, end int, other_start int, other_end int, n_match int"


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII spaces, A-Z in lower case."""
    return text.encode().lower().split() if text else []


def seeds_of(hashes: np.ndarray, k: int = K, one_in: int = ONE_IN, gap: int = 32, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct seeds of a text as signed longs, the context that follows each (0 where it first stands), and that place."""
    h = grams(hashes, k)
    keep = h % np.uint64(one_in) == 0
    at = np.flatnonzero(keep)
    bounds = np.concatenate([[-1], at, [len(h)]])
    for n in np.flatnonzero(np.diff(bounds) > gap).tolist():
        for low in range(int(bounds[n]) + 1, int(bounds[n + 1]) - gap + 1, gap):
            keep[low + int(np.argmin(h[low : low + gap]))] = True
    at = np.flatnonzero(keep)
    at = np.sort(at[np.unique(h[at], return_index=True)[1]])
    # words past the end hash as a word of their own, so a text's end is a context too
    padded = np.concatenate([hashes, np.zeros(span, np.uint64)])
    near, far = grams(padded, NEAR)[at], grams(padded, span)[at]
    context = (near >> np.uint64(48) << np.uint64(16) | far >> np.uint64(48)).astype(np.uint32).view(np.int32)
    return h[at].view(np.int64), context, at


class _Best:
    """Fenwick tree of the best (value, anchor) over places below one."""

    def __init__(self, n: int):
        self.value, self.anchor = [-1e18] * (n + 1), [-1] * (n + 1)

    def put(self, i: int, value: float, anchor: int) -> None:
        i += 1
        while i < len(self.value):
            if value > self.value[i]:
                self.value[i], self.anchor[i] = value, anchor
            i += i & -i

    def below(self, i: int) -> tuple[float, int]:
        best, anchor = -1e18, -1
        while i > 0:
            if self.value[i] > best:
                best, anchor = self.value[i], self.anchor[i]
            i -= i & -i
        return best, anchor


def _ahead(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from each place i of a and j of b on are equal, by halving over hashes of all prefixes."""
    if len(i) <= 16:  # a few places are quicker one by one
        out = []
        for x, y in zip(i.tolist(), j.tolist()):
            most, n = min(len(a) - x, len(b) - y), 0
            while n < most:
                m = min(most, n + 32 + n)
                differ = np.flatnonzero(a[x + n : x + m] != b[y + n : y + m])
                if len(differ):
                    n += int(differ[0])
                    break
                n = m
            out.append(n)
        return np.array(out, np.int64)
    step = np.uint64(0x9E3779B97F4A7C15)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(len(a), len(b)), step)]), dtype=np.uint64)
    pre = [np.concatenate([[np.uint64(0)], np.cumsum(h * power[: len(h)], dtype=np.uint64)]) for h in (a, b)]
    low, high = np.zeros(len(i), np.int64), np.minimum(len(a) - i, len(b) - j)
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = (pre[0][i + mid] - pre[0][i]) * power[j] == (pre[1][j + mid] - pre[1][j]) * power[i]
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


_last: list = [None, 0, None]


def _indexed(b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k-mers of b, which of them differ from the one before, and those in order of hash; kept for the next call."""
    if _last[0] is not b or _last[1] != k:
        y = grams(b, k)
        in_y = np.concatenate([[True], y[1:] != y[:-1]])[: len(y)]
        py = np.flatnonzero(in_y)
        py = py[np.argsort(y[py], kind="stable")]
        _last[:] = b, k, (y, in_y, py, y[py])
    return _last[2]


def anchors(a: np.ndarray, b: np.ndarray, k: int = K) -> tuple[list[tuple[int, int]], list[int]]:
    """Places (in a, in b) where runs of shared k-mers begin, in order of a, then b, and the k-mers of each run.

    A text said over and over meets itself in as many runs as it has repeats on both sides together, not in their
    product; of equal k-mers in a row only the first begins a run.
    """
    x, (y, in_y, py, sorted_) = grams(a, k), _indexed(b, k)
    if not len(x) or not len(y):
        return [], []
    in_x = np.concatenate([[True], x[1:] != x[:-1]])
    px = np.flatnonzero(in_x)
    left = np.searchsorted(sorted_, x[px], "left")
    there = sorted_[np.minimum(left, len(sorted_) - 1)] == x[px]
    px, left = px[there], left[there]
    right = np.searchsorted(sorted_, x[px], "right")
    points, runs = [], []
    for part in np.array_split(np.arange(len(px)), 1 + int((right - left).sum()) // 4_000_000):
        n = (right - left)[part]
        i = np.repeat(px[part], n)
        j = py[np.repeat(left[part] - np.cumsum(n) + n, n) + np.arange(len(i))]
        first = (i == 0) | (j == 0) | (x[i - 1] != y[j - 1]) | ~in_x[i - 1] | ~in_y[j - 1]
        i, j = i[first], j[first]
        points += zip(i.tolist(), j.tolist())
        runs += np.maximum(_ahead(a, b, i, j) - k + 1, 1).tolist()
    return points, runs


def chains(points: list[tuple[int, int]], runs: list[int] | None = None, gap: float = GAP) -> list[list[tuple[int, int]]]:
    """Collinear chains, best first, each anchor in one: anchors ascend strictly in both texts.

    An anchor is a run of neighbouring k-mers, of one if ``runs`` is not given.  The score of a chain is 1 a k-mer minus
    ``gap`` a word from one k-mer to the next in either text (so neighbours in a shared run gain); where nothing before
    an anchor pays for its gap, a chain begins.
    """
    if not points:
        return []
    runs = runs or [1] * len(points)
    ends = [(x + n - 1, y + n - 1) for (x, y), n in zip(points, runs)]
    places = sorted({y for _, y in ends})
    rank = {y: r for r, y in enumerate(places)}
    tree, score, back, put = _Best(len(places)), [0.0] * len(points), [-1] * len(points), 0
    by_end = sorted(range(len(points)), key=lambda n: (ends[n][0], n))
    for n, (x, y) in enumerate(points):
        while ends[by_end[put]][0] < x:  # runs that end before this one begins; they begin earlier too, so are scored
            m = by_end[put]
            tree.put(rank[ends[m][1]], score[m] + gap * sum(ends[m]), m)
            put += 1
        value, m = tree.below(bisect_left(places, y))
        score[n] = own = runs[n] - 2 * gap * (runs[n] - 1)
        if m >= 0 and value > gap * (x + y):
            score[n], back[n] = own + value - gap * (x + y), m
    used, out = [False] * len(points), []
    for n in sorted(range(len(points)), key=lambda i: (-score[i], i)):
        chain = []
        while n >= 0 and not used[n]:
            used[n] = True
            chain.append(points[n])
            n = back[n]
        if chain:
            out.append(chain[::-1])
    return out


def _common(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, a bit a word of ``a`` and a step a word of ``b`` (Crochemore et al., 2001)."""
    if not a or not b:
        return 0
    at: dict[bytes, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    every = (1 << len(a)) - 1
    v = every
    for y in b:
        u = v & at.get(y, 0)
        v = (v + u | v - u) & every
    return len(a) - v.bit_count()


def _walk(a: list[bytes], b: list[bytes], i: int, j: int, step: int, drop: int = 8) -> tuple[int, int, int]:
    """Outward from (i, j): words gained in a and b and matches, up to where the score was best.

    A match scores 1, anything else -2; a word that is missing on one side is stepped over; it ends ``drop`` below
    the best.
    """
    n_a, n_b = len(a), len(b)
    score = best = matches = 0
    out, di, dj = (0, 0, 0), 0, 0
    while True:
        x, y = i + step * di, j + step * dj
        if not (0 <= x < n_a and 0 <= y < n_b):
            break
        if a[x] == b[y]:
            score, matches, di, dj = score + 1, matches + 1, di + 1, dj + 1
            if score > best:
                best, out = score, (di, dj, matches)
            continue
        ahead = lambda p, q: all(0 <= p + step * t < n_a and 0 <= q + step * t < n_b and a[p + step * t] == b[q + step * t] for t in (0, 1, 2))
        for p, q in ((1, 1), (1, 0), (0, 1), (2, 2), (2, 1), (1, 2), (2, 0), (0, 2), (3, 3)):
            if ahead(x + step * p, y + step * q):
                score, di, dj = score - 2 * max(p, q), di + p, dj + q
                break
        else:
            break
        if score < best - drop:
            break
    return out


def align(a: list[bytes], b: list[bytes], chain: list[tuple[int, int]]) -> tuple[int, int, int, int, int]:
    """Fuzzy passage of a chain: start and end in a, in b, and matched words."""
    x0, y0 = x, y = chain[0]
    matched = 0
    for i, j in [*chain, (None, None)]:
        if i is not None and (i < x or j < y):
            continue  # inside what the walk along the anchors has matched
        if i is not None and (i > x or j > y):
            p, q = a[x:i], b[y:j]
            matched += _common(p, q)
            x, y = i, j
        while x < len(a) and y < len(b) and a[x] == b[y]:
            x, y, matched = x + 1, y + 1, matched + 1
    left, right = _walk(a, b, x0 - 1, y0 - 1, -1), _walk(a, b, x, y, 1)
    return x0 - left[0], x + right[0], y0 - left[1], y + right[1], matched + left[2] + right[2]


def passages(a: list[bytes], b: list[bytes], hash_a: np.ndarray, hash_b: np.ndarray, least: int, likeness: float) -> list[tuple[int, int, int, int, int]]:
    """Fuzzy passages of at least ``least`` words in both texts that match in at least ``likeness`` of the longer side.

    A chain that falls short is cut at its widest step between two anchors, and each side is tried on its own.
    """
    out: list[tuple[int, int, int, int, int]] = []
    points, runs = anchors(hash_a, hash_b)
    more = {p: n - 1 for p, n in zip(points, runs)}
    for whole in chains(points, runs):
        parts = [whole]
        while parts:
            chain = [(x, y) for x, y in parts.pop() if not any(p <= x < q and r <= y < s for p, q, r, s, _ in out)]
            if not chain:
                continue
            found = align(a, b, chain)
            if min(found[1] - found[0], found[3] - found[2]) >= least and found[4] >= likeness * max(found[1] - found[0], found[3] - found[2]):
                out.append(found)
                parts.append(chain[1:])  # what lies outside the passage
                continue
            steps = [max(q[0] - p[0], q[1] - p[1]) - more[p] for p, q in zip(chain, chain[1:])]
            if steps and max(steps) > 1:
                cut = steps.index(max(steps)) + 1
                parts += [chain[cut:], chain[:cut]]
    return out


def repeated_passages(docs: DataFrame, least: int = 50, likeness: float = 0.8, every: bool = False, leaders: bool = False) -> DataFrame:
    """Rows (doc_id, other_id, start, end, other_start, other_end, n_match): words of doc_id that stand in other_id too.

    Texts with the same words are one class under its smallest doc_id.  Every other row of the class gives one row
    with that id over the whole text, if it has ``least`` words.  Between class representatives the rows are the fuzzy
    passages of the texts that the module's text says are compared; ends are exclusive, numbers count words from 0.
    The rows do not depend on how ``docs`` is partitioned.

    With ``every``, the first texts of a seed's classes are linked each with all others, not with four: no pair of them is
    dropped, at a cost that grows with the square of a seed's classes.  With ``leaders``, they meet all others by their
    windows, and those that one of them leads are not expanded into pairs: each has its row with the leader.

    Null, empty and short texts have no passages.  Rows without an id are left out, as a row here is a pair of ids;
    rows that share an id are one document if their words are the same, and else each is read under that id.
    Passages within one document are not looked for.  Other columns are not read; empty tables give no rows.
    """
    spark = small_batches(docs).sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    # by leaders, texts of one class share a passage with its first text, not only so many words that it may be longer among them
    rows, rows_path = saved_at(texts.mapInArrow(partial(_prepare, span=max(least, NEAR) if leaders else SPAN), PREPARED), "seeds")
    # copies: classes of digests are folded by part, so that a class of any size meets its smallest id in many tasks
    lows = rows.groupBy("digest").agg(F.min("doc_id").alias("low"), F.count("*").alias("members")).filter("members > 1").select("digest", "low")
    folds = rows.select("digest", "part").distinct().join(lows, "digest")
    copies, copies_path = saved_at(rows.select("doc_id", "digest", "part", "n_words").join(folds, ["digest", "part"]).filter("doc_id <> low").select("doc_id", "low", "n_words").distinct(), "copies")
    whole = copies.filter(F.col("n_words") >= least).select("doc_id", F.col("low").alias("other_id"), F.lit(0).alias("start"), F.col("n_words").alias("end"), F.lit(0).alias("other_start"), F.col("n_words").alias("other_end"), F.col("n_words").alias("n_match"))

    held = rows.select("doc_id", "part", F.explode(F.arrays_zip("seed", "context", "at", "folded")).alias("x")).select(F.col("x.seed").alias("seed"), F.col("x.context").alias("context"), "part", "doc_id", F.col("x.at").alias("at"), F.col("x.folded").alias("folded"))
    order = ["seed", "context", "doc_id", "at", "part"]
    followed, followed_path = saved_at(held.repartition("seed").sortWithinPartitions(*order).mapInArrow(_follow_firsts if leaders else _follow_all if every else _follow, FOLLOWED), "seed-links")
    fold = ["seed", "context", "part"]
    members = rows.select("part", "doc_id", F.explode(F.arrays_zip("near_seed", "near_context", "near_at", "near_first", "near_first_at")).alias("x"))
    members = members.select(F.col("x.near_seed").alias("seed"), F.col("x.near_context").alias("context"), "part", "doc_id", F.col("x.near_at").alias("at"), F.col("x.near_first").alias("first"), F.col("x.near_first_at").alias("first_at"))
    unfolded = followed.filter("seed is not null and alike is null").select(*fold, "other_id", "other_at")
    near = members.join(unfolded, fold, "left").select("doc_id", "at", F.coalesce("other_id", "first").alias("other_id"), F.coalesce("other_at", "first_at").alias("other_at"), F.lit(True).alias("alike"))
    links = followed.filter("seed is null").select("doc_id", "at", "other_id", "other_at", "alike").union(near).filter("doc_id <> other_id")
    if leaders:
        firsts = followed.filter("seed is not null and alike is not null").groupBy("doc_id").agg(F.collect_list(F.struct("seed", "at")).alias("x"))
        windows = firsts.hint("merge").join(rows.select("doc_id", "codes"), "doc_id").mapInArrow(partial(_windows, least=least), WINDOWS)
        led, led_path = saved_at(windows.repartition("seed").sortWithinPartitions("seed", "doc_id", "at").mapInArrow(partial(_meet, least=least, likeness=likeness), LED), "passage-leaders")
        pairs = links.select("doc_id", "other_id").union(led.select("doc_id", "other_id")).distinct()
    else:
        # one entry a seed that both texts hold
        met = links.groupBy("doc_id", "other_id").agg(F.max("alike").alias("alike"), F.collect_list(F.struct("at", "other_at")).alias("links")).filter("alike or size(links) > 1")
        pairs = met.filter("alike").select("doc_id", "other_id").union(met.filter("not alike").select("doc_id", "other_id", F.array_sort("links").alias("links")).mapInArrow(_collinear, "doc_id long, other_id long"))
    low = copies.select(F.col("doc_id").alias("other_id"), "low").distinct()

    def between_classes(pairs: DataFrame) -> DataFrame:
        pairs = pairs.join(copies.select("doc_id"), "doc_id", "left_anti").join(low, "other_id", "left").select("doc_id", F.coalesce("low", "other_id").alias("other_id")).filter("doc_id <> other_id")
        return pairs.select(F.greatest("doc_id", "other_id").alias("doc_id"), F.least("doc_id", "other_id").alias("other_id")).distinct()

    pairs, _ = saved_at(between_classes(pairs), "passage-pairs")
    for path in (rows_path, followed_path):
        discard(spark, path)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come by other_id from the join, so each other text is read once
        known: tuple[str | None, list, np.ndarray] = (None, [], np.zeros(0, np.uint64))
        for batch in batches:
            out = []
            for doc_id, other_id, text, other in zip(*batch.columns):
                other = other.as_py()
                if known[0] != other:
                    b = words_of(other)
                    known = (other, b, hash_words(b))
                a = words_of(text.as_py())
                out += [(doc_id.as_py(), other_id.as_py(), *p) for p in passages(a, known[1], hash_words(a), known[2], least, likeness)]
            cols = list(zip(*out)) or [[]] * 7
            kinds = (pa.int64(),) * 2 + (pa.int32(),) * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[x.split()[0] for x in PASSAGES.split(", ")])

    def compared(pairs: DataFrame) -> DataFrame:
        # only texts of pairs move, the others stay behind a filter of fixed size; merged at every size: no side is small for
        # long, and large keys of other_id can be split
        some = texts.filter(among(pairs.select(F.explode(F.array("doc_id", "other_id")).alias("doc_id")))(F.xxhash64("doc_id")))
        needed = lambda c: some.join(pairs.select(F.col(c).alias("doc_id")).distinct(), "doc_id", "left_semi")
        with_doc = pairs.hint("merge").join(needed("doc_id"), "doc_id")
        with_both = with_doc.hint("merge").join(needed("other_id").select(F.col("doc_id").alias("other_id"), F.col("text").alias("other")), "other_id").select("doc_id", "other_id", "text", "other")
        return with_both.mapInArrow(compare, PASSAGES).distinct()

    if not leaders:
        return compared(pairs).union(whole.distinct())
    found, _ = saved_at(compared(pairs), "passages")
    led = led.filter("seed is not null")
    there = F.expr(f"at >= start and at + {K} <= end and led_at >= other_start and led_at + {K} <= other_end and abs(at - start - led_at + other_start) <= {DRIFT}")
    spans = found.select("doc_id", "other_id", "start", "end", "other_start", "other_end")
    held = led.withColumnRenamed("other_at", "led_at").join(spans, ["doc_id", "other_id"]).filter(there).select("seed", "doc_id", "other_id").distinct()
    alone = led.join(held, ["seed", "doc_id", "other_id"], "left_anti").select("seed", "other_id", "doc_id")
    rest = alone.join(led.select("seed", "other_id", F.col("doc_id").alias("mate")), ["seed", "other_id"]).filter("doc_id <> mate").select("doc_id", F.col("mate").alias("other_id")).distinct()
    rest, _ = saved_at(between_classes(rest).join(pairs, ["doc_id", "other_id"], "left_anti"), "passage-pairs-unled")
    discard(spark, led_path)
    return found.union(compared(rest)).union(whole.distinct())


def among(ids: DataFrame):
    """A function of ``xxhash64(doc_id)``: true for the rows of ``ids``, and for few others."""
    shared = ids.sparkSession.sparkContext.broadcast(bloom(ids.select(F.array(F.xxhash64("doc_id")).alias("hashes"))))

    @F.pandas_udf("boolean")
    def held(hashes: pd.Series) -> pd.Series:
        p = hashes.to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)
        return pd.Series((shared.value[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool))

    return held


PREPARED = (
    "doc_id long, part long, digest binary, codes binary, n_words int, seed array<long>, context array<int>, at array<int>, folded array<boolean>, "
    "near_seed array<long>, near_context array<int>, near_at array<int>, near_first array<long>, near_first_at array<int>"
)


def _prepare(batches: Iterator[pa.RecordBatch], most_docs: int = 4096, most_words: int = 2_000_000, span: int = SPAN) -> Iterator[pa.RecordBatch]:
    """A row a text: its part (the texts at hand), digest, and seeds in two lists: those of which it is the first at hand
    (and whether others at hand fold into it), and those that fold into another (with that id and its place there); and a
    byte a word, never 0."""
    import hashlib
    import uuid

    ids, digests, codes, sizes, seeds, words_held = [], [], [], [], [], 0

    def flush() -> pa.RecordBatch:
        n, part = len(ids), uuid.uuid4().int >> 65
        count = np.array([len(x[0]) for x in seeds])
        doc, key = np.repeat(np.arange(n), count), np.array(ids, np.int64)
        seed, context, at = (np.concatenate([x[c] for x in seeds]) for c in range(3))
        at = at.astype(np.int32)
        order = np.lexsort((at, key[doc], context, seed))
        s, c = seed[order], context[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
        starts = np.flatnonzero(new)
        size = np.diff(np.append(starts, len(s)))
        first, first_at = np.empty(len(s), np.int64), np.empty(len(s), np.int32)
        first[order], first_at[order] = np.repeat(key[doc[order[starts]]], size), np.repeat(at[order[starts]], size)
        own, folded = np.zeros(len(s), bool), np.zeros(len(s), bool)
        own[order[starts]], folded[order[starts]] = True, size > 1

        def lists(which: np.ndarray, *values: np.ndarray) -> list[pa.ListArray]:
            offsets = np.concatenate([[0], np.cumsum(np.bincount(doc[which], minlength=n))]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(v[which])) for v in values]

        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([part] * n, pa.int64()), pa.array(digests, pa.binary()), pa.array(codes, pa.binary()), pa.array(sizes, pa.int32()), *lists(own, seed, context, at, folded), *lists(~own, seed, context, at, first, first_at)],
            names=[x.split()[0] for x in PREPARED.split(", ")],
        )

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = words_of(text.as_py())
            ids.append(doc_id)
            digests.append(hashlib.md5(b" ".join(words)).digest())
            sizes.append(len(words))
            hashes = hash_words(words)
            codes.append(((hashes >> np.uint64(13)) % np.uint64(255) + np.uint64(1)).astype(np.uint8).tobytes())
            seeds.append(seeds_of(hashes, span=span))
            words_held += len(words)
            if len(ids) >= most_docs or words_held >= most_words:
                yield flush()
                ids, digests, codes, sizes, seeds, words_held = [], [], [], [], [], 0
    if ids:
        yield flush()


#: A link (seed null), what a fold's first is linked to in turn (seed, context and part of the fold; alike null), or, for
#: leaders, the first text of a class of a seed that has several (seed and alike are there).
FOLLOWED = "seed long, context int, part long, doc_id long, at int, other_id long, other_at int, alike boolean"


def _neighbours(group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (i, j) of rows of one group to be linked: each with those before it and with its group's smallest ids."""
    i, j = [], []
    n = np.arange(len(doc))
    for s in range(1, BEFORE + 1):
        near = n[s:][group[s:] == group[:-s]]
        i.append(near)
        j.append(near - s)
    order = np.lexsort((doc, group))
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else n
    size = np.diff(np.append(starts, len(group)))
    for s in range(SMALLEST):
        least = np.repeat(np.where(size > s, order[np.minimum(starts + s, len(group) - 1)], -1), size)
        i.append(n[least >= 0])
        j.append(least[least >= 0])
    i, j = np.concatenate(i), np.concatenate(j)
    i, j = np.where(doc[i] > doc[j], i, j), np.where(doc[i] > doc[j], j, i)
    both = np.unique(np.stack([i, j]), axis=1) if len(i) else np.zeros((2, 0), np.int64)
    i, j = both
    different = doc[i] != doc[j]
    return i[different], j[different]


def _all_pairs(group: np.ndarray, doc: np.ndarray, most: int = 1_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers (i, j) of every two rows of one group, about ``most`` at a time."""
    n = np.arange(len(group))
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else n
    before = n - np.repeat(starts, np.diff(np.append(starts, len(group))))
    total = np.concatenate([[0], np.cumsum(before)])
    low = 0
    while low < len(n):
        high = max(low + 1, int(np.searchsorted(total, total[low] + most, "right")) - 1)
        count = before[low:high]
        i = np.repeat(n[low:high], count)
        j = np.repeat((n - before)[low:high], count) + np.arange(len(i)) - np.repeat(total[low:high] - total[low], count)
        i, j = np.where(doc[i] > doc[j], i, j), np.where(doc[i] > doc[j], j, i)
        different = doc[i] != doc[j]
        yield i[different], j[different]
        low = high


def _follow_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _follow(batches, every=True)


def _follow_firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _follow(batches, every=True, firsts_alone=True)


def _follow(batches: Iterator[pa.RecordBatch], most: int = 65_536, every: bool = False, firsts_alone: bool = False) -> Iterator[pa.RecordBatch]:
    """Links of rows (seed, context, part, doc_id, at, folded) in order of seed, context and id; a seed may span batches.

    The first texts of a seed's classes are held until the seed ends; beyond ``most`` of them, those at hand are linked
    and the ones that later classes link to are held on.  For ``every`` link all are held, and each meets all others;
    with ``firsts_alone`` they are given as they are, if their seed has several.
    """
    names = [x.split()[0] for x in FOLLOWED.split(", ")]
    last, head = None, (0, 0)
    held = np.zeros((3, 0), np.int64)  # seed, id, place of classes' first texts

    def linked(firsts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if firsts_alone:
            new = np.concatenate([[True], firsts[0, 1:] != firsts[0, :-1]])
            size = np.diff(np.append(np.flatnonzero(new), firsts.shape[1]))
            seed, doc, at = firsts[:, np.repeat(size > 1, size)]
            n = len(seed)
            yield pa.RecordBatch.from_arrays([pa.array(seed), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.array(doc), pa.array(at.astype(np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.array(np.zeros(n, bool))], names=names)
            return
        for i, j in _all_pairs(firsts[0], firsts[1]) if every else [_neighbours(firsts[0], firsts[1])]:
            n = len(i)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.array(firsts[1][i]), pa.array(firsts[2][i].astype(np.int32)), pa.array(firsts[1][j]), pa.array(firsts[2][j].astype(np.int32)), pa.array(np.zeros(n, bool))],
                names=names,
            )

    for batch in batches:
        seed, context, part, doc, at, folded = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(seed):
            continue
        new = np.ones(len(seed), bool)
        new[1:] = (seed[1:] != seed[:-1]) | (context[1:] != context[:-1])
        new[0] = last != (seed[0], context[0])
        which = np.cumsum(new)
        heads, heads_at = np.concatenate([[head[0]], doc[new]])[which], np.concatenate([[head[1]], at[new]])[which]
        last, head = (seed[-1], context[-1]), (int(heads[-1]), int(heads_at[-1]))
        link, back = heads != doc, (heads != doc) & folded
        n = int(link.sum())
        none = np.ones(n, bool)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.array(doc[link]), pa.array(at[link].astype(np.int32)), pa.array(heads[link]), pa.array(heads_at[link].astype(np.int32)), pa.array(none)], names=names
        )
        n = int(back.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(seed[back]), pa.array(context[back].astype(np.int32)), pa.array(part[back]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.array(heads[back]), pa.array(heads_at[back].astype(np.int32)), pa.nulls(n, pa.bool_())],
            names=names,
        )
        held = np.concatenate([held, np.stack([seed[new], doc[new], at[new].astype(np.int64)])], axis=1)
        open_ = held[0] == held[0, -1] if held.shape[1] else np.zeros(0, bool)
        done = held[:, ~open_]
        if done.shape[1]:
            yield from linked(done)
        held = held[:, open_]
        if held.shape[1] > most and not every:
            yield from linked(held)
            keep = np.unique(np.concatenate([np.argsort(held[1], kind="stable")[:SMALLEST], np.arange(held.shape[1] - BEFORE, held.shape[1])]))
            held = held[:, keep]
    if held.shape[1]:
        yield from linked(held)


WINDOWS = "seed long, doc_id long, at int, window binary"
#: A text and its leader at a seed, or two texts of different leaders (seed null).
LED = "seed long, doc_id long, at int, other_id long, other_at int"


def _reach(least: int) -> int:
    """Words of a window on each side of its seed: all of a part of less than twice ``least`` words, in eights."""
    return max(8, -(-(2 * least - 1 - K) // 8) * 8)


def window(codes: np.ndarray, at: int, reach: int) -> np.ndarray:
    """Codes of the ``reach`` words before the seed at ``at`` and of those after it; 0 beyond the text."""
    out = np.zeros(2 * reach, np.uint8)
    left, right = codes[max(0, at - reach) : at], codes[at + K : at + K + reach]
    out[reach - len(left) : reach] = left
    out[reach : reach + len(right)] = right
    return out


def _windows(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    reach = _reach(least)
    for batch in batches:
        out: tuple[list, list, list, list] = ([], [], [], [])
        for doc_id, firsts, codes in zip(*(batch.column(c) for c in ("doc_id", "x", "codes"))):
            codes = np.frombuffer(codes.as_py(), np.uint8)
            for seed, at in zip(*(x.to_pylist() for x in firsts.values.flatten())):
                for held, value in zip(out, (seed, doc_id.as_py(), at, window(codes, at, reach).tobytes())):
                    held.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        for low in range(0, len(out[0]) or 1, 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(held[low : low + 10_000], t) for held, t in zip(out, kinds)], names=["seed", "doc_id", "at", "window"])


class _Bound:
    """Whether the windows of two texts leave room for ``least`` words around their seed, ``likeness`` of them matched.

    A word matches at most if its code stands on the same side of the other's seed, at most ``DRIFT`` words nearer or farther.
    """

    def __init__(self, least: int, likeness: float):
        self.reach, self.slack = _reach(least), 1 - likeness
        self.row = np.arange(2 * self.reach) * 256
        self.need = np.maximum(0, least - K - np.arange(self.reach + 1))  # words to the right, for so many to the left
        at = np.arange(2 * self.reach)
        off = at[:, None] + np.arange(-DRIFT, DRIFT + 1)[None, :]
        same = (off >= 0) & (off // self.reach == at[:, None] // self.reach)
        self.there, self.from_ = off[same], np.repeat(at, same.sum(1))  # places, and the words of b that may stand there
        eights = np.arange(self.reach // 8 + 1)
        self.need_eights = np.minimum(len(eights) - 1, np.maximum(0, -(-(least - K - 14) // 8) - eights))
        self.need = np.minimum(self.reach, self.need)

    def _least_cost(self, left: np.ndarray, right: np.ndarray, need: np.ndarray) -> np.ndarray:
        zero = np.zeros((len(left), 1), np.float32)
        left, right = (np.concatenate([zero, np.cumsum(x, 1, dtype=np.float32)], 1) for x in (left, right))
        beyond = np.minimum.accumulate(right[:, ::-1], 1)[:, ::-1]
        return (left + beyond[:, need]).min(1)

    def _admits(self, hit: np.ndarray, a: np.ndarray) -> np.ndarray:
        """By eights of words first, where up to seven more words a side cost nothing; then word by word."""
        reach, slack = self.reach, np.float32(self.slack)
        missed = np.float32(8) - np.bitwise_count(hit.view(np.uint64)) - 8 * slack
        e = reach // 8
        out = self._least_cost(missed[:, e - 1 :: -1], missed[:, e:], self.need_eights) <= (14 + K) * slack + 1e-3
        some = np.flatnonzero(out)
        cost = np.where(hit[some], -slack, 1 - slack)
        cost[a[some] == 0] = 1000
        out[some] = self._least_cost(cost[:, reach - 1 :: -1], cost[:, reach:], self.need) <= K * slack + 1e-3
        return out

    def sets(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each eight words of the windows the set of their codes, four words of bits, and how many lie beyond the text."""
        n, eights = len(windows), 2 * self.reach // 8
        out = np.zeros((eights, 4, n), np.uint64)
        row, e = np.arange(n)[:, None], np.arange(eights)[None, :]
        for x in range(8):
            code = windows[:, x::8]
            out[e, code >> 6, row] |= np.where(code > 0, np.uint64(1) << (code & 63).astype(np.uint64), np.uint64(0))
        beyond = np.ascontiguousarray((windows == 0).reshape(n, eights, 8).sum(2, dtype=np.uint8).T)
        return out, beyond

    def near(self, sets: np.ndarray) -> np.ndarray:
        """The codes of each eight words and of those ``DRIFT`` words off on the same side."""
        half, near = self.reach // 8, sets.copy()
        for side in (slice(0, half), slice(half, 2 * half)):
            own, out = sets[side], near[side]
            for s in range(1, min(half - 1, -(-DRIFT // 8)) + 1):
                out[s:] |= own[:-s]
                out[:-s] |= own[s:]
        return near

    def may(self, sets: np.ndarray, beyond: np.ndarray, near: np.ndarray) -> np.ndarray:
        """By eights of words alone: for each column of ``sets``, and the same of ``near``, or its only one."""
        half = self.reach // 8
        # a code that is missing is one word at least that matches nothing
        missed = np.bitwise_count(sets & ~near).sum(1, dtype=np.uint8) + beyond
        cost = missed.astype(np.float32) - np.float32(8 * self.slack)
        left, right = [np.zeros(sets.shape[2], np.float32)], [np.zeros(sets.shape[2], np.float32)]
        for e in range(half):
            left.append(left[-1] + cost[half - 1 - e])
            right.append(right[-1] + cost[half + e])
        for e in range(half - 1, -1, -1):
            right[e] = np.minimum(right[e], right[e + 1])
        best = left[0] + right[self.need_eights[0]]
        for e in range(1, half + 1):
            np.minimum(best, left[e] + right[self.need_eights[e]], out=best)
        return best <= (14 + K) * self.slack + 1e-3

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each row of a and the same of b."""
        out, reach = np.zeros(len(a), bool), self.reach
        for low in range(0, len(a), 1024):
            x, y = a[low : low + 1024], b[low : low + 1024]
            hit = x == y
            for side in (slice(0, reach), slice(reach, 2 * reach)):
                h, p, q = hit[:, side], x[:, side], y[:, side]
                for s in range(1, min(DRIFT, reach - 1) + 1):
                    h[:, s:] |= p[:, s:] == q[:, :-s]
                    h[:, :-s] |= p[:, :-s] == q[:, s:]
            out[low : low + 1024] = self._admits(hit, x)
        return out

    def one(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each row of a and the one window b."""
        near = np.zeros((2 * self.reach, 256), bool)
        near[self.there, b[self.from_]] = True
        near[:, 0] = False
        flat, out = near.reshape(-1), np.zeros(len(a), bool)
        for low in range(0, len(a), 512):
            x = a[low : low + 512]
            out[low : low + 512] = self._admits(flat[x + self.row], x)
        return out


class _Twos:
    """Which rows of one large group share enough pairs of neighbouring words, by side, to hold a passage around their seed.

    A passage of n words in either text, ``likeness`` of the longer side matched, matches in at most 1 + its unmatched words
    runs, so at least (3 * likeness - 2) * n - 1 pairs of neighbours are shared.  The seed and its two edges hold 6 at most.
    A row asks for its scarcer pairs alone: as many common ones are left out as leave it ``enough`` in every part.
    """

    EDGE = K + 1

    def __init__(self, windows: np.ndarray, bound: _Bound, enough: int = 3):
        self.n, self.reach, rate = len(windows), bound.reach, 3 * (1 - bound.slack) - 2
        width = 2 * (self.reach - 1)
        # each pair at its first place in a row, and at how many it stands there
        self.pairs, self.times = np.full((self.n, width), -1, np.int32), np.zeros((self.n, width), np.uint8)
        for low in range(0, self.n, 4096):
            x = self._of(windows[low : low + 4096])
            order = np.argsort(x, axis=1, kind="stable")
            sorted_ = np.take_along_axis(x, order, 1).reshape(-1)
            new = np.ones(len(sorted_), bool)
            new[1:] = (sorted_[1:] != sorted_[:-1]) | (np.arange(1, len(sorted_)) % width == 0)
            starts = np.flatnonzero(new)
            at = (starts // width, order.reshape(-1)[starts])
            self.pairs[low : low + 4096][at], self.times[low : low + 4096][at] = sorted_[starts], np.diff(np.append(starts, len(sorted_)))
        self.holders = np.bincount(self.pairs[self.pairs >= 0], minlength=1 << 17)
        self.most, self.least = np.full(self.n, -1), np.zeros(self.n, np.int64)  # 0: any row may hold one
        levels = [max(1, self.n >> s) for s in range(10, -1, -1)]
        for low in range(0, self.n, 4096):
            x, beyond = self._of(windows[low : low + 4096]), windows[low : low + 4096] == 0
            held, rest = np.where(x >= 0, self.holders[x], 0), np.arange(len(x))
            for want, level in [(w, v) for w in (enough, 1) for v in levels]:
                common = held[rest] > level
                cost = np.full((len(rest), 2 * self.reach), rate, np.float32)
                cost[:, : self.reach - 1] -= common[:, : self.reach - 1]
                cost[:, self.reach + 1 :] -= common[:, self.reach - 1 :]
                cost[beyond[rest]] = 1000
                shared = np.ceil(bound._least_cost(cost[:, self.reach - 1 :: -1], cost[:, self.reach :], bound.need) + rate * K - 1 - self.EDGE - 1e-3)
                ok = shared >= want
                self.most[low + rest[ok]], self.least[low + rest[ok]] = level, shared[ok]
                rest = rest[~ok]
                if not len(rest):
                    break

    def _of(self, windows: np.ndarray) -> np.ndarray:
        """The pairs of each row, by side; -1 beyond the text."""
        w = windows.astype(np.int32).reshape(-1, 2, self.reach)
        x = w[:, :, :-1] << 8 | w[:, :, 1:] | np.array([0, 1 << 16], np.int32)[None, :, None]
        return np.where((w[:, :, :-1] > 0) & (w[:, :, 1:] > 0), x, -1).reshape(len(w), -1)

    def index(self, order: np.ndarray) -> None:
        """Rows by pair, in this order, in which they are walked from here on."""
        by_pair = np.argsort(self.pairs[order].reshape(-1), kind="stable")[-int(self.holders.sum()) or self.pairs.size :]
        self.rows = (by_pair // self.pairs.shape[1]).astype(np.int32)
        self.ends = np.cumsum(self.holders)
        self.starts = self.ends - self.holders
        self.walked = self.starts.copy()

    def walk(self, rows: np.ndarray) -> None:
        for row in rows:
            x = self.pairs[row]
            self.walked[x[x >= 0]] += 1

    def ask(self, row: int, ranges: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], first: int) -> np.ndarray | None:
        """Places from ``first`` on in the order walked whose rows share enough of the row's pairs, as listed within ``ranges``; none if any may."""
        if not self.least[row]:
            return None
        x = self.pairs[row]
        scarce = np.flatnonzero((x >= 0) & (self.holders[x] <= self.most[row]))
        low, high = ranges(x[scarce])
        size = high - low
        total = int(size.sum())
        if total > 16 * self.n:
            return None
        times = np.resize(self.times[row, scarce], len(size))
        found = self.rows[np.arange(total) + np.repeat(low - np.cumsum(size) + size, size)]
        shared = np.bincount(found, np.repeat(times, size) if (times > 1).any() else None, first)
        return first + np.flatnonzero(shared[first:] >= self.least[row])


def _led_by_twos(windows: np.ndarray, bound: _Bound) -> tuple[np.ndarray, np.ndarray]:
    """``led`` for one large group."""
    n, twos, cross = len(windows), _Twos(windows, bound), [np.zeros((0, 2), np.int64)]
    lead, held = np.full(n, -1), []

    def admitted(rows: np.ndarray, j: int) -> np.ndarray:
        """Of ``rows`` those that the bound admits with j."""
        if len(rows) > 1024:
            if not held:
                held.extend(bound.sets(windows))
            rows = rows[bound.may(held[0][:, :, rows], held[1][:, rows], bound.near(held[0][:, :, j, None]))]
        return rows[bound.one(windows[rows], windows[j])] if len(rows) else rows

    twos.index(np.arange(n))
    for j in range(n):
        twos.walk([j])
        if lead[j] >= 0:
            continue
        lead[j] = j
        rows = twos.ask(j, lambda x: (twos.walked[x], twos.ends[x]), j + 1)
        ok = admitted(np.arange(j + 1, n) if rows is None else rows, j)
        new = lead[ok] < 0
        lead[ok[new]] = j
        cross.append(np.stack([ok[~new], np.full(np.count_nonzero(~new), j)], axis=1))
    # those that are led meet what others lead: in order of leaders, so that their own leader's rows are stepped over
    order = np.argsort(lead, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(lead[order]) > 0]))
    size = np.diff(np.append(starts, n))
    if (size > 1).any():
        twos.index(order)
    else:
        starts = starts[:0]
    for start, count in zip(starts.tolist(), size.tolist()):
        before = twos.walked.copy() if count > 1 else None
        rows = order[start : start + count]
        twos.walk(rows)
        for j in rows[rows != lead[rows[0]]].tolist():
            ask = lambda x, before=before: (np.concatenate([twos.starts[x], twos.walked[x]]), np.concatenate([before[x], twos.ends[x]]))
            places = twos.ask(j, ask, 0)
            others = np.arange(j + 1, n) if places is None else order[places]
            ok = admitted(others[(others > j) & (lead[others] != lead[j])], j)
            cross.append(np.stack([ok, np.full(len(ok), j)], axis=1))
    return lead, np.concatenate(cross)


def led(group: np.ndarray, doc: np.ndarray, windows: np.ndarray, bound: _Bound, small: int = 64, large: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's leader (its own, if it leads), and the pairs of rows (i, j) of different leaders that the bound
    admits; in groups of more than ``large`` rows those of them that share the words of a passage two by two.  Rows are in
    order of group and id."""
    lead, cross = np.full(len(group), -1), [np.zeros((0, 2), np.int64)]
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(starts, len(group)))
    few = np.flatnonzero(np.repeat(size <= small, size))
    pairs = [np.zeros((2, 0), np.int64)]
    sets, beyond = bound.sets(windows[few])
    near = bound.near(sets)
    for i, j in _all_pairs(group[few], doc[few], 4096):
        i, j = np.maximum(i, j), np.minimum(i, j)
        some = bound.may(sets[:, :, i], beyond[:, i], near[:, :, j])
        i, j = few[i[some]], few[j[some]]
        ok = bound.pairs(windows[i], windows[j])
        pairs.append(np.stack([i[ok], j[ok]]))
    i, j = np.concatenate(pairs, axis=1)
    order = np.lexsort((i, j))
    for i, j in zip(i[order].tolist(), j[order].tolist()):
        if lead[j] < 0:
            lead[j] = j
        if lead[j] == j and lead[i] < 0:
            lead[i] = j
        elif lead[i] != lead[j]:
            cross.append(np.array([[i, j]]))
    for start, n in zip(starts[size > small].tolist(), size[size > small].tolist()):
        if n > large:
            own_lead, own_cross = _led_by_twos(windows[start : start + n], bound)
            lead[start : start + n] = start + own_lead
            cross.append(start + own_cross)
            continue
        sets, beyond = bound.sets(windows[start : start + n])
        own = lambda j, start=start, sets=sets: bound.near(sets[:, :, j - start, None])
        for j in range(start, start + n - 1):
            leads = lead[j] < 0
            if leads:
                lead[j] = j
            rest = np.arange(j + 1, start + n)
            others = lead[rest] != lead[j]
            if 4 * np.count_nonzero(others) > len(rest):
                rest = rest[bound.may(sets[:, :, j + 1 - start :], beyond[:, j + 1 - start :], own(j)) & others]
            else:
                rest = rest[others]
                rest = rest[bound.may(sets[:, :, rest - start], beyond[:, rest - start], own(j))]
            ok = rest[bound.one(windows[rest], windows[j])] if len(rest) else rest
            if leads:
                new = lead[ok] < 0
                lead[ok[new]] = j
                ok = ok[~new]
            cross.append(np.stack([ok, np.full(len(ok), j)], axis=1))
    alone = lead < 0
    lead[alone] = np.flatnonzero(alone)
    return lead, np.concatenate(cross)


def _meet(batches: Iterator[pa.RecordBatch], least: int, likeness: float, most: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Rows of ``LED`` from those of ``WINDOWS`` in order of seed and id; a seed may span batches, and is held whole."""
    bound, names = _Bound(least, likeness), [x.split()[0] for x in LED.split(", ")]

    def met(seed: np.ndarray, doc: np.ndarray, at: np.ndarray, windows: np.ndarray) -> Iterator[pa.RecordBatch]:
        lead, cross = led(seed, doc, windows, bound)
        i = np.flatnonzero(doc != doc[lead])
        yield pa.RecordBatch.from_arrays([pa.array(seed[i]), pa.array(doc[i]), pa.array(at[i]), pa.array(doc[lead[i]]), pa.array(at[lead[i]])], names=names)
        ids = np.unique(np.stack([doc[cross[:, 0]], doc[cross[:, 1]]]), axis=1) if len(cross) else np.zeros((2, 0), np.int64)
        n, ids = 0, ids[:, ids[0] != ids[1]]
        n = ids.shape[1]
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.array(ids[0]), pa.nulls(n, pa.int32()), pa.array(ids[1]), pa.nulls(n, pa.int32())], names=names)

    held, count = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        seed, doc, at = (batch.column(c).to_numpy() for c in range(3))
        held.append((seed, doc, at, np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(len(seed), -1)))
        count += len(seed)
        if count >= most and seed[0] != seed[-1]:
            whole = [np.concatenate(x) for x in zip(*held)]
            end = int(np.searchsorted(whole[0], whole[0][-1], "left"))
            yield from met(*(x[:end] for x in whole))
            held, count = [tuple(x[end:] for x in whole)], len(whole[0]) - end
    if count:
        yield from met(*(np.concatenate(x) for x in zip(*held)))


def collinear(links: list[tuple[int, int]], reach: int = 128, ahead: int = 16) -> bool:
    """Whether two links, in order of place, are some words on in both texts by about as much."""
    for n, (x, y) in enumerate(links):
        for p, q in links[n + 1 : n + 1 + ahead]:
            if p - x > reach:
                break
            if p > x and q > y and abs((p - x) - (q - y)) <= 4 + 0.25 * max(p - x, q - y):
                return True
    return False


def _collinear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = pa.array([collinear([(x["at"], x["other_at"]) for x in links]) for links in batch.column(2).to_pylist()], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["doc_id", "other_id"])


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"), leaders=True)
