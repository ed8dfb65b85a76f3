"""op8's large groups: rows meet by the words that they share two by two, in place of all pairs; none with a passage is lost."""

import random

import numpy as np

from emberline.llm import passages as P

from .test_passage_links import SCHEMA, fresh


class Counted(P._Bound):
    rows = 0

    def may(self, sets, beyond, near):
        self.rows += sets.shape[2]
        return super().may(sets, beyond, near)

    def one(self, a, b):
        self.rows += len(a)
        return super().one(a, b)


def group(r, n, line, families):
    """Windows around a common line; those of a family share the words around it, each with edits of its own."""
    rows = r.integers(1, 256, (n, 192)).astype(np.uint8)
    rows[:, 96 - line : 96 + line] = r.integers(1, 256, 2 * line)
    for members in families:
        shared = rows[members[0]].copy()
        for k in members[1:]:
            low = int(r.integers(38, 80))
            part = np.arange(low, low + 75)
            rows[k, part] = shared[part]
            edits = [p for p in r.choice(part, 9, replace=False) if not 96 - line <= p < 96 + line]
            rows[k, edits] = r.integers(1, 256, len(edits))
    return rows


def test_a_common_line_in_many_unlike_texts_is_not_met_pair_by_pair():
    n = 2000
    windows, bound = group(np.random.default_rng(1), n, 4, []), Counted(50, 0.8)
    lead, cross = P.led(np.zeros(n, np.int64), np.arange(n), windows, bound)
    assert bound.rows < 0.01 * n * n and (lead == np.arange(n)).all() and not len(cross)


def test_the_same_rows_are_led_as_where_all_pairs_are_met():
    r = np.random.default_rng(2)
    families = [list(range(5, 400, 5)), [1, 2, 3], [400, 7, 9], *([k, k + 30] for k in range(401, 430))]
    windows, bound = group(r, 500, 4, [sorted(f) for f in families]), P._Bound(50, 0.8)
    windows[460:470, 50:150] = 7  # one word over and over
    windows[470:475, :96] = windows[475:480, 150:] = 0  # texts that begin or end there
    where = np.zeros(500, np.int64), np.arange(500), windows, bound
    lead, cross = P.led(*where, large=400)
    want, pairs = P.led(*where)
    # a row of one word is admitted by all that hold the word once; it shares nothing two by two with them
    other = np.delete(np.arange(500), range(460, 470))
    assert (lead[other] == want[other]).all() and (lead[460:470] == 460).all() and len(set(want.tolist())) < 450
    kept = lambda pairs: {(i, j) for i, j in pairs.tolist() if not {i, j} & set(range(460, 470))}
    assert kept(cross) == kept(pairs) == {tuple(x) for x in cross.tolist()}


def test_texts_that_share_more_than_the_first_of_their_class_are_found(spark):
    """A word over and over has one seed a text; the text of the smallest id has too few of it for a passage."""
    r = random.Random(3)
    rows = [(k, fresh(r, 60) + ["and"] * n + fresh(r, 60)) for k, n in ((1, 45), (2, 70), (3, 70))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], SCHEMA)
    assert {(x.doc_id, x.other_id) for x in P.repeated_passages(docs, leaders=True).collect()} == {(3, 2)}


def test_texts_without_pairs_stay_behind_the_filter(spark):
    held = P.among(spark.range(0, 3000, 3).withColumnRenamed("id", "doc_id"))
    from pyspark.sql import functions as F

    got = {x.doc_id for x in spark.range(3000).withColumnRenamed("id", "doc_id").filter(held(F.xxhash64("doc_id"))).collect()}
    assert set(range(0, 3000, 3)) <= got and len(got) < 1010


def test_hashes_of_runs_of_words_are_those_of_word_by_word():
    hashes = np.random.default_rng(4).integers(0, 1 << 64, 70, np.uint64)
    for k in (1, 2, 3, 5, 16, 39, 50, 69, 70, 71):
        want = []
        for i in range(len(hashes) - k + 1):
            x = 0
            for h in hashes[i : i + k].tolist():
                x = (x * 0x9E3779B97F4A7C15 + h) % (1 << 64)
            x = (x ^ x >> 31) * 0xBF58476D1CE4E5B9 % (1 << 64)
            want.append(x ^ x >> 29)
        assert P.grams(hashes, k).tolist() == want
