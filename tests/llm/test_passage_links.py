"""Planted passages through the whole operator: none is lost to other holders of its seeds, to edits or to the layout."""

import random

import pytest

from emberline.llm import passages as P

from .helpers import documents

SCHEMA = "doc_id long, text string"


def fresh(r, n):
    return [f"w{r.randrange(10**9)}" for _ in range(n)]


def test_runs_whose_halves_stand_in_earlier_texts_are_found(spark):
    r, rows = random.Random(5), []
    for k in range(100):
        run = fresh(r, 56)
        rows += [(k, fresh(r, 60) + run[:28] + fresh(r, 60)), (100 + k, fresh(r, 60) + run[28:] + fresh(r, 60))]
        rows += [(1000 + k, fresh(r, 80) + run + fresh(r, 40)), (2000 + k, fresh(r, 30) + run + fresh(r, 90))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], SCHEMA)
    found = {(x.doc_id, x.other_id): (x.start, x.end, x.other_start, x.other_end) for x in P.repeated_passages(docs).collect()}
    assert found == {(2000 + k, 1000 + k): (30, 86, 80, 136) for k in range(100)}


def edited(r, words, every):
    return [f"e{r.randrange(10**9)}" if n % every == every - 1 else w for n, w in enumerate(words)]


@pytest.mark.parametrize("every, least", [(20, 0.99), (15, 0.98), (10, 0.95), (8, 0.9)])
def test_edited_passages_are_found(spark, every, least):
    r, rows, n = random.Random(every), [], 300
    for k in range(n):
        run = fresh(r, 64)
        rows += [(k, fresh(r, 100) + run + fresh(r, 100)), (1000 + k, fresh(r, 50) + edited(r, run, every) + fresh(r, 70))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], SCHEMA)
    found = {(x.doc_id, x.other_id) for x in P.repeated_passages(docs).collect()}
    assert found <= {(1000 + k, k) for k in range(n)} and len(found) >= least * n


def test_a_passage_in_very_many_texts_is_found_in_each(spark):
    r = random.Random(9)
    run = fresh(r, 70)
    rows = [(k, fresh(r, 20) + (run if k % 3 else edited(r, run, 12)) + fresh(r, 20)) for k in range(1500)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], SCHEMA)
    found = P.repeated_passages(docs).collect()
    holding = {x.doc_id for x in found} | {x.other_id for x in found}
    assert len(holding) >= 0.99 * 1500 and len(found) <= 12 * 1500


def test_rows_do_not_depend_on_the_partitions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = sorted(map(tuple, P.repeated_passages(docs).collect()))
    assert want
    for n in (1, 8, 64):
        assert sorted(map(tuple, P.repeated_passages(docs.repartition(n)).collect())) == want


def test_recall_against_all_pairs(spark, small):
    """Every pair of different texts aligned in full; of the texts with a passage, 0.9 are found, and nothing else is."""
    first = {}
    for r in sorted(documents(spark, small)):
        words = tuple(P.words_of(r.text))
        if len(words) >= 50:
            first.setdefault(words, r.doc_id)
    texts = [(i, list(w), P.hash_words(list(w))) for w, i in first.items()]
    want = set()
    for n, (i, a, x) in enumerate(texts):
        for j, b, y in texts[:n]:
            if P.passages(a, b, x, y, 50, 0.8) or P.passages(b, a, y, x, 50, 0.8):
                want |= {i, j}
    reps = {i for i, _, _ in texts}
    rows = P.repeated_passages(spark.read.parquet(f"{small}/documents.parquet")).collect()
    got = {i for r in rows if {r.doc_id, r.other_id} <= reps for i in (r.doc_id, r.other_id)}  # the others are exact copies
    assert got <= want and len(got & want) >= 0.9 * len(want) > 0


def test_gaps_are_aligned_at_every_size():
    r = random.Random(3)
    code = lambda words: [x.encode() for x in words]
    for n in (60, 66, 120):  # gaps that 40 words on one side pay for
        gap = fresh(r, n)
        other = [w if k % 4 else f"e{k}" for k, w in enumerate(gap)]
        head, tail = fresh(r, 40), fresh(r, 40)
        a, b = code(head + gap + tail), code(head + other[:30] + ["one", "more"] + other[30:] + tail)
        found = P.passages(a, b, P.hash_words(a), P.hash_words(b), 50, 0.7)
        assert found == [(0, len(a), 0, len(b), 80 + sum(k % 4 != 0 for k in range(n)))]


def test_common_subsequence_equals_the_table():
    r = random.Random(8)
    for _ in range(200):
        a, b = ([bytes([r.randrange(97, 102)]) for _ in range(r.randrange(0, 40))] for _ in range(2))
        row = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                row[i + 1][j + 1] = row[i][j] + 1 if x == y else max(row[i][j + 1], row[i + 1][j])
        assert P._common(a, b) == row[-1][-1]


def test_repeated_lines_meet_in_few_anchors():
    line = [f"l{k}".encode() for k in range(7)]
    a, b = line * 300, line * 200
    points, runs = P.anchors(P.hash_words(a), P.hash_words(b))
    assert len(points) <= 500 and dict(zip(points, runs))[0, 0] == 1396
    assert P.passages(a, b, P.hash_words(a), P.hash_words(b), 50, 0.8)[0][4] == 1400


def test_every_two_classes_of_a_seed_are_linked():
    import numpy as np

    r = random.Random(4)
    group = np.repeat(np.arange(60), [r.randrange(1, 40) for _ in range(60)])
    doc = np.array([r.randrange(10**6) for _ in group])
    want = sorted((max(x, y), min(x, y)) for n, x in enumerate(doc.tolist()) for m, y in enumerate(doc[:n].tolist()) if group[n] == group[m] and x != y)
    for most in (1, 7, 10**6):
        assert sorted((int(doc[i]), int(doc[j])) for a, b in P._all_pairs(group, doc, most) for i, j in zip(a, b)) == want


def test_a_pair_behind_many_classes_of_its_seeds_is_found(spark):
    """Passages that share two seeds alone, which smaller ids and neighbours in their order hold too."""
    r = random.Random(12)
    words = fresh(r, 60)
    rows = [(k, fresh(r, 20) + edited(random.Random(k), words, 9) + fresh(r, 20)) for k in range(40)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], SCHEMA)
    few, all_ = ({(x.doc_id, x.other_id) for x in P.repeated_passages(docs, every=e).collect()} for e in (False, True))
    assert few < all_ and len(all_) >= 0.9 * 40 * 39 / 2
