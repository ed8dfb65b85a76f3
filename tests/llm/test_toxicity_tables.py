"""Toxicity on the driver's own labels, and what the dictionaries are trained on."""

import random
import zlib

from emberline.llm import toxicity as T


def test_held_out_rows_of_a_whole_table(spark, small):
    sf = small.replace("sf0.001", "sf0.1")
    labels = {}
    for r in spark.read.parquet(f"{sf}/labels.parquet").filter("toxic is not null").collect():
        labels[r.doc_id] = max(r.toxic, labels.get(r.doc_id, 0))
    got = {r.doc_id: r for r in T.op3_toxicity(spark, sf).collect()}
    held = [i for i in labels if i in got and zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i in held)
    toxic, ordinary = ([got[i].predicted for i in held if labels[i] == k] for k in (1, 0))
    assert sum(toxic) >= 0.7 * len(toxic) > 0 and sum(ordinary) <= 0.01 * len(ordinary)


def test_forms_that_training_never_saw_are_found():
    """Toxic words here are a stem with an ending of their own: no word of a held-out text was seen in training."""
    r = random.Random(3)
    ends = ["".join(r.choice("aeiou") + r.choice("bdgklmnprst") for _ in range(3)) for _ in range(4000)]
    plain = ["".join(r.choice(["ba", "ke", "lo", "mi", "tu", "sa", "ri"]) for _ in range(r.randint(1, 4))) for _ in range(400)]

    def text(toxic, endings):
        words = [r.choice(plain) for _ in range(100)]
        for _ in range(4 if toxic else 0):
            words[r.randrange(100)] = r.choice(["zwurk", "fnaxo"]) + endings.pop()
        return " ".join(words)

    scorer = T.fit([text(True, ends) for _ in range(200)], [text(False, ends) for _ in range(800)]).scorer()
    assert sum(scorer.score(text(True, ends)) >= 0.5 for _ in range(100)) >= 95
    assert sum(scorer.score(text(False, ends)) >= 0.5 for _ in range(200)) <= 2


def test_long_texts_give_pieces_of_all_of_them():
    long = "".join(f"{k:08d}" for k in range(100_000))
    got = T._shares([long, "Short"], most=64_000)
    assert got[1] == b"short" and 25_000 <= len(got[0]) <= 32_000
    assert long[:4096].encode() in got[0] and long[-100:].encode() in got[0]


def test_one_class_alone_gives_one_score():
    assert T.fit([], ["a b c"]).scorer().score("a") < 1e-9
    assert 0 <= T.fit(["a b c"], []).scorer().score("a") <= 1
