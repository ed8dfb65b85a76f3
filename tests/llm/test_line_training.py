import random

from emberline.llm import line_labels as L


def test_long_documents_are_trained_on_in_pieces():
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9)))
    line = lambda: " ".join(word() for _ in range(r.randint(8, 20))).capitalize() + "."
    short = ["\n".join(["Home | About | Login", *(line() for _ in range(9)), "(c) All rights reserved"]) for _ in range(30)]
    long = "\n".join(short * 40)
    alone = L.train([long])
    assert alone != L.train([]) and alone == L.train([long])
    whole = L.line_features(long)
    assert len(whole[0]) > 2000
    bounded = L.train([long] * 3, most_pieces=7)
    assert len(bounded.weights) == len(L.FEATURES)
    assert L.train(short) == L.train(short, longest=200)
