import random

from emberline.llm import passages as P


def test_two_passages_with_unrelated_text_between_are_both_found():
    r = random.Random(12)
    fresh = lambda n: [f"w{r.randrange(10**9)}".encode() for _ in range(n)]
    for first, between, second in ((60, 50, 60), (60, 100, 60), (100, 200, 100)):
        x, y = fresh(first), fresh(second)
        for a, b in ((x + fresh(between) + y, x + fresh(between) + y), (x + y, x + fresh(between) + y), (x + fresh(between) + y, x + y)):
            got = sorted(P.passages(a, b, P.hash_words(a), P.hash_words(b), 50, 0.8))
            assert got == [(0, first, 0, first, first), (len(a) - second, len(a), len(b) - second, len(b), second)]
