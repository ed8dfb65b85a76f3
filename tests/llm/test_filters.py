import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from emberline.llm import decontamination as D
from emberline.llm import line_labels as L
from emberline.llm import rule_quality as Q
from emberline.llm import site_lines as H
from emberline.llm import toxicity as T

from .helpers import ODD, empty, odd

LABELS = "doc_id long, quality int, toxic int"


def made(n, seed=1):
    """Texts of made-up words; toxic ones hold one of a few insults."""
    r = random.Random(seed)
    words = ["".join(r.choice(["ba", "ke", "lo", "mi", "tu", "sa", "ri"]) for _ in range(r.randint(1, 4))) for _ in range(400)]
    bad = ["scoundrel", "wretch", "vermin", "cretin"]
    out = []
    for k in range(n):
        text = [r.choice(words) for _ in range(r.randint(40, 120))]
        toxic = k % 4 == 0
        for _ in range(3 if toxic else 0):
            text.insert(r.randrange(len(text)), r.choice(bad))
        out.append((k, " ".join(text), int(toxic)))
    return out


def test_toxicity_on_held_out_rows(spark):
    rows = made(600)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, x) for i, _, x in rows], LABELS)
    model = T.fit_toxicity(docs, labels)
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    got = {r.doc_id: r.toxicity for r in T.score_toxicity(docs, model).collect()}
    wrong = sum((got[i] >= 0.5) != bool(x) for i, _, x in rows if i in held)
    assert wrong <= 0.03 * len(held)
    assert model == T.fit_toxicity(docs, labels)
    flipped = spark.createDataFrame([(i, 1, 1 - x if i in held else x) for i, _, x in rows], LABELS)
    assert model == T.fit_toxicity(docs, flipped), "held-out labels were read"


def test_toxicity_of_odd_rows_and_without_labels(spark):
    none = spark.createDataFrame([], LABELS)
    model = T.fit_toxicity(odd(spark), none)
    got = T.score_toxicity(odd(spark), model)
    assert got.columns == odd(spark).columns and got.count() == len(ODD)
    assert all(0 <= r.toxicity <= 1 for r in got.select("toxicity").collect())
    assert T.score_toxicity(empty(spark), model).count() == 0


def test_rules_find_what_sets_classes_apart():
    rng = np.random.default_rng(1)
    x = rng.random((2000, len(Q.NAMES)))
    y = ((x[:, 2] > 0.6) & (x[:, 5] <= 0.5) | (x[:, 8] > 0.9)).astype(float)
    model = Q.fit(x[:1500], y[:1500])
    assert ((model.score_rows(x[1500:]) >= 0.5) == y[1500:].astype(bool)).mean() > 0.95  # cuts lie on 32 quantiles
    assert 0 < len(model.rules) <= 48


def test_compiled_rules_equal_the_plain_ones(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    model = Q.fit_quality(docs, labels)
    rows = Q.statistics(docs).select("doc_id", "stats.*").collect()
    want = dict(zip((r.doc_id for r in rows), model.score_rows(np.array([r[1:] for r in rows]))))
    got = {r.doc_id: r.quality for r in Q.score_quality(docs, model).collect()}
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_quality_of_odd_rows(spark):
    model = Q.RuleModel(((frozenset({(0, True, 1.0)}), 2.0), (frozenset({(8, False, 0.5), (2, False, 0.1)}), -1.0)), 0.1)
    got = Q.score_quality(odd(spark), model)
    assert got.count() == len(ODD) and set(got.columns) == set(odd(spark).columns)
    assert all(0 <= r.quality <= 1 for r in got.select("quality").collect())
    assert Q.score_quality(empty(spark), Q.fit_quality(empty(spark), spark.createDataFrame([], LABELS))).count() == 0


def test_viterbi_equals_the_best_of_all_sequences():
    r = random.Random(3)
    for _ in range(30):
        field = L.LineField(tuple(r.uniform(-2, 2) for _ in L.FEATURES), ((r.uniform(-1, 1), r.uniform(-1, 1)), (r.uniform(-1, 1), r.uniform(-1, 1))))
        bits = [r.randrange(1 << len(L.FEATURES)) for _ in range(8)]
        emit = [sum(w for j, w in enumerate(field.weights) if b >> j & 1) for b in bits]
        score = lambda s: sum(e for e, y in zip(emit, s) if y) + sum(field.moves[a][b] for a, b in zip(s, s[1:]))  # noqa: E731, B023
        best = max(([k >> j & 1 for j in range(8)] for k in range(256)), key=score)
        assert abs(score(field.decode(bits, {})) - score(best)) < 1e-9


def test_base_counts_by_hand():
    text = "a b c\na b c\n## x | y\n\n a b c d"
    words = text.split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    assert L.base_counts(text) == (len(words), sum(map(len, words)), 3, 1, len(hit))
    assert L.base_counts("") == (0, 0, 0, 0, 0) and L.base_counts("é\x1c ü") == (2, 3, 0, 0, 0)


def test_trained_field_parts_prose_from_junk(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    field = L.fit_lines(docs)
    prose = "\n".join("This line tells of one thing and another, in plain words that go on for a while and then it ends." for _ in range(3)).replace("another", "{}")
    prose = prose.format("a cat", "a dog", "a cow")
    junk = "\n".join("Home | About | Contact | Login | More" for _ in range(6))
    share = lambda t: (lambda b, n, _: sum(s for s, y in zip(n, field.decode(b, {})) if y) / sum(n))(*L.line_features(t))
    assert share(prose) > 0.9 and share(junk) < 0.1


def test_line_labels_of_odd_rows(spark):
    field = L.fit_lines(empty(spark))
    got = L.label_lines(odd(spark), field).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert by[3].n_words == 0 and by[3].base_failed and not by[3].kept and by[3].labels == []
    assert by[8].base_failed and by[8].n_words == 60_000 == by[8].n_repeat_words
    assert L.label_lines(empty(spark), field).count() == 0


def test_leaks_equal_brute_force(spark, small):
    docs, bench = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{small}/benchmark.parquet")
    more = spark.createDataFrame([("s1", "the OF"), ("s2", "nowhere-to"), ("s3", None), ("s4", "..."), ("s1", "the of"), ("s5", "th th th")], "item_id string, text string")
    bench = bench.select(F.col("item_id").cast("string").alias("item_id"), "text").union(more)
    rows = docs.union(odd(spark).select("doc_id", "text")).collect()
    want = D.brute_force([r.text for r in rows], [(r.item_id, r.text) for r in bench.collect()])
    got = D.with_leaks(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), bench, step=5000).select(
        "leak.n_words", "leak.n_hit", F.size("leak.item_ids"), F.sha2(F.array_join("leak.item_ids", ","), 256)
    ).collect()
    assert [tuple(r) for r in got] == want and sum(r[1] > 0 for r in want) > 10


def test_leaks_over_many_blocks_and_repeats():
    r = random.Random(6)
    word = lambda: r.choice("abcd")
    items = [(f"i{k}", " ".join(word() for _ in range(r.choice([1, 3, 9, 10, 11, 25])))) for k in range(40)]
    texts = [" ".join(word() for _ in range(r.choice([0, 5, 12, 80]))) for _ in range(40)]
    words = [D.words_of(t) for t in texts]
    flat = [w for t in words for w in t]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in words])])
    hit, found = np.zeros(len(flat), bool), {}
    for k in range(0, 40, 7):
        D.Block(items[k : k + 7]).match(flat, D.hash_words(flat), bounds, hit, found)
    got = [(len(t), int(hit[bounds[d] : bounds[d + 1]].sum()), len(found.get(d, ()))) for d, t in enumerate(words)]
    assert got == [x[:3] for x in D.brute_force(texts, items)]


def test_winnowing_keeps_a_gram_of_every_window():
    r = np.random.default_rng(2)
    h = r.integers(0, 9, 200).astype(np.uint64)
    kept = set(D.winnow(h, 6).tolist())
    assert all(kept & {i for i in range(s, s + 6) if h[i] == h[s : s + 6].min()} for s in range(195))


def test_leaks_with_empty_tables(spark):
    none = spark.createDataFrame([], "item_id string, text string")
    assert D.with_leaks(odd(spark), none).filter("leak.n_hit > 0").count() == 0
    assert D.with_leaks(empty(spark), none).count() == 0


def test_site_lines_by_hand(spark):
    page = lambda *lines: "".join(f"<p>{x}</p>" for x in lines)
    rows = [(1, "http://A.org/x", page("menu", "one", "menu")), (2, "https://u@a.org:80/y?q", page("menu", "two &amp; three")), (3, "http://a.org", page("menu", "three")), (4, "http://a.org/z", page("four")), (5, "http://b.org/", page("menu")), (6, None, None), (6, "", ""), (7, "http://a.org/q", "<script>var t='</p>x';</script> <b>in</b>line<!-- no --><br>end")]
    got = {(r.page_id, r.host): (r.n_lines, r.n_dropped, r.text) for r in H.drop_site_lines(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lines", F.lit(1)).withColumn("salt", F.lit(1)), 0.5).collect()}
    assert got[1, "a.org"] == (3, 2, "one") and got[2, "a.org"] == (2, 1, "two & three") and got[4, "a.org"] == (1, 0, "four")
    assert got[5, "b.org"] == (1, 0, "menu") and got[6, ""] == (0, 0, "") and got[7, "a.org"] == (2, 0, "inline\nend")
    assert H.drop_site_lines(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
