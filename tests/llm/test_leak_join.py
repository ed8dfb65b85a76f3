import random

from pyspark.sql import functions as F

from emberline.llm import decontamination as D


def rows(n_items=3000, n_texts=400):
    r = random.Random(11)
    fresh = lambda n: [f"w{r.randrange(60_000)}" for _ in range(n)]
    items = [(f"i{k}", " ".join(fresh(r.choice([2, 9, 10, 12, 40])))) for k in range(n_items)]
    common = fresh(30)
    items += [("popular", " ".join(common)), (None, " ".join(common[5:25]))]
    texts = []
    for k in range(n_texts):
        text = fresh(r.randrange(0, 120))
        for _ in range(k % 3):
            text += r.choice(items[:n_items])[1].upper().split() + fresh(5)
        texts.append((k, " ".join(text + (common if k % 2 else []))))
    return items, texts + texts[:20] + [(None, None), (None, "")]


def test_join_equals_brute_force_whatever_the_salts_and_the_filter(spark, monkeypatch):
    items, texts = rows()
    bench = spark.createDataFrame(items, "item_id string, text string").repartition(5)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    want = sorted((i or -1, *w) for (i, _), w in zip(texts, D.brute_force([t for _, t in texts], [(i if i is not None else "\0", t) for i, t in items])))

    def got(**more):
        out = D.with_leaks(docs, bench, **more).select("doc_id", "leak.n_words", "leak.n_hit", F.col("leak.item_ids").alias("ids")).collect()
        return sorted((-1 if r.doc_id in (None, 0) and r.doc_id is None else r.doc_id or -1, r.n_words, r.n_hit, tuple(r.ids)) for r in out)

    first = got()
    # brute force lists the item without an id too; here it hits but is not listed
    assert [x[:3] for x in first] == [x[:3] for x in want] and sum("popular" in x[3] for x in first) >= 200
    monkeypatch.setattr(D, "TEXTS_A_SALT", 3)
    monkeypatch.setattr(D, "FILTER_BITS", 10)  # a filter that is nearly full lets almost all through
    assert got(most_bytes=0) == first


def test_filter_has_every_hash(spark):
    items = D.fingerprints(spark.createDataFrame([(f"i{k}", f"a{k} b{k} c{k}") for k in range(500)], "item_id string, text string"))
    bits = D.bloom(items)
    hashes = [h & (1 << 64) - 1 for r in items.collect() for h in r.hashes]
    assert all(int(bits[(h >> 64 - D.FILTER_BITS) >> 6]) >> ((h >> 64 - D.FILTER_BITS) & 63) & 1 for h in hashes) and int(sum(int(x).bit_count() for x in bits)) <= len(hashes)
