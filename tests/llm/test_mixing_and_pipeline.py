import zlib

import duckdb
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from emberline.llm import decontamination as D
from emberline.llm import mixing as M
from emberline.llm import toxicity as T

from .helpers import ODD, SCHEMA, empty, odd
from .test_shingles import plain as all_pairs


def targets(sizes):
    """Water-filling step by step, for comparison: sizes in source order."""
    weights = [k % 3 + 1 for k in range(len(sizes))]
    capped, total = set(), sum(sizes)
    while True:
        free = [k for k in range(len(sizes)) if k not in capped]
        left = total - sum(3 * sizes[k] for k in capped)
        share = {k: left * weights[k] / sum(weights[j] for j in free) for k in free}
        over = [k for k in free if share[k] > 3 * sizes[k]]
        if not over:
            return [3.0 * sizes[k] if k in capped else share[k] for k in range(len(sizes))]
        capped |= set(over)


def test_targets_and_taken(spark, small):
    for docs in (spark.read.parquet(f"{small}/documents.parquet"), odd(spark)):
        rows = M.mix(docs, block=32).collect()
        by = {}
        for r in rows:
            by.setdefault((r.source_size, r.target), []).append(r)
            assert 0 <= r.taken <= 3 * r.size
        sources = docs.select("source", F.coalesce(F.expr(M.SIZE), F.lit(0)).alias("n")).groupBy("source").agg(F.sum("n").alias("n")).collect()
        sources.sort(key=lambda r: (r.source is None, r.source or ""))
        want = targets([r.n for r in sources])
        assert sorted(zip((r.n for r in sources), np.round(want, 6))) == sorted({(r.source_size, round(r.target, 6)) for r in rows} if len(by) == len(sources) else [(r.n, round(t, 6)) for r, t in zip(sources, want)])
        assert abs(sum(want) - sum(r.n for r in sources)) < 1e-6
        for (size, target), part in by.items():
            copies = sum(r.n == size for r in sources)
            assert abs(sum(r.taken for r in part) - copies * target) <= copies * (4 * 32 + 0.05 * target)
        assert len(rows) == docs.count()


def test_reruns_agree_whatever_the_partitions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert sorted(M.mix(docs).collect()) == sorted(M.mix(docs.repartition(7)).collect())


def test_permutations_are_permutations(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select(M.permuted(F.lit(3), F.lit(1), F.col("id"), F.lit(n).cast("long")).alias("x"))
        assert sorted(r.x for r in df.collect()) == list(range(n))


def test_mix_sql_agrees(spark, small):
    from emberline.llm.queries import ORACLE_SQL

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{small}/documents.parquet'")
    want = con.sql(ORACLE_SQL["op9_mixing"]).fetchall()
    got = M.op9_mixing(spark, small).select("doc_id", "size", "source_size", "target", "taken").collect()
    key = lambda r: (r[0], r[1], r[2], round(r[3], 6), r[4])
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_mix_of_empty_tables(spark):
    assert M.mix(empty(spark)).count() == 0
    assert M.mix(spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "a", 0)], empty(spark).schema)).filter("taken = 0 and target = 0").count() == 2


def test_pipeline_equals_plain_steps(spark, small):
    """Each stage by plain Python on the stage's own input; the mix by its own table."""
    docs, labels, bench = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    scorer = T.fit_toxicity(docs, labels).scorer()
    rows = [r for r in docs.collect() if scorer.score(r.text or "") < 0.5]
    groups = all_pairs([(r.doc_id, r.text) for r in rows])  # five-word shingles, 0.8
    rows = [r for r in rows if groups[r.doc_id] == r.doc_id]
    hits = D.brute_force([r.text for r in rows], [(str(r.item_id), r.text) for r in bench.collect()])
    rows = [r for r, h in zip(rows, hits) if h[1] == 0]
    assert 0 < len(rows) < docs.count()
    mixed = corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, docs.schema), small).orderBy("doc_id").collect()
    library, start, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for r in mixed:
        ids = library.encode(r.text, add_special_tokens=False).ids + [1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, small).collect()), key=lambda r: r[1]) == want


def test_stages_take_odd_rows(spark, small):
    docs = odd(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns, name
        assert stage(spark, empty(spark), small).count() == 0, name
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, small).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id in (1, 2, 9)) in ([1], [1, 9]) and len(kept) < len(ODD)
    assert corpus_pipeline.write_tokens(spark, docs, small).count() == len(ODD)


def test_rows_that_share_an_id_are_decided_by_their_own_text(spark, small):
    """Of (1, T), (5, U), (5, T) two rows stay; columns named like the stages' own pass through."""
    t, u = (" ".join(f"{x}{k}" for k in range(80)) for x in "tu")
    docs = spark.createDataFrame([(1, t, "en", "a", 1), (5, u, "en", "a", 1), (5, t, "en", "a", 1), (5, t, "en", "a", 2), (None, u, "en", "b", 1), (None, "no other", "en", "b", 1)], SCHEMA)
    names = ("row", "key", "root", "rows", "chosen_id", "row_key", "copies", "copy", "_rows", "_id", "_copies", "_copy", "leak", "toxicity", "a.b")
    docs = docs.select("*", *(F.lit(n).alias(n) for n in names))
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, small)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "no other"), (1, t), (5, u)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns, name
        assert all(r[n] == n for r in out.select(*names[:-1]).collect() for n in names[:-1]), name


def test_rows_without_an_id_are_mixed_each_by_itself(spark, small):
    docs = spark.createDataFrame([(None, f"text {k} " + "w " * k, "en", f"s{k % 3}", 1) for k in range(400)], SCHEMA)
    assert docs.select(M.row_key().alias("k")).distinct().count() == 400
    buckets = M.sized(docs).groupBy("bucket").count()
    assert buckets.count() > 300
    rows = M.mix(docs, block=16).collect()
    assert len(rows) == 400 and all(0 <= r.taken <= 3 * r.size for r in rows)


def test_runs_of_shards_give_the_same_slots(spark, small):
    rows = M.sized(spark.read.parquet(f"{small}/documents.parquet"))
    sources = M.saved(M.source_targets(rows.groupBy("s", "sn", "bucket").agg(F.sum("size").alias("bucket_size")), 16), "test-sources")
    draws = [sorted(map(tuple, M.shard_draws(sources, 64, run).collect())) for run in (1, 3, 1024)]
    assert draws[0] == draws[1] == draws[2] and len(draws[0]) > 100
