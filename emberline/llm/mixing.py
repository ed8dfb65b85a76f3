"""Operator 9: mixing sources to target weights, in DataFrame operations only.

Each source's documents stand one after another in a pseudorandom order and are cut into blocks of a fixed number
of words.  The mix is a number of slots, dealt into output shards.  In every shard each source gets the whole part
of its expected slots, and the rest of the shard is a multinomial draw over what is left of the expectations, so
the counts are random but close.  A source's slots are numbered over the shards; slot j reads, in epoch j div n,
the block that a pseudorandom permutation of that source and epoch gives for j mod n.  No permutation is stored:
it is a swap-or-not network over [0, n), a few hashes a slot.  An epoch holds each block once and there are at
most three, so nothing is taken more than three times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table

MOST, ROUNDS = 3, 6
SIZE = r"regexp_count(text, '[^\\x20\\x09-\\x0D]+')"


def hashed(*parts: Column | str) -> Column:
    """52 bits of the md5 of the parts, joined by colons: the same on every engine."""
    text = F.concat_ws(":", *(p if isinstance(p, str) else p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def permuted(number: Column, epoch: Column, x: Column, n: Column) -> Column:
    """Place of ``x`` in the permutation of [0, n) that belongs to a source's number and an epoch."""

    def turn(at: Column, r: Column) -> Column:
        key = F.pmod(hashed(F.lit("key"), number, epoch, r), n)
        other = F.pmod(key + n - at, n)
        return F.when(hashed(F.lit("swap"), number, epoch, r, F.greatest(at, other)) % 2 == 1, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), x, turn)


def row_key() -> Column:
    """32 hexadecimal digits that a row's id, text and source have in common with no other row but its repeats."""
    parts = [F.coalesce(F.md5(F.col(c).cast("string").cast("binary")), F.lit("null")) for c in ("doc_id", "text", "source")]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, s, sn (source and whether it is null), size, h (order within the source), row_key, bucket, written once.

    The order hashes the text too, so rows without an id, or of one id, are dealt over all buckets.
    """
    h = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))).cast("binary"))
    out = docs.select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("s"), F.col("source").isNull().alias("sn"),
        F.coalesce(F.expr(SIZE), F.lit(0)).cast("long").alias("size"), h.alias("h"), row_key().alias("row_key"),
    )
    return saved(out.withColumn("bucket", F.conv(F.substring("h", 1, 3), 16, 10).cast("int")), "sized-documents")


def source_targets(buckets: DataFrame, block: int) -> DataFrame:
    """A row a source: s, sn, number (code point order, null last), source_size, weight, target, n_blocks, slots (expected).

    Targets share all words by weight, at most MOST times a source's size; what is over is shared anew until none
    is above.  Sources whose size is least for their weight stop first, so with the sources in that order the
    common level is the greatest of (what is left after the caps before) / (weights from here on).
    """
    sources = buckets.groupBy("s", "sn").agg(F.sum("bucket_size").alias("source_size"))
    # one row a source from here on, never one a document
    numbered = sources.withColumn("number", F.row_number().over(Window.orderBy("sn", "s")) - 1).withColumn("weight", F.col("number") % 3 + 1)
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "number")
    before, onward, every = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    total = F.sum("source_size").over(every)
    level = (total - MOST * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(onward)
    capped = numbered.withColumn("level", level).withColumn("target", F.least((MOST * F.col("source_size")).cast("double"), F.max("level").over(every) * F.col("weight")))
    out = capped.withColumn("n_blocks", F.ceil(F.col("source_size") / block).cast("long"))
    return out.withColumn("slots", F.when(F.col("source_size") > 0, F.col("target") * F.col("n_blocks") / F.col("source_size")).otherwise(0.0)).drop("level")


def shard_draws(sources: DataFrame, shard_slots: int, run: int = 1024) -> DataFrame:
    """A row a source and output shard: number, n_blocks, shard, first (slot of the source), n (slots drawn).

    Shards are dealt in runs of ``run``: no task holds more than a run of shards, however many there are, and a source's
    first slot of a run comes from a running sum over runs.
    """
    every, parts = Window.partitionBy(), int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    all_ = sources.withColumn("sum", F.sum("slots").over(every)).withColumn("n_slots", F.round("sum").cast("long")).filter("n_slots > 0")
    runs = all_.withColumn("n_shards", F.ceil(F.col("n_slots") / shard_slots)).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_shards - 1) div {run}")))).repartition(parts, "run")
    shards = runs.withColumn("shard", F.explode(F.sequence(F.col("run") * run, F.least(F.col("n_shards"), (F.col("run") + 1) * run) - 1)))
    size = F.expr("(n_slots * (shard + 1)) div n_shards - (n_slots * shard) div n_shards")
    part = shards.withColumn("size", size).withColumn("x", F.col("slots") / F.col("sum") * F.col("size")).withColumn("whole", F.floor("x"))
    own = Window.partitionBy("run", "shard")
    part = part.withColumn("left", F.col("size") - F.sum("whole").over(own)).withColumn("low", F.coalesce(F.sum(F.col("x") - F.col("whole")).over(own.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    part = part.withColumn("high", F.coalesce(F.lead("low").over(own.orderBy("number")), F.lit(1e18)))
    point = lambda r: hashed(F.lit("draw"), F.col("shard"), r) / F.lit(2.0**52) * F.col("left")
    hits = F.filter(F.when(F.col("left") > 0, F.sequence(F.lit(1).cast("long"), F.col("left"))).otherwise(F.array().cast("array<bigint>")), lambda r: (point(r) >= F.col("low")) & (point(r) < F.col("high")))
    drawn = saved(part.select("number", "n_blocks", "run", "shard", (F.col("whole") + F.size(hits)).alias("n")), "draws")
    before = lambda by, at: F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = drawn.groupBy("number", "run").agg(F.sum("n").alias("n")).select("number", "run", before(["number"], "run").alias("base"))
    placed = drawn.withColumn("within", before(["number", "run"], "shard")).join(bases, ["number", "run"])
    return placed.select("number", "n_blocks", "shard", (F.col("base") + F.col("within")).alias("first"), "n")


def mixture_slots(draws: DataFrame) -> DataFrame:
    """A row a slot of the mix: shard, number (of the source), slot (of the source), block.  Slots beyond MOST epochs are left out.

    The draws are few rows that grow into many slots, so they are dealt over all tasks first, by a fixed number that
    adaptive execution does not shrink to the size of the draws.
    """
    draws = draws.repartition(int(draws.sparkSession.conf.get("spark.sql.shuffle.partitions")), "number", "shard")
    last = F.least(F.col("first") + F.col("n"), MOST * F.col("n_blocks")) - 1
    slots = draws.filter(last >= F.col("first")).withColumn("slot", F.explode(F.sequence("first", last)))
    return slots.withColumn("block", permuted(F.col("number"), F.expr("slot div n_blocks"), F.col("slot") % F.col("n_blocks"), F.col("n_blocks"))).select("shard", "number", "slot", "block")


def mix(docs: DataFrame, block: int = 128, shard_slots: int = 4096, keyed: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``: how many words of it the mix takes.

    Sources weigh 1, 2, 3 and so on again, by code point, null last.  Null and empty texts have size 0 and nothing
    is taken of them; a null source is a source; rows without an id or with the same id each have their own words.
    Only doc_id, source and text are read.  An empty table gives an empty result.  ``block`` is the words of a
    block (a source's last one may be shorter), ``shard_slots`` the blocks of an output shard.  With ``keyed``, the row's
    ``row_key`` follows.
    """
    rows = sized(docs)
    key = ["s", "sn", "bucket"]
    buckets = rows.groupBy(*key).agg(F.sum("size").alias("bucket_size"))
    sources = saved(source_targets(buckets, block), "sources")
    counts = mixture_slots(shard_draws(sources, shard_slots)).groupBy("number", "block").agg(F.count("*").alias("copies"))
    base = F.coalesce(F.sum("bucket_size").over(Window.partitionBy("s", "sn").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = buckets.withColumn("base", base).join(sources, ["s", "sn"]).select(*key, "base", "number", "source_size", "target")
    # a bucket is one of 4096 parts of a source, so a source of any size is dealt over many tasks
    running = F.coalesce(F.sum("size").over(Window.partitionBy(*key).orderBy("h", "doc_id", "size", "row_key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = rows.join(placed, key).withColumn("start", F.col("base") + running).select("doc_id", "size", "source_size", "target", "row_key", "number", "start")
    end = F.col("start") + F.col("size")
    pieces = at.filter("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
    words = F.least(end, (F.col("block") + 1) * block) - F.greatest("start", F.col("block") * block)
    taken = pieces.withColumn("words", words).join(counts.hint("merge"), ["number", "block"], "left").groupBy("doc_id", "size", "source_size", "target", "row_key", "number", "start").agg(F.sum(F.col("words") * F.coalesce("copies", F.lit(0))).cast("long").alias("taken"))
    columns = ["doc_id", "size", "source_size", "target"]
    more = ["row_key"] if keyed else []
    return taken.select(*columns, "taken", *more).union(at.filter("size = 0").select(*columns, F.lit(0).cast("long"), *more))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


ORACLE = r"""
with sized as (
  select doc_id, coalesce(source, '') as s, source is null as sn, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
    md5(concat_ws(':', coalesce(cast(doc_id as varchar), 'null'), md5(coalesce(text, '')))) as h from documents),
sizes as (select s, sn, cast(sum(size) as bigint) as source_size from sized group by s, sn),
numbered as (select *, row_number() over (order by sn, s) - 1 as number from sizes),
weighted as (select *, number % 3 + 1 as weight from numbered),
levels as (select *, (sum(source_size) over () - 3 * coalesce(sum(source_size) over (o rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(weight) over (o rows between current row and unbounded following))::double as level
  from weighted window o as (order by source_size::double / weight, number)),
targets as (select *, least(3e0 * source_size, (max(level) over ()) * weight) as target, cast(ceil(source_size / 128e0) as bigint) as n_blocks from levels),
sources as (select *, case when source_size > 0 then target * n_blocks / source_size else 0e0 end as slots from targets),
totals as (select *, sum(slots) over (order by number rows between unbounded preceding and unbounded following) as total from sources),
shaped as (select *, cast(round(total) as bigint) as n_slots from totals),
dealt as (select *, unnest(range(cast(ceil(n_slots / 4096e0) as bigint))) as shard, cast(ceil(n_slots / 4096e0) as bigint) as n_shards from shaped where n_slots > 0),
parts as (select *, (n_slots * (shard + 1)) // n_shards - (n_slots * shard) // n_shards as shard_size from dealt),
expected as (select *, slots / total * shard_size as x, floor(slots / total * shard_size) as whole from parts),
lefts as (select *, shard_size - sum(whole) over (partition by shard) as rest,
    coalesce(sum(x - whole) over (partition by shard order by number rows between unbounded preceding and 1 preceding), 0e0) as low from expected),
bounds as (select *, coalesce(lead(low) over (partition by shard order by number), 1e18) as high from lefts),
drawn as (select number, n_blocks, shard, cast(whole as bigint) + len(list_filter(range(1, cast(rest as bigint) + 1), lambda r:
    ('0x' || substr(md5(concat_ws(':', 'draw', shard, r)), 1, 13))::bigint / 4503599627370496e0 * rest >= low
    and ('0x' || substr(md5(concat_ws(':', 'draw', shard, r)), 1, 13))::bigint / 4503599627370496e0 * rest < high)) as n from bounds),
firsts as (select *, coalesce(sum(n) over (partition by number order by shard rows between unbounded preceding and 1 preceding), 0)::bigint as first_slot from drawn),
slotted as (select number, n_blocks, unnest(range(first_slot, least(first_slot + n, 3 * n_blocks))) as slot from firsts),
blocks as (select number, list_reduce(range(0, 6), lambda x, r:
    case when ('0x' || substr(md5(concat_ws(':', 'swap', number, slot // n_blocks, r,
        greatest(x, (('0x' || substr(md5(concat_ws(':', 'key', number, slot // n_blocks, r)), 1, 13))::bigint % n_blocks + n_blocks - x) % n_blocks))), 1, 13))::bigint % 2 = 1
      then (('0x' || substr(md5(concat_ws(':', 'key', number, slot // n_blocks, r)), 1, 13))::bigint % n_blocks + n_blocks - x) % n_blocks
      else x end, slot % n_blocks) as block from slotted),
copies as (select number, block, count(*) as copies from blocks group by all),
placed as (select doc_id, size, source_size, target, number,
    coalesce(sum(size) over (partition by number order by h, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from sized join sources using (s, sn)),
pieces as (select *, unnest(range(start // 128, (start + size - 1) // 128 + 1)) as block from placed where size > 0)
select doc_id, size, source_size, target, cast(sum((least(start + size, (block + 1) * 128) - greatest(start, block * 128)) * coalesce(copies, 0)) as bigint) as taken
  from pieces left join copies using (number, block) group by doc_id, size, source_size, target, number, start
union all select doc_id, size, source_size, target, 0 from placed where size = 0
"""
