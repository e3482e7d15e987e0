"""Mix sources to target weights, with DataFrame functions only.

Every source's words, in a pseudorandom order of its documents, are packed into
blocks of fixed length. Output shards have a fixed number of slots; each slot
draws a source, and a source's draws walk through a pseudorandom permutation of
its blocks, pass after pass. The draws of all slots are one multinomial draw given
its totals (slots are a permutation of all draws cut into shards), so every
shard's source counts vary as they should while every source meets its target.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.stored import stored, work_folder
from hirelake.operators.stages import evaluated_once

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixPlan:
    """`share` of all words is taken; `most` bounds how often a source repeats."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most: int = 2
    block: int = 512
    shard_slots: int = 256
    rounds: int = 16
    seed: int = 7


def permuted(x: Column, n: Column, rounds: int, *key: Column, inverse: bool = False) -> Column:
    """A pseudorandom permutation of 0..n-1 at x: the swap-or-not shuffle.

    Round r pairs x with (k_r - x) mod n and swaps the two or not by a bit of the
    pair; each round is its own inverse, so the reverse order undoes it. It holds
    for any n without tables or retries.
    """
    order = list(range(rounds))[:: -1 if inverse else 1]

    def step(at: Column, r: Column) -> Column:
        k = F.pmod(F.xxhash64(r, *key), n)
        mate = F.pmod(k - at, n)
        bit = F.pmod(F.xxhash64(r, F.greatest(at, mate), *key, F.lit("swap")), F.lit(2))
        return F.when(bit == 1, mate).otherwise(at)

    return F.aggregate(F.array(*[F.lit(r) for r in order]), x.cast("long"), step)


def targets(sources: DataFrame, plan: MixPlan) -> DataFrame:
    """(key, source, source_size, weight, rank) plus target: weights by code point order, nulls last.

    A source's target stops at `most` times its size and the excess goes to the
    others by weight. Ordered by size per weight, those stopped come first, so
    one running sum finds the level at which the rest share.
    """
    size, w = F.col("source_size"), F.col("weight")
    every = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(every) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(x) for x in plan.weights]), (F.pmod("rank", F.lit(len(plan.weights))) + 1).cast("int")))
    by_ratio = Window.orderBy(plan.most * size / w, "rank")
    before, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum(size).over(whole) * plan.share - F.coalesce(F.sum(plan.most * size).over(before), F.lit(0))
    level = left / (F.sum(w).over(whole) - F.coalesce(F.sum(w).over(before), F.lit(0)))
    found = ranked.withColumn("level", level).withColumn("open", F.when(plan.most * size / w >= F.col("level"), F.col("level")))
    found = found.withColumn("level", F.coalesce(F.first("open", True).over(whole), F.lit(float("inf"))))
    return found.select("key", "source", "source_size", "weight", "rank", F.least((plan.most * size).cast("double"), F.col("level") * w).alias("target"))


def draws(sources: DataFrame, plan: MixPlan) -> DataFrame:
    """Add, per source: blocks, passes, and the last pass's number of blocks and its last one's words.

    The last pass stops within one word of the target: the short tail block's
    place in the permutation is known from its inverse.
    """
    size, b = F.col("source_size"), F.lit(plan.block)
    out = sources.withColumn("blocks", F.ceil(size / b).cast("long"))
    n = F.greatest(F.col("blocks"), F.lit(1))
    want = F.least(F.round("target").cast("long"), plan.most * size)
    out = out.withColumn("passes", F.when(size > 0, F.floor(want / size)).otherwise(0).cast("long"))
    out = out.withColumn("rest", want - F.col("passes") * size)
    out = out.withColumn("tail", permuted(n - 1, n, plan.rounds, F.lit(plan.seed), F.col("rank"), F.col("passes"), inverse=True))
    lacks = n * b - size
    words = lambda q: q * b - F.when(F.col("tail") < q, lacks).otherwise(0)
    q0 = F.ceil(F.col("rest") / b).cast("long")
    out = out.withColumn("q", q0 + F.when((F.col("rest") > 0) & (words(q0) < F.col("rest")), 1).otherwise(0))
    out = out.withColumn("last_words", F.col("rest") - words(F.col("q") - 1))
    out = out.withColumn("n_draws", F.col("passes") * F.col("blocks") + F.col("q"))
    running = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return out.withColumn("base", F.coalesce(F.sum("n_draws").over(running), F.lit(0))).withColumn("all_draws", F.sum("n_draws").over(all_rows))


def slots(sources: DataFrame, plan: MixPlan, chunk: int = 4096) -> DataFrame:
    """(shard, slot, rank, pass, block, words): the block, or first words of it, that fills each slot."""
    parts = sources.where("n_draws > 0").select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_draws") - 1) / chunk))).alias("part"))
    # A fixed number of partitions: adaptive execution would put these few rows, which become many, in one task.
    parts = parts.repartition(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rank", "part")
    top = F.least((F.col("part") + 1) * chunk, F.col("n_draws")) - 1
    each = parts.select("*", F.explode(F.sequence(F.col("part") * chunk, top)).alias("draw"))
    each = each.withColumn("pass", F.floor(F.col("draw") / F.col("blocks"))).withColumn("turn", F.pmod("draw", F.col("blocks")))
    place = permuted(F.col("base") + F.col("draw"), F.col("all_draws"), plan.rounds, F.lit(plan.seed), F.lit("slots"))
    block = permuted(F.col("turn"), F.col("blocks"), plan.rounds, F.lit(plan.seed), F.col("rank"), F.col("pass"))
    each = each.select("*", place.alias("place"), block.alias("block"))
    length = F.least(F.lit(plan.block).cast("long"), F.col("source_size") - F.col("block") * plan.block)
    cut = (F.col("pass") == F.col("passes")) & (F.col("turn") == F.col("q") - 1)
    return each.select(
        F.floor(F.col("place") / plan.shard_slots).alias("shard"), F.pmod("place", F.lit(plan.shard_slots)).alias("slot"), "rank", "pass", "block",
        F.when(cut, F.least(length, F.col("last_words"))).otherwise(length).alias("words"),
    )


def shard_counts(slot_rows: DataFrame) -> DataFrame:
    """How many slots of each shard every source drew."""
    return slot_rows.groupBy("shard", "rank").agg(F.count("*").alias("n_slots"))


def _with_source(rows: DataFrame, sources: DataFrame, *columns: str, salts: int = 64) -> DataFrame:
    """Rows with their source's columns; the key is salted, as one source may hold a third of all rows."""
    right = sources.select("key", *columns, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    return rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int")).join(right, ["key", "salt"]).drop("salt")


def mix(docs: DataFrame, plan: MixPlan = MixPlan(), keep_text: bool = False) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows, sources, slots, pieces) of the mix.

    rows: every input row with `row` (its id here), key, size. pieces: (row, size, shard, pass,
    from, to) the ranges of its words that slots of an output shard take, one with nulls for a row that
    has none. Null texts have no words; a null source is a source of its own;
    rows that repeat an id are rows of their own.
    """
    folder = work_folder(docs.sparkSession)
    text = F.col("text").cast("string")
    key = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    order = F.xxhash64(F.lit(plan.seed), "doc_id", text)
    rows = docs.select(
        "doc_id", "source", *([F.struct(*docs.columns).alias("given")] if keep_text else []),
        F.monotonically_increasing_id().alias("row"), key.alias("key"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        order.alias("order"), F.shiftrightunsigned(order, 52).cast("int").alias("bin"),
    )
    # Stored, so that row ids are the same wherever they are read.
    rows = stored(rows, folder, "rows")
    light = rows.select("row", "doc_id", "key", "size", "order", "bin")
    totals = rows.groupBy("key", "bin").agg(F.sum("size").alias("bin_size"), F.first("source").alias("source"))
    totals = stored(totals, folder, "bins")
    sources = totals.groupBy("key").agg(F.sum("bin_size").alias("source_size"), F.first("source").alias("source"))
    sources = stored(draws(targets(sources, plan), plan), folder, "sources")
    ahead = Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = totals.select("key", "bin", F.coalesce(F.sum("bin_size").over(ahead), F.lit(0)).alias("bin_start"))
    # A source's order is cut into 4,096 bins by hash, so no task sorts a whole source.
    within = Window.partitionBy("key", "bin").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = light.withColumn("at", F.coalesce(F.sum("size").over(within), F.lit(0))).join(bins, ["key", "bin"])
    placed = placed.withColumn("start", F.col("at") + F.col("bin_start"))
    placed = _with_source(placed, sources, "rank")
    b = plan.block
    last = F.floor((F.col("start") + F.col("size") - 1) / b)
    cover = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / b), last))
    parts = placed.select("row", "rank", "start", "size", F.explode_outer(cover).alias("block"))
    taken = slots(sources, plan)
    low = F.greatest(F.col("start"), F.col("block") * b)
    high = F.least(F.col("start") + F.col("size"), F.col("block") * b + F.col("words"))
    # Spark takes the slots for as few as the sources they are made from: merged, not broadcast.
    # least() passes over nulls, so a block that no slot takes needs its own test.
    hit = F.col("words").isNotNull() & (high > low)
    pieces = parts.join(taken.hint("merge"), ["rank", "block"], "left").select(
        "row", "size", F.when(hit, F.col("shard")).alias("shard"), F.when(hit, F.col("pass")).alias("pass"), F.when(hit, low - F.col("start")).alias("from"), F.when(hit, high - F.col("start")).alias("to"),
    )
    return rows, sources, taken, pieces


def taken_words(docs: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards) per row: the words that the mix takes of it, repeats counted.

    shards: (shard, words) of the output shards that they go to, by shard; empty if none are taken.
    """
    rows, sources, _, pieces = mix(docs, plan)
    by_shard = pieces.groupBy("row", "shard").agg(F.sum(F.coalesce(F.col("to") - F.col("from"), F.lit(0))).alias("words"))
    taken = by_shard.groupBy("row").agg(
        F.sum("words").alias("taken"),
        F.array_sort(F.collect_list(F.when(F.col("shard").isNotNull(), F.struct("shard", "words")))).alias("shards"),
    )
    out = _with_source(rows.select("row", "doc_id", "key", "size").join(taken, "row"), sources, "source_size", "target")
    return out.select("doc_id", "size", "source_size", "target", "taken", "shards")


def mixed_documents(docs: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """The mix as documents: for each row and pass, a copy with the words taken (all columns of `docs`, n_chars brought up to date).

    A pass that takes a whole document keeps its text as it is; else the taken
    ranges keep the white space before each word, and a line break joins ranges
    that do not touch. Rows without words are never taken. Columns may have any other
    names, those of the operator's own columns too.
    """
    rows, _, _, pieces = mix(docs, plan, keep_text=True)
    ranges = pieces.where("pass is not null").groupBy("row", "pass").agg(
        F.array_sort(F.collect_list(F.struct("from", "to"))).alias("ranges"), F.sum(F.col("to") - F.col("from")).alias("n"), F.first("size").alias("of"),
    )
    partial = F.when(F.col("n") < F.col("of"), F.regexp_extract_all(F.col("given.text").cast("string"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)))
    # Fixed before the lambda below reads it, which would else evaluate it for each range.
    joined = evaluated_once(rows.join(ranges, "row").withColumn("mix_words", partial), "mix_words")
    words = F.col("mix_words")
    some = F.transform(F.col("ranges"), lambda r: F.struct(
        r["from"].alias("from"), r["to"].alias("to"), F.array_join(F.slice(words, (r["from"] + 1).cast("int"), (r["to"] - r["from"]).cast("int")), "").alias("text"),
    ))
    empty = F.struct(F.lit(-1).cast("long").alias("to"), F.lit("").alias("text"))
    glued = F.aggregate(some, empty, lambda acc, r: F.struct(
        r["to"].alias("to"), F.when(acc["to"] < 0, r["text"]).when(acc["to"] == r["from"], F.concat(acc["text"], r["text"])).otherwise(F.concat(acc["text"], F.lit("\n"), r["text"])).alias("text"),
    ), lambda acc: acc["text"])
    text = F.when(F.col("n") == F.col("of"), F.col("given.text").cast("string")).otherwise(F.regexp_replace(glued, r"^[\x20\x09-\x0D]+", ""))
    out = evaluated_once(joined.withColumn("mix_text", text).select("given", "mix_text"), "mix_text")
    fresh = {"text": F.col("mix_text")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.char_length("mix_text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[fresh.get(c, F.col("given")[c]).alias(c) for c in docs.columns])
