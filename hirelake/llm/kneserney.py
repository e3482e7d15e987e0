"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over characters (order 4, one model a language), so that four characters
fit in one long. Counts of trusted text are summed by n-gram and continuation
counts, discounts and back-off weights come from joins sharded by n-gram. Texts are
packed in blocks of a few megabytes; a block's distinct n-grams are joined with their
probabilities and sent back to the block, which scores its documents. Blocks of one
language that a task packs one after the other are a unit and share their n-grams; they are
stored in buckets of their unit, so that the texts are never shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.stored import stored, work_folder
from hirelake.llm.wordhash import text_slices

ORDER = 4
POOLED = "*"


@dataclass(frozen=True)
class QualityPlan:
    """A document stays if its perplexity is at most the `quantile` of its language's held-out trusted documents, times `room`.

    One trusted text in `held_out`, by hash, is kept from the model and sets the limits. A
    language of fewer than `few` trusted documents uses the pooled model and limit. To judge a text, `prior` characters of the held-out
    mean are added to its own, as a few characters alone say little.
    """

    quantile: float = 0.99
    room: float = 1.1
    block_bytes: int = 8 << 20
    unit_grams: int = 500_000  # a task's units end when they have more different n-grams than this
    held_out: int = 3
    few: int = 20
    prior: int = 8


def grams_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document index, packed 4-gram ending at each character); texts start after three zeros.

    Characters take 16 bits each, those beyond them count as one.
    """
    cp = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    cp = np.minimum(cp, 0xFFFF).astype(np.uint64) + np.uint64(0)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    begin = lead[offsets]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(begin))
    at = np.arange(len(cp)) - begin[doc] if len(cp) else np.zeros(0, np.int64)
    g = cp.copy()
    for k in range(1, ORDER):
        back = np.zeros_like(cp)
        back[k:] = cp[:-k] if k < len(cp) else cp[:0]
        back[at < k] = 0
        g |= back << np.uint64(16 * k)
    return doc, g.view(np.int64)


BLOCKS = "unit long, lang string, ids array<long>, sizes array<int>, helds array<boolean>, z binary, grams array<long>"


def _packer(plan: QualityPlan):
    """Rows of two kinds: blocks of one language's texts, without grams, and the grams of a unit, without ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        context = TaskContext.get()
        number = context.partitionId() << 32 if context else 0
        squeeze = zstandard.ZstdCompressor(level=9)
        schema = pa.schema([("unit", pa.int64()), ("lang", pa.string()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("helds", pa.list_(pa.bool_())),
                            ("z", pa.binary()), ("grams", pa.list_(pa.int64()))])
        units: dict[str, int] = {}
        grams: dict[str, np.ndarray] = {}
        block: dict[str, tuple[list, list, list, list[bytes], list[np.ndarray]]] = {}

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = []
            for lang, (ids, sizes, helds, raw, seen) in block.items():
                if lang not in units:
                    units[lang], grams[lang] = number, np.zeros(0, np.int64)
                    number += 1
                grams[lang] = np.unique(np.concatenate([grams[lang], *seen]))
                rows.append({"unit": units[lang], "lang": lang, "ids": ids, "sizes": sizes, "helds": helds, "z": squeeze.compress(b"".join(raw)), "grams": None})
            block.clear()
            if last or sum(map(len, grams.values())) > plan.unit_grams:
                rows += [{"unit": units[k], "lang": k, "ids": None, "sizes": None, "helds": None, "z": None, "grams": v} for k, v in grams.items()]
                units.clear()
                grams.clear()
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

        held = 0
        for batch in batches:
            batch_ids, batch_langs = np.array(batch.column(0).to_pylist(), object), [x if x is not None else "" for x in batch.column(1).to_pylist()]
            batch_helds = np.array(batch.column(3).to_pylist(), object)
            for a, b, data, offsets in text_slices(batch.column(2), 1 << 20):
                doc, g = grams_of(data, offsets)
                own, size = np.array(batch_langs[a:b], object), np.diff(offsets)
                for lang in dict.fromkeys(batch_langs[a:b]):
                    mine = np.flatnonzero(own == lang)
                    ids, sizes, helds, raw, seen = block.setdefault(lang, ([], [], [], [], []))
                    seen.append(np.unique(g[(own == lang)[doc]]))
                    ids += batch_ids[a:b][mine].tolist()
                    helds += batch_helds[a:b][mine].tolist()
                    sizes += size[mine].tolist()
                    raw += [data[offsets[k]:offsets[k + 1]].tobytes() for k in mine]
                held += len(data)
                if held >= plan.block_bytes:
                    yield from flush(False)
                    held = 0
        yield from flush(True)

    return run


def _bucketed(df: DataFrame, folder: str) -> str:
    """Name of a table of `df` stored in buckets of its unit: a join by unit leaves its rows where they are."""
    spark, name = df.sparkSession, "llm_blocks_" + uuid.uuid4().hex
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "unit").option("path", f"{folder}/blocks").saveAsTable(name)
    return name


def _unpacked(batch: pa.RecordBatch, i: int) -> tuple[list, np.ndarray, np.ndarray]:
    import zstandard

    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(batch.column("z")[i].as_py()) or b"", np.uint8)
    offsets = np.concatenate([[0], np.cumsum(batch.column("sizes")[i].as_py())])
    return batch.column("ids")[i].as_py(), data, offsets


def _slices(data: np.ndarray, offsets: np.ndarray, most: int = 1 << 20):
    first, n = 0, len(offsets) - 1
    while first < n:
        end = min(max(int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1, first + 1), n)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, g, c) of the trusted documents that are not held out, summed in the task as far as memory for two million n-grams goes."""
    names = ["lang", "g", "c"]
    have: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, (g, c) in have.items():
            for a in range(0, len(g), 100_000):
                part = g[a:a + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(part), pa.array(c[a:a + 100_000])], names=names)
        have.clear()

    for batch in batches:
        for i in range(batch.num_rows):
            ids, data, offsets = _unpacked(batch, i)
            lang, good = batch.column("lang")[i].as_py(), set(batch.column("trusted")[i].as_py())
            trusted = np.array([x in good and not h for x, h in zip(ids, batch.column("helds")[i].as_py())])
            for a, b, part, at in _slices(data, offsets):
                if trusted[a:b].any():
                    doc, g = grams_of(part, at)
                    new, count = np.unique(g[trusted[a:b][doc]], return_counts=True)
                    old = have.get(lang, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    both, place = np.unique(np.concatenate([old[0], new]), return_inverse=True)
                    have[lang] = both, np.bincount(place, np.concatenate([old[1], count]), len(both)).astype(np.int64)
            if sum(len(g) for g, _ in have.values()) > 2_000_000:
                yield from rows()
    yield from rows()


def _salted(df: DataFrame, small: DataFrame, key: str, *by: str, salts: int = 32) -> DataFrame:
    """Left join on a key of few values, spread by a hash of other columns."""
    right = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return df.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")).join(right, [key, "salt"], "left").drop("salt")


def _suffix(g: Column, chars: int) -> Column:
    return g.bitwiseAND(F.lit((1 << (16 * chars)) - 1)) if chars < ORDER else g


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): the modified Kneser-Ney discounts from counts of counts; 0.5, 1, 1.5 where those give none."""
    n = [F.sum(F.when(F.col("c") == k, 1).otherwise(0)).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def d(k: int) -> Column:
        value = k - F.try_divide((k + 1) * y * F.col(f"n{k + 1}"), F.col(f"n{k}"))
        ok = (F.col(f"n{k}") > 0) & (F.col("n1") > 0) & (value > 0) & (value < k)
        return F.when(ok, value).otherwise(k / 2).alias(f"d{k}")

    return counts.groupBy("lang").agg(*n).select("lang", d(1), d(2), d(3))


def model(counts: DataFrame, folder: str) -> list[tuple[DataFrame, DataFrame]]:
    """For orders 4 to 1: ((lang, g, own), (lang, h, back)): a gram's discounted share and its context's back-off weight.

    The highest order counts occurrences, each lower one how many different characters
    stand before the gram.
    """
    out = []
    for order in range(ORDER, 0, -1):
        ds = discounts(counts)
        c = F.col("c")
        used = _salted(counts, ds, "lang", "g").withColumn("d", F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3")))
        used = used.withColumn("h", F.shiftrightunsigned("g", 16))
        context = used.groupBy("lang", "h").agg(F.sum("c").alias("total"), F.sum("d").alias("saved"))
        own = used.join(context, ["lang", "h"]).select("lang", "g", ((c - F.col("d")) / F.col("total")).alias("own"))
        back = context.select("lang", "h", (F.col("saved") / F.col("total")).alias("back"))
        out.append((stored(own, folder, f"own{order}"), stored(back, folder, f"back{order}")))
        if order > 1:
            counts = stored(counts.groupBy("lang", _suffix(F.col("g"), order - 1).alias("g")).agg(F.count("*").alias("c")), folder, f"counts{order - 1}")
    return out


def log_probabilities(wanted: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(lang, g, lp) for (lang, g): interpolated through all orders down to equal chances of 65,536 characters."""
    df = wanted
    for order, (own, back) in zip(range(ORDER, 0, -1), tables):
        key = _suffix(F.col("g"), order)
        df = df.withColumn("k", key).join(own.select("lang", F.col("g").alias("k"), F.col("own").alias(f"own{order}")), ["lang", "k"], "left").drop("k")
        # The order-1 context is empty: one row a language, so the key is salted.
        if order > 1:
            df = df.withColumn("h", F.shiftrightunsigned(key, 16)).join(back.select("lang", "h", F.col("back").alias(f"back{order}")), ["lang", "h"], "left").drop("h")
        else:
            df = _salted(df, back.select("lang", F.col("back").alias("back1")), "lang", "g")
    p = F.lit(1.0 / 65_536)
    for order in range(1, ORDER + 1):
        p = F.coalesce(F.col(f"own{order}"), F.lit(0.0)) + F.coalesce(F.col(f"back{order}"), F.lit(1.0)) * p
    return df.select("lang", "g", F.log(p).alias("lp"))


def _scorer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, data, offsets = _unpacked(batch, i)
            asked, chances = batch.column("gs")[i].values, batch.column("lps")[i].values
            keys, lps = (x.to_numpy() if x is not None else np.zeros(0) for x in (asked, chances))
            order = np.argsort(keys)
            keys, lps = keys[order], lps[order]
            total, count = np.zeros(len(ids)), np.zeros(len(ids), np.int64)
            for a, b, part, at in _slices(data, offsets):
                doc, g = grams_of(part, at)
                count[a:b] = np.bincount(doc, minlength=b - a)
                if len(g):
                    total[a:b] += np.bincount(doc, lps[np.searchsorted(keys, g)], b - a)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([batch.column("lang")[i].as_py()] * len(ids), pa.string()), pa.array(count), pa.array(total),
                                               batch.column("helds")[i].values], names=["doc_id", "lang", "n", "total", "held"])


def quality(docs: DataFrame, labels: DataFrame, plan: QualityPlan = QualityPlan()) -> DataFrame:
    """(doc_id, lang, n_chars, perplexity, threshold, keep), one row per row of `docs`.

    Trusted are documents of which a label says quality 1. Two thirds of their texts, by hash,
    train the models and the others set the limits, so that a limit is that of text the model
    has not seen; copies of a text are on one side. The limit is the greater of their quantile and
    of what few of them let expect of the next one, log-perplexities taken as normal. A language of fewer than `few` trusted
    documents is scored by the model of all languages together and held to the limit of such
    languages' held-out documents (of all held-out ones, if those have none; of all trusted
    ones, if nothing is held out); without any trusted text all chances are equal and texts
    stay. Null languages are one language; null and empty texts have no perplexity
    and do not stay; rows that repeat an id are scored each. Other columns are not read.
    """
    folder = work_folder(docs.sparkSession)
    held = F.pmod(F.xxhash64("text"), F.lit(plan.held_out)) == 0
    given = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string")).withColumn("held", held)
    spark = docs.sparkSession
    table = _bucketed(given.mapInArrow(_packer(plan), BLOCKS), folder)
    packed = spark.table(table)
    texts, grams = packed.where("ids is not null").select("unit", "lang", "ids", "sizes", "helds", "z"), packed.where("ids is null").select("unit", "lang", "grams")
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    places = texts.select("unit", "lang", F.explode("ids").alias("doc_id")).join(good, "doc_id")
    trusted = places.groupBy("unit").agg(F.collect_set("doc_id").alias("trusted"))
    counts = texts.join(trusted, "unit").mapInArrow(_counter, "lang string, g long, c long").groupBy("lang", "g").agg(F.sum("c").alias("c"))
    counts = stored(counts, folder, "counts-by-language")
    every = counts.groupBy("g").agg(F.sum("c").alias("c")).select(F.lit(POOLED).alias("lang"), "g", "c")
    counts = stored(counts.unionByName(every), folder, "counts4")
    tables = model(counts, folder)
    enough = places.groupBy("lang").agg(F.count("*").alias("n")).where(F.col("n") >= plan.few)
    known = counts.groupBy("lang").agg(F.first(F.lit(True)).alias("known")).join(enough, "lang", "left_semi")
    known = stored(known, folder, "known")
    exploded = grams.select("unit", "lang", F.explode("grams").alias("g"))
    wanted = _salted(exploded.select("lang", "g").distinct(), known, "lang", "g").select(F.col("lang").alias("asked"), F.when(F.col("known"), F.col("lang")).otherwise(POOLED).alias("lang"), "g")
    chances = log_probabilities(wanted.select("lang", "g").distinct(), tables)
    chances = stored(wanted.join(chances, ["lang", "g"]).select(F.col("asked").alias("lang"), "g", "lp"), folder, "chances")
    sent = exploded.join(chances, ["lang", "g"]).groupBy("unit").agg(F.collect_list(F.struct("g", "lp")).alias("x"))
    sent = sent.select("unit", F.col("x.g").alias("gs"), F.col("x.lp").alias("lps"))
    scored = stored(texts.join(sent, "unit", "left").mapInArrow(_scorer, "doc_id long, lang string, n long, total double, held boolean"), folder, "scores")
    spark.sql(f"DROP TABLE {table}")  # the name alone, its files stay as all others of the folder
    scored = _salted(scored, known, "lang", "doc_id", "total").withColumn("perplexity", F.when(F.col("n") > 0, F.exp(-F.col("total") / F.col("n"))))
    exact = scored.where("perplexity is not null").join(good, "doc_id", "left_semi")

    def limit(of: Column, name: str) -> Column:
        x = F.when(of, F.log("perplexity"))
        n, z = F.count(x), NormalDist().inv_cdf(plan.quantile)
        # The normal quantile of the next value after n, Student's by its first term.
        ahead = F.avg(x) + z * (1 + F.try_divide(F.lit((z * z + 1) / 4), n - 1)) * F.stddev_samp(x) * F.sqrt(1 + F.try_divide(F.lit(1), n))
        most = F.exp(F.greatest(F.percentile_approx(x, F.lit(plan.quantile), F.lit(10_000)), ahead)) * plan.room
        return F.when(n > 0, F.struct(most.alias("most"), F.avg(x).alias("mean"))).alias(name)

    own = exact.where("known and held").groupBy("lang").agg(limit(F.lit(True), "own_limit"))
    pooled = exact.agg(limit(F.col("held") & F.col("known").isNull(), "few_limit"), limit(F.col("held"), "all_limit"), limit(F.lit(True), "seen_limit")).withColumn("one", F.lit(1))
    out = _salted(scored, own, "lang", "doc_id", "total")
    out = _salted(out.withColumn("one", F.lit(1)), pooled, "one", "doc_id", "total")
    first = F.when(F.col("known"), F.col("own_limit")).otherwise(F.col("few_limit"))
    used = F.coalesce(first, "all_limit", "seen_limit")
    out = out.withColumn("used", used)
    threshold = F.coalesce("used.most", F.lit(float("inf")))
    steady = F.exp((plan.prior * F.coalesce("used.mean", F.lit(0.0)) - F.col("total")) / (plan.prior + F.col("n")))
    return out.select(
        "doc_id", "lang", F.col("n").alias("n_chars"), "perplexity", threshold.alias("threshold"),
        F.coalesce(F.when(F.col("n") > 0, steady <= threshold), F.lit(False)).alias("keep"),
    )
