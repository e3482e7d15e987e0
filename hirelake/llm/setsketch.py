"""Near-duplicate documents by SetSketch registers, banded, estimated and verified.

A document is the set of its distinct 5-word shingles. Each shingle runs one
Poisson process per register; a register keeps the level, on an exponential
scale, of its earliest arrival. Sketches merge by the larger level and equal
levels are likelier the more two sets share. Documents with equal bands are
candidates; the joint likelihood of their registers and a bound from bitmaps of
the sets drop those below the threshold, and the full sets decide the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.components import components
from hirelake.llm.stored import stored, work_folder
from hirelake.llm.wordhash import U64, mix, shingle_sets, text_slices


@dataclass(frozen=True)
class SketchPlan:
    """Bands of `rows` registers each, the level base, and the similarity in percent.

    At similarity 0.75 a pair misses all of 36 bands of 5 with probability 6e-5.
    `slack` is about five standard errors of the register estimate.
    """

    bands: int = 36
    rows: int = 5
    base: float = 1.001
    percent: int = 75
    slack: float = 0.17
    words: int = 64  # of 64 bits in the bitmap of a set
    shingle: int = 5
    block: int = 256

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def sketch(who: np.ndarray, shingles: np.ndarray, n_docs: int, plan: SketchPlan) -> np.ndarray:
    """Registers (n_docs x registers, int16) of the given (document, shingle) pairs.

    The processes of all registers are drawn as one of rate m whose arrivals
    pick registers at random. A document's arrivals are cut off at a time, set by
    its size, when all but e^-4 of its registers have one; the rest share the
    lowest level. So the work is one draw a shingle and about 4 m a document,
    not m a shingle.
    """
    m = plan.registers
    size = np.maximum(np.bincount(who, minlength=n_docs), 1)
    until = CUT / size
    first = np.full(n_docs * m, np.inf)
    t = np.zeros(len(who))
    state, limit, row = shingles.copy(), until[who], who.astype(np.int64) * m
    while len(t):
        state = mix(state + U64(0x9E3779B97F4A7C15))
        t = t - np.log(((state >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / m
        go = t < limit
        t, state, limit, row = t[go], state[go], limit[go], row[go]
        register = (((mix(state) >> U64(32)) * U64(m)) >> U64(32)).astype(np.int64)
        np.minimum.at(first, row + register, t)
    level = np.floor(-np.log(np.minimum(first, 1e9)) / math.log(plan.base))
    return np.clip(level, -2000, 32000).astype(np.int16).reshape(n_docs, m)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, base: float) -> np.ndarray:
    """Most likely similarity of register rows given both set sizes, on a grid of 1/64."""
    above, below = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - above - below
    u, v = na / (na + nb), nb / (na + nb)
    grid = np.arange(65) / 64.0
    best = np.minimum(u, v) / np.maximum(u, v)
    j = grid[None, :] * best[:, None]
    scale, lb = (base - 1) / base, math.log(base)
    p_above = -np.log1p(-np.clip(u[:, None] - v[:, None] * j, 0, 1) * scale) / lb
    p_below = -np.log1p(-np.clip(v[:, None] - u[:, None] * j, 0, 1) * scale) / lb
    p_equal = 1 - p_above - p_below
    tiny = 1e-9
    like = (above[:, None] * np.log(np.maximum(p_above, tiny)) + below[:, None] * np.log(np.maximum(p_below, tiny))
            + equal[:, None] * np.log(np.maximum(p_equal, tiny)))
    return j[np.arange(len(j)), like.argmax(1)]


def set_bits(who: np.ndarray, shingles: np.ndarray, n_docs: int, plan: SketchPlan) -> np.ndarray:
    """Bitmaps (n_docs x words): every shingle sets the bit of its cell."""
    cell = mix(shingles + SALTS[2]) % U64(64 * plan.words)
    out = np.zeros(n_docs * plan.words, np.uint64)
    np.bitwise_or.at(out, who * plan.words + (cell >> U64(6)).astype(np.int64), U64(1) << (cell & U64(63)))
    return out.reshape(n_docs, plan.words)


def may_link(
    a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int, filled: tuple[np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """(whether sets with these bitmaps can reach the similarity, the most that they can share).

    A cell that only one set fills holds a shingle that the other lacks, so the
    bound never rejects a link. It is tight while sets are smaller than bitmaps;
    for much larger sets it lets nearly all pass and the likelihood decides.
    `filled` has the numbers of bits in either side's bitmaps, where known.
    """
    both = np.bitwise_count(a & b).sum(1, dtype=np.int64)
    in_a, in_b = filled or (bits_in(a), bits_in(b))
    shared = np.minimum(na - (in_a - both), nb - (in_b - both))
    return 100 * shared >= percent * (na + nb - shared), shared


def bits_in(bitmaps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bitmaps).sum(1, dtype=np.int64)


#: Registers are cut off when a share e^-4 has seen no arrival.
CUT = 4.0
SALTS = mix(np.arange(1, 4, dtype=np.uint64))
#: Pairs whose bitmaps and registers are compared at a time.
PAIRS_AT_ONCE = 4_096
SKETCH_SCHEMA = "doc_id long, n_shingles long, sig_a long, sig_b long, sketch binary, bands array<long>"


def _sketch_batches(plan: SketchPlan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, end, data, offsets in text_slices(batch.column(1)):
                n = end - first
                who, value = shingle_sets(data, offsets, plan.shingle)
                regs = sketch(who, value, n, plan)
                size = np.bincount(who, minlength=n)
                sig = np.zeros((2, n), np.uint64)
                for k in range(2):
                    np.add.at(sig[k], who, mix(value + SALTS[k]))
                keys = np.zeros((n, plan.bands), np.uint64)
                for r in range(plan.rows):
                    keys = mix(keys * U64(3) + regs[:, r::plan.rows].astype(np.uint64) + U64(r + 1))
                keys = mix(keys + np.arange(plan.bands, dtype=np.uint64)[None, :])
                flat = pa.array(keys.view(np.int64).ravel())
                raw = np.concatenate([regs.view(np.uint8), set_bits(who, value, n, plan).view(np.uint8)], axis=1).tobytes()
                width = len(raw) // n
                yield pa.RecordBatch.from_arrays([
                    ids.slice(first, n), pa.array(size.astype(np.int64)),
                    pa.array(sig[0].view(np.int64)), pa.array(sig[1].view(np.int64)),
                    pa.array([raw[i * width:(i + 1) * width] for i in range(n)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * plan.bands), flat),
                ], names=["doc_id", "n_shingles", "sig_a", "sig_b", "sketch", "bands"])

    return run


def _unpacked(sketches: list, plan: SketchPlan) -> tuple[np.ndarray, np.ndarray]:
    """(registers, bitmaps) of stored sketches."""
    raw = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    cut = plan.registers * 2
    return np.ascontiguousarray(raw[:, :cut]).view(np.int16), np.ascontiguousarray(raw[:, cut:]).view(np.uint64)


def _likely(plan: SketchPlan):
    """Keep pairs that the bitmaps allow and whose estimate is within the slack of the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (ra, ba), (rb, bb) = (_unpacked(batch.column(c).to_pylist(), plan) for c in ("sa", "sb"))
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            good, _ = may_link(ba, bb, na, nb, plan.percent)
            at = np.flatnonzero(good)
            good[at] = estimate(ra[at], rb[at], na[at].astype(float), nb[at].astype(float), plan.base) >= plan.percent / 100 - plan.slack
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def _verified(plan: SketchPlan):
    """Keep pairs of texts whose full shingle sets reach the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):  # few pairs' sets are in memory at once
                batch = whole.slice(at, 500)
                sides = []
                for c in ("ta", "tb"):
                    whos, values = [], []
                    for first, _, data, offsets in text_slices(batch.column(c)):
                        who, value = shingle_sets(data, offsets, plan.shingle)
                        whos.append(who + first)
                        values.append(value)
                    sides.append((np.concatenate([np.zeros(0, np.int64), *whos]), np.concatenate([np.zeros(0, np.uint64), *values])))
                n = batch.num_rows
                size = [np.bincount(w, minlength=n) for w, _ in sides]
                who, value = (np.concatenate(x) for x in zip(*sides))
                order = np.lexsort((value, who))
                who, value = who[order], value[order]
                same = np.flatnonzero((who[1:] == who[:-1]) & (value[1:] == value[:-1]))
                shared = np.bincount(who[same], minlength=n)
                union = size[0] + size[1] - shared
                yield batch.select(["a", "b"]).filter(pa.array((union > 0) & (100 * shared >= plan.percent * union)))

    return run


def _block_pairs(plan: SketchPlan, every: bool):
    """Within one pair of blocks of a bucket: likely pairs of different components.

    Either `every` pair, or each left member's most promising one where there are more
    pairs than members; `cut` marks those.
    """
    def run(rows: pa.Table) -> pa.Table:
        side, comp, n, ids = (rows.column(c).to_numpy() for c in ("side", "comp", "n", "doc_id"))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        # Sets whose sizes alone forbid the similarity are not looked at.
        i, j = np.nonzero((comp[left][:, None] != comp[right]) & (
            100 * np.minimum(n[left][:, None], n[right]) >= plan.percent * np.maximum(n[left][:, None], n[right])))
        i, j = left[i], right[j]
        found = []
        if len(i):
            regs, bits = _unpacked(rows.column("sketch").to_pylist(), plan)
            filled = bits_in(bits)
            for at in range(0, len(i), PAIRS_AT_ONCE):
                a, b = i[at:at + PAIRS_AT_ONCE], j[at:at + PAIRS_AT_ONCE]
                good, shared = may_link(bits[a], bits[b], n[a], n[b], plan.percent, (filled[a], filled[b]))
                a, b, shared = a[good], b[good], shared[good]
                good = estimate(regs[a], regs[b], n[a].astype(float), n[b].astype(float), plan.base) >= plan.percent / 100 - plan.slack
                a, b, shared = a[good], b[good], shared[good]
                found.append((a, b, shared / (n[a] + n[b] - shared)))
        a, b, share = (np.concatenate(x) for x in zip((i[:0], j[:0], np.zeros(0)), *found))
        order = np.lexsort((ids[b], -share, a))
        a, b = a[order], b[order]
        cut = not every and len(a) > rows.num_rows
        if cut:
            best = np.diff(a, prepend=-1) != 0
            a, b = a[best], b[best]
        return pa.table({"a": ids[a], "b": ids[b], "cut": np.full(len(a), cut)})

    return run


def _confirm(pairs: DataFrame, texts: DataFrame, plan: SketchPlan) -> DataFrame:
    ta = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb").mapInArrow(_verified(plan), "a long, b long")


def near_duplicates(docs: DataFrame, plan: SketchPlan = SketchPlan(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of `docs`.

    Documents are linked at similarity `percent` or more; component_id is the
    smallest id reachable and kept marks it. Null and empty texts have no
    shingles and stand alone; rows that repeat an id are one document and get a
    row each; rows without id are linked with nothing, have no component and are
    kept. Other columns are not read, so their names do not matter.

    Equal sets are first reduced to their smallest id. A bucket's members are
    compared with its leader. Those not joined with it are compared, in blocks of
    `block` members, with all of the bucket that lies in another component; so no
    pair that shares a bucket is lost, and none inside a component is enumerated.
    A comparison reads two sketches within a task and sends on all likely
    pairs of a block that has no more of them than members; else one pair a
    member, its most promising, as long as that joins components, and only then all that the sketches still allow, which lie close to the threshold.
    """
    spark = docs.sparkSession
    folder = work_folder(spark)
    given = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    sketches = stored(given.mapInArrow(_sketch_batches(plan), SKETCH_SCHEMA), folder, "sketches")
    sets = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = sets.groupBy("n_shingles", "sig_a", "sig_b").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes, folder, "classes")
    copies = sets.select("doc_id", "n_shingles", "sig_a", "sig_b").join(classes, ["n_shingles", "sig_a", "sig_b"]).where("doc_id <> rep")
    copies = stored(copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")), folder, "copies")
    # One sketch per distinct set: a repeated id adds the same row again.
    whole = sets.join(classes.select(F.col("rep").alias("doc_id"), "n_shingles", "sig_a", "sig_b"), ["doc_id", "n_shingles", "sig_a", "sig_b"], "left_semi")
    reps = whole.select("doc_id", F.col("n_shingles").alias("n"), "sketch")
    members = whole.select(F.explode("bands").alias("bucket"), "doc_id").distinct()
    counted = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(members.join(counted, "bucket"), folder, "shared-buckets")
    # A bucket's leader is its member with most company over all buckets (the smallest id on
    # ties): the text that copies were made from leads them in every bucket it is in.
    company = members.groupBy("doc_id").agg(F.sum("size").alias("company"))
    members = stored(members.join(company, "doc_id").select("bucket", "doc_id", "size", F.struct("company", (-F.col("doc_id")).alias("minus")).alias("weight")), folder, "weighed")
    leads = members.groupBy("bucket").agg(F.max("weight").alias("best")).select("bucket", "best", (-F.col("best.minus")).alias("lead"))
    members = stored(members.drop("weight").join(leads, "bucket"), folder, "members")
    counted = members.groupBy("bucket").agg(F.first("size").alias("size"))

    def with_sketches(pairs: DataFrame) -> DataFrame:
        ra = reps.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
        rb = reps.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
        return pairs.join(ra, "a").join(rb, "b").select("a", "b", "na", "nb", "sa", "sb")

    def confirmed(pairs: DataFrame) -> DataFrame:
        likely = with_sketches(pairs).mapInArrow(_likely(plan), "a long, b long")
        return _confirm(likely, given, plan)

    # One pair a document, with the best leader of its buckets, joins most copies; then
    # the leaders of other components.
    beside = members.where("doc_id <> lead")
    best = beside.groupBy("doc_id").agg(F.max("best").alias("best")).select((-F.col("best.minus")).alias("a"), F.col("doc_id").alias("b"))
    links = stored(confirmed(best), folder, "best-links")
    zero = stored(components(links, folder, "zero"), folder, "zero-components")
    of = lambda c, out: zero.select(F.col("node").alias(c), F.col("component").alias(out))
    star = beside.join(of("doc_id", "cd"), "doc_id", "left").join(of("lead", "cl"), "lead", "left")
    star = star.where(F.coalesce("cd", "doc_id") != F.coalesce("cl", "lead")).select(F.col("lead").alias("a"), F.col("doc_id").alias("b"))
    star = star.distinct().join(best, ["a", "b"], "left_anti")
    links = stored(links.union(confirmed(star)).distinct(), folder, "star-links")
    first = stored(components(links, folder, "first"), folder, "first-components")

    def open_pairs(comp: DataFrame, every: bool, name: str) -> DataFrame:
        labelled = members.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("comp", F.coalesce("component", "doc_id"))
        lead_comp = comp.select(F.col("node").alias("lead"), F.col("component").alias("lc"))
        labelled = labelled.join(lead_comp, "lead", "left").withColumn("rest", F.col("comp") != F.coalesce("lc", "lead"))
        labelled = stored(labelled.select("bucket", "doc_id", "comp", "rest", "lead"), folder, f"labelled-{name}")
        # Buckets with one odd member need nothing more: the star has compared it with the leader,
        # but with the leader's component it has not been compared.
        odd = labelled.where("rest").groupBy("bucket").agg(F.count("*").alias("n_rest"))
        odd = odd.join(counted.select("bucket", "size"), "bucket").where("size > 2")
        open_rows = labelled.join(odd, "bucket").where("rest or doc_id <> lead")
        blocks = lambda n: F.ceil(n / F.lit(plan.block)).cast("int")
        n_rest, n_main = blocks(F.col("n_rest")), blocks(F.col("size") - F.col("n_rest"))
        placed = open_rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.when(F.col("rest"), n_rest).otherwise(F.greatest(n_main, F.lit(1)))).cast("int"))
        # Left side: a block of the rest. Right side: the same or a later block of the rest, or a block of the main component.
        as_left = placed.where("rest").select("bucket", "doc_id", "comp", F.lit(0).alias("side"), F.col("block").alias("i"), F.explode(F.concat(
            F.transform(F.sequence(F.col("block"), n_rest - 1), lambda j: F.struct(F.lit(True).alias("r"), j.alias("j"))),
            F.transform(F.sequence(F.lit(0), F.greatest(n_main, F.lit(1)) - 1), lambda j: F.struct(F.lit(False).alias("r"), j.alias("j"))),
        )).alias("to")).select("bucket", "doc_id", "comp", "side", "i", "to.r", "to.j")
        as_right = placed.select("bucket", "doc_id", "comp", F.lit(1).alias("side"), F.col("block").alias("j"), F.col("rest").alias("r"), F.explode(
            F.when(F.col("rest"), F.sequence(F.lit(0), F.col("block"))).otherwise(F.sequence(F.lit(0), n_rest - 1))
        ).alias("i")).select("bucket", "doc_id", "comp", "side", "i", "r", "j")
        tasks = as_left.unionByName(as_right).join(reps, "doc_id")
        found = tasks.groupBy("bucket", "i", "r", "j").applyInArrow(_block_pairs(plan, every), "a long, b long, cut boolean")
        ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        return stored(found.select(*ends, "cut").groupBy("a", "b").agg(F.max("cut").alias("cut")), folder, f"more-{name}")

    # One pair a member of a crowded block while some of them join components, then all that are left.
    tried, turn = None, 0
    while True:
        pairs = open_pairs(first, False, str(turn))
        if not pairs.limit(1).count():
            break
        whole_blocks = not pairs.where("cut").limit(1).count()
        pairs = pairs.select("a", "b")
        new = stored(_confirm(pairs, given, plan), folder, f"links-{turn}")
        tried = pairs if tried is None else tried.union(pairs)
        if whole_blocks:
            links = links.union(new)
            break
        if not new.limit(1).count():
            pairs = open_pairs(first, True, "all").select("a", "b").join(tried, ["a", "b"], "left_anti")
            links = links.union(stored(_confirm(pairs, given, plan), folder, "links-all"))
            break
        links = links.union(new)
        first = stored(components(links, folder, f"turn-{turn}"), folder, f"turn-{turn}-components")
        turn += 1
    edges = copies.union(links)
    comp = components(edges, folder, "all")
    out = sketches.select("doc_id", "n_shingles").join(comp.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
