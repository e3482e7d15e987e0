"""Toxicity: averaged subword vectors under a linear softmax, trained in numpy.

A word is the mean of the vectors of its character n-grams, a window the mean of
its words, and a softmax over that mean gives the window's classes; a text is as
toxic as its worst window, so a few bad words count the same in a short and in a
long text. Spellings that training never saw share most n-grams with ones it did.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.wordhash import BACK, LOWER_VALUE, STEP, U64, mix, text_slices, word_hashes, words


@dataclass(frozen=True)
class ToxicPlan:
    """`sample` labelled rows of each class at most are fitted on; `threshold` rejects."""

    sample: int = 2000
    buckets: int = 1 << 18
    dims: int = 8
    grams: tuple[int, ...] = (3, 4, 5, 6)
    window: int = 4
    rounds: int = 4
    epochs: int = 3
    threshold: float = 0.7
    seed: int = 11


@dataclass(frozen=True)
class ToxicModel:
    """What scoring needs: one number per n-gram bucket (its vector times the softmax's
    difference of classes), the intercept, and the scale and shift of the final fit."""

    gram: np.ndarray
    intercept: float
    scale: float
    shift: float


def word_grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, plan: ToxicPlan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word index, bucket) of all n-grams of lower-cased words, one n at a time.

    Grams at a word's start or end differ from the same letters inside it; a
    word shorter than the shortest n is one gram.
    """
    n = len(data)
    if not len(starts):
        return
    up, down = np.full(n, STEP, np.uint64), np.full(n + 1, BACK, np.uint64)
    up[0] = down[0] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(LOWER_VALUE[data] * up, out=run[1:])
    length = ends - starts
    for k in plan.grams:
        fits = np.maximum(length - k + 1, 0)
        if k == plan.grams[0]:
            fits = np.maximum(fits, 1)
        who = np.repeat(np.arange(len(starts)), fits)
        at = np.arange(len(who)) - np.repeat(np.cumsum(fits) - fits, fits) + starts[who]
        to = np.minimum(at + k, ends[who])
        edge = (at == starts[who]).astype(np.uint64) + U64(2) * (to == ends[who]).astype(np.uint64)
        h = mix((run[to] - run[at]) * down[at] + edge + U64(4 * k))
        yield who, (h % U64(plan.buckets)).astype(np.int64)


def word_scores(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, gram: np.ndarray, plan: ToxicPlan) -> np.ndarray:
    total, count = np.zeros(len(starts)), np.zeros(len(starts))
    for who, bucket in word_grams(data, starts, ends, plan):
        total += np.bincount(who, gram[bucket], len(starts))
        count += np.bincount(who, minlength=len(starts))
    return total / np.maximum(count, 1)


def windows(doc: np.ndarray, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, end word) of every window: `size` words, or a shorter text's all."""
    count = np.bincount(doc, minlength=n_docs)
    begin = np.cumsum(count) - count
    at = np.arange(len(doc))
    first = at[(at + size <= (begin + count)[doc]) | (at == begin[doc])]
    return first, np.minimum(first + size, (begin + count)[doc[first]])


def unrepeated(scores: np.ndarray, kind: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """Word scores in which a word that came up to `size` - 1 words before adds nothing again:
    a clean word said four times is no worse than said once."""
    again = np.zeros(len(scores), bool)
    for k in range(1, size):
        again[k:] |= (kind[k:] == kind[:-k]) & (doc[k:] == doc[:-k])
    return np.where(again, np.minimum(scores, 0.0), scores)


def _means(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0.0], np.cumsum(values)])
    return (run[end] - run[first]) / np.maximum(end - first, 1)


def score_texts(column: pa.Array, model: ToxicModel, plan: ToxicPlan) -> np.ndarray:
    out = []
    for first_row, end_row, data, offsets in text_slices(column):
        n = end_row - first_row
        starts, ends, doc = words(data, offsets)
        logit = np.full(n, -np.inf)
        if len(doc):
            first, end = windows(doc, n, plan.window)
            each = word_scores(data, starts, ends, model.gram, plan)
            mean = _means(unrepeated(each, each, doc, plan.window), first, end)
            np.maximum.at(logit, doc[first], mean + model.intercept)
        # A text without words has the least score that the fit knows.
        z = np.where(np.isfinite(logit), model.scale * logit + model.shift, -30.0)
        out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
    return np.concatenate(out) if out else np.zeros(0)


def fit(texts: list[str], labels: np.ndarray, plan: ToxicPlan) -> ToxicModel:
    """Vectors and softmax trained jointly on the windows that matter.

    A clean text is clean in all of its windows; a toxic one is toxic in some.
    Each round takes from toxic texts windows among the likeliest so far and
    from clean ones the likeliest and a few others, and runs Adagrad on them.
    The first choice uses n-grams' log-odds of occurring in toxic texts.
    """
    rng = np.random.default_rng(plan.seed)
    y = np.asarray(labels).astype(int)
    flat = np.zeros(plan.buckets, np.float32)
    if len(set(y.tolist())) < 2:
        return ToxicModel(flat, 0.0, 1.0, 20.0 if len(y) and y[0] else -20.0)
    n = len(texts)
    # A slice at a time, so that only words' numbers and the distinct words' bytes are kept.
    counts, hashes, known, kept = np.zeros(n, np.int64), [], np.zeros(0, np.uint64), []
    for at, end_row, data, offsets in text_slices(pa.array(texts), 1 << 19):
        starts, ends, doc = words(data, offsets)
        h = word_hashes(data, starts, ends)
        counts[at:end_row] = np.bincount(doc, minlength=end_row - at)
        hashes.append(h)
        fresh, where = np.unique(h, return_index=True)
        new = ~np.isin(fresh, known)
        known = np.union1d(known, fresh[new])
        kept += [(int(k), data[starts[i]:ends[i]].tobytes()) for k, i in zip(fresh[new], where[new])]
    kinds, parts = known, []
    while hashes:
        parts.append(np.searchsorted(kinds, hashes.pop(0)).astype(np.int32))
    kind = np.concatenate(parts)
    begin = np.concatenate([[0], np.cumsum(counts)])
    del parts, known
    kept.sort()
    distinct = pa.array([w.decode("utf-8", "replace") for _, w in kept])
    del kept
    per_type, buckets = [], []
    for _, end_row, data, offsets in text_slices(distinct, 1 << 19):
        parts = [(w.astype(np.int32), b.astype(np.int32)) for w, b in word_grams(data, offsets[:-1], offsets[1:], plan)]
        w, b = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        buckets.append(b[np.argsort(w, kind="stable")])
        per_type.append(np.bincount(w, minlength=len(offsets) - 1))
    n_types = len(kinds)
    del distinct, parts, w, b
    n_grams, bucket = np.concatenate(per_type), np.concatenate(buckets)
    gram_at = np.concatenate([[0], np.cumsum(n_grams)])
    del per_type, buckets

    def type_blocks() -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """(words, word of each gram counted from the first, bucket of each gram), 2**14 words at a time."""
        for t in range(0, n_types, 1 << 14):
            part = slice(t, min(t + (1 << 14), n_types))
            yield part, np.repeat(np.arange(part.stop - t), n_grams[part]), bucket[gram_at[t]:gram_at[part.stop]]

    def type_scores(gram: np.ndarray) -> np.ndarray:
        total = np.zeros(n_types)
        for part, who, grams in type_blocks():
            total[part] = np.bincount(who, gram[grams], part.stop - part.start)
        return total / np.maximum(n_grams, 1)

    # Texts are taken a block of about 2**16 words at a time, here and in each round.
    blocks = [0]
    while blocks[-1] < n:
        blocks.append(max(blocks[-1] + 1, int(np.searchsorted(begin, begin[blocks[-1]] + (1 << 16), "right")) - 1))

    def of_block(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(i, j), counts[i:j]), kind[begin[i]:begin[j]]

    in_docs = np.zeros((2, n_types))
    for i, j in zip(blocks, blocks[1:]):
        own, k = of_block(i, j)
        seen = np.unique(own * n_types + k)
        for c in (0, 1):
            in_docs[c] += np.bincount(seen[y[seen // n_types] == c] % n_types, minlength=n_types)
    by_class = np.zeros((2, plan.buckets))
    for part, who, grams in type_blocks():
        for c in (0, 1):
            by_class[c] += np.bincount(grams, in_docs[c][part][who], plan.buckets)
    gram = np.log((by_class[1] + 1) / (y.sum() + 2)) - np.log((by_class[0] + 1) / ((1 - y).sum() + 2))
    del in_docs, by_class

    def window_scores(gram: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(text, scores of its windows), of texts with words; window k begins at word k."""
        of_type = type_scores(gram)
        for i, j in zip(blocks, blocks[1:]):
            own, k = of_block(i, j)
            first, end = windows(own - i, j - i, plan.window)
            mean = _means(unrepeated(of_type[k], k, own, plan.window), first, end)
            by_doc = np.concatenate([[0], np.cumsum(np.bincount(own[first] - i, minlength=j - i))])
            for d in range(i, j):
                if counts[d]:
                    yield d, mean[by_doc[d - i]:by_doc[d - i + 1]]

    vec = (rng.standard_normal((plan.buckets, plan.dims)) * 0.1).astype(np.float32)
    soft = (rng.standard_normal((plan.dims, 2)) * 0.5).astype(np.float32)
    bias = np.zeros(2, np.float32)
    g_vec, g_soft, g_bias = np.full(plan.buckets, 1e-3, np.float32), np.full_like(soft, 1e-3), np.full(2, 1e-3, np.float32)
    rate = 0.5

    def batch(first: np.ndarray, size: np.ndarray, target: np.ndarray) -> None:
        nonlocal soft, bias, g_soft, g_bias
        win = np.repeat(np.arange(len(first)), size)
        word = np.arange(len(win)) - np.repeat(np.cumsum(size) - size, size) + first[win]
        k = kind[word]
        reps = n_grams[k]
        of_word = np.repeat(np.arange(len(word)), reps)
        g = bucket[np.arange(len(of_word)) - np.repeat(np.cumsum(reps) - reps, reps) + gram_at[k][of_word]]
        weight = (1.0 / reps[of_word] / size[win[of_word]]).astype(np.float32)
        rows, place = np.unique(g, return_inverse=True)
        cell = win[of_word] * len(rows) + place
        # Window by n-gram weights: small and dense, so that both passes are matrix products.
        dense = np.bincount(cell, weight, len(first) * len(rows)).reshape(len(first), len(rows)).astype(np.float32)
        x = dense @ vec[rows]
        z = x @ soft + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        d = p.copy()
        d[np.arange(len(target)), target] -= 1
        up_vec = dense.T @ (d @ soft.T)
        up_soft, up_bias = x.T @ d / len(target) * 8, d.mean(0)
        g_vec[rows] += (up_vec**2).mean(1)
        vec[rows] -= rate * up_vec / np.sqrt(g_vec[rows])[:, None]
        g_soft += up_soft**2
        soft = soft - 0.1 * up_soft / np.sqrt(g_soft)
        g_bias += up_bias**2
        bias = bias - 0.1 * up_bias / np.sqrt(g_bias)

    for _ in range(plan.rounds):
        chosen, size, target = [], [], []
        for i, s in window_scores(gram):
            best = int(s.argmax())
            if y[i]:
                likely = np.flatnonzero(s >= s[best] - 0.5 * max(abs(s[best]), 1e-6))
                picks = [best, *rng.choice(likely, 2)]
            else:
                picks = [best, *rng.integers(0, len(s), 2)]
            chosen += [begin[i] + q for q in picks]
            size += [min(plan.window, counts[i])] * len(picks)
            target += [y[i]] * len(picks)
        chosen, size, target = np.array(chosen), np.array(size), np.array(target)
        for _ in range(plan.epochs):
            mixed = rng.permutation(len(chosen))
            for at in range(0, len(mixed), 32):
                part = mixed[at:at + 32]
                batch(chosen[part], size[part], target[part])
        gram = (vec @ (soft[:, 1] - soft[:, 0])).astype(np.float64)
    intercept = float(bias[1] - bias[0])
    worst = np.full(n, -30.0)
    for i, s in window_scores(gram):
        worst[i] = max(-30.0, s.max() + intercept)
    scale, shift = _logistic(worst, y)
    return ToxicModel(gram.astype(np.float32), intercept, scale, shift)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (never negative) and shift of a lightly ridged logistic fit, by Newton's steps."""
    x = np.clip(x, -30, 30)
    w = np.array([1.0, 0.0])
    for _ in range(30):
        z = np.clip(w[0] * x + w[1], -30, 30)
        p = 1 / (1 + np.exp(-z))
        a = np.stack([x, np.ones_like(x)])
        grad = a @ (p - y) + 0.01 * (w - np.array([1.0, 0.0]))
        hess = (a * (p * (1 - p))) @ a.T + 0.01 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - step / max(1.0, float(np.abs(step).max()))
    return float(max(w[0], 1e-3)), float(w[1])


def held_out(doc_id):
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, plan: ToxicPlan = ToxicPlan()) -> ToxicModel:
    """Fit on at most `sample` rows of each class, the first by hash, none of them held out.

    Labels of one document that differ count as toxic; null labels, null ids
    and null texts teach nothing. Only ids are chosen from all rows; one text of
    each chosen one, the least by hash where an id repeats, comes to the driver.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id"))).join(docs.where("text is not null").select("doc_id").distinct(), "doc_id", "left_semi")
    picked = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(plan.sample).collect() for c in (0, 1)]
    rows = [(r.doc_id, int(r.toxic)) for part in picked for r in part]
    spark = docs.sparkSession
    ids = spark.createDataFrame(rows, "doc_id long, toxic int")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    text = F.col("text").cast("string")
    found = given.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.min(F.struct(F.xxhash64(text), text.alias("text"))).alias("x"))
    found = found.select("doc_id", "toxic", "x.text").toArrow()
    order = np.argsort(found["doc_id"].to_numpy(), kind="stable")
    texts = found["text"].to_pylist()
    return fit([texts[i] for i in order], found["toxic"].to_numpy()[order], plan)


def score(docs: DataFrame, model: ToxicModel, plan: ToxicPlan = ToxicPlan()) -> DataFrame:
    """`docs` with a column toxic_score for its text; null and empty texts get about 0."""
    names = docs.columns
    column = "toxic_score"
    while column in names:
        column = f"_{column}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = pa.array(score_texts(batch.column(names.index("text")), model, plan))
            yield pa.RecordBatch.from_arrays([*batch.columns, value], names=[*names, column])

    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, plan: ToxicPlan = ToxicPlan()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; labels, language, source and id are no inputs of a score."""
    model = train(docs, labels, plan)
    out = score(docs.select("doc_id", F.col("text").cast("string").alias("text")), model, plan)
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= plan.threshold).cast("int").alias("predicted"),
    )
