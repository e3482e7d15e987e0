"""Delete passages that an earlier place already has, with DataFrame functions only.

Texts are cut into lines of one word each, so that no cut depends on what stands
around a passage. Winnowing picks, in each window of hashes of `gram` lines, the
least one; a stretch of `reach` lines holds one window, so equal stretches have equal
picks. Successive stretches of one pick form its span. Equal spans count as repeats of
their earliest place, whichever it is; where spans of one pick differ, the stretches
in the earliest of each are compared one by one. Stretches that an earlier place has
are united, and runs of `min_words` words or more go.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.stored import stored, work_folder
from hirelake.operators.stages import evaluated_once

WORD = r"[^\x20\x09-\x0D]+"
# A cut follows each word with its blanks and breaks, and ideographic full stops.
CUT = r"[\x20\x09-\x0D]+|[。！？]"
MARK, SHORT_MARK = "\uffff", "\x01"
# Texts with one of these need the regular expression.
RARE = "\t\r\x0b\x0c。！？" + MARK + SHORT_MARK


@dataclass(frozen=True)
class WinnowPlan:
    """`gram` lines a hash, `window` hashes a pick; a line is a word.

    Any repeated stretch of gram + window - 1 = 40 lines is found. A run counts from
    `min_words` words and `min_chars` characters; shorter repeats are left alone.
    """

    gram: int = 9
    window: int = 32
    min_words: int = 40
    min_chars: int = 0

    @property
    def reach(self) -> int:
        return self.gram + self.window - 1


def lines(text: Column) -> Column:
    """The lines of a text with the blank or break that ends them; joined, they are the text (but for U+FFFF, read as a blank).

    A text with no cut but U+0020 and U+000A is cut by plain replacements, in a third of the time of the regular expression.
    """
    rare = F.contains(text, F.lit(RARE[0]))
    for c in RARE[1:]:
        rare = rare | F.contains(text, F.lit(c))
    plain = F.when(F.contains(text, F.lit(MARK)), F.replace(text, F.lit(MARK), F.lit(" "))).otherwise(text)
    cut = text
    for old, new in ((" ", " " + SHORT_MARK), ("\n", "\n" + SHORT_MARK), (SHORT_MARK + " ", " "), (SHORT_MARK + "\n", "\n")):
        cut = F.replace(cut, F.lit(old), F.lit(new))
    return F.when(rare, F.split(F.regexp_replace(plain, CUT, "$0" + MARK), MARK, -1)).otherwise(F.split(cut, SHORT_MARK, -1))


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


#: Low bits of a packed pick hold its place; windows are far shorter, so a wrap is undone from the window's own place.
PLACE = (1 << 24) - 1


def _joined(array: str, ahead: int, use: Callable[[Column, Column], Column]) -> Column:
    """`use` of each element and the one `ahead` places later, null after the end."""
    return F.zip_with(array, F.slice(array, F.lit(ahead + 1), F.size(array)), use)


def _span(n: int) -> int:
    return 4 if n >= 4 else 2 if n >= 2 else 1


def with_rolled(units: DataFrame, n: int) -> DataFrame:
    """`units` with c: at each line of u, that line's hash and the next ones' joined, four of them if `n` lines are that many.

    Hashing a slice of u at each line costs most by far; few of these joined numbers tell as much.
    No bit is shifted out, so lines that differ in one place alone never have equal ones.
    """
    units = units.withColumn("c", F.transform("u", lambda x: x.cast("long")))
    for ahead, bits in ((1, 17), (2, 13)):
        if 2 * ahead <= n:
            units = evaluated_once(units.withColumn("c", _joined("c", ahead, lambda x, y: x.bitwiseXOR(F.shiftleft(y, bits)))), "c")  # noqa: B023
    return units


def _places(n: int) -> list[int]:
    """Offsets at which the numbers in c cover `n` lines."""
    return [*range(0, n - _span(n), _span(n)), n - _span(n)]


def _hash_at(i: Column, n: int) -> Column:
    """The hash of the `n` lines from `i` on."""
    return F.xxhash64(*[F.get("c", i + d) for d in _places(n)])


def winnowed(texts: DataFrame, plan: WinnowPlan) -> DataFrame:
    """One row per distinct text of at least `reach` lines: row (its key), doc_id (the smallest), u (line hashes), picks.

    A pick is the run whose first words have the least hash in a window of `window`
    runs, leftmost on ties, so equal windows have equal picks. A pick has the hash fp
    of all lines of its run, the first a of the stretches that have it, their number n, the hash
    of all their lines sh, and whether it is tight: the same run follows in each of
    these stretches, as in a short phrase over and over.
    """
    k, w, reach = plan.gram, plan.window, plan.reach
    given = texts.where("text is not null and text <> ''").select("doc_id", text_key(F.col("text")).alias("row"), lines(F.col("text")).alias("x"))
    # Columns that filters and lambdas read are fixed first; Spark would else put their
    # expressions there as well and evaluate them anew, for each element in a lambda.
    given = evaluated_once(given, "x").where(F.size("x") >= reach)
    units = given.select("doc_id", "row", F.transform("x", lambda x: F.hash(x)).alias("u"))
    units = units.groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.first("u").alias("u"))
    units = with_rolled(units, k)
    packed = F.transform("c", lambda h, i: F.shiftleft(h, 24).bitwiseOR(i.cast("long").bitwiseAND(F.lit(PLACE))))
    units = evaluated_once(units.withColumn("least", packed), "least")
    held = 1
    while held < w:
        ahead = min(held, w - held)
        units = evaluated_once(units.withColumn("least", _joined("least", ahead, lambda x, y: F.least(x, y))), "least")
        held += ahead
    units = evaluated_once(units.withColumn("least", F.slice("least", F.lit(1), F.size("u") - (reach - 1))), "least")
    begins = F.filter(F.sequence(F.lit(0), F.size("least") - 1), lambda s: ~F.get("least", s).eqNullSafe(F.get("least", s - 1)))
    units = evaluated_once(units.withColumn("begins", begins), "begins")
    found = F.transform("begins", lambda a, i: F.struct(
        a.alias("a"), (F.coalesce(F.get("begins", i + 1), F.size("least")) - a).alias("n"),
        (a + F.pmod(F.get("least", a).bitwiseAND(F.lit(PLACE)) - a, F.lit(PLACE + 1)).cast("int")).alias("p"),
    ))
    units = evaluated_once(units.withColumn("found", found), "found")

    def pick(x: Column) -> Column:
        a, n, p = x["a"], x["n"], x["p"]
        same = lambda q: reduce(Column.__and__, [F.get("c", q + d) == F.get("c", p + d) for d in _places(k)])
        # An ascending sequence has one place at least: the pick itself, which is left out.
        again = F.exists(F.sequence(p, a + (w - 1)), lambda q: (q > p) & same(q))
        whole = F.transform(F.sequence(a, a + n + (reach - 1 - _span(k)), F.lit(_span(k))), lambda i: F.get("c", i))
        sh = F.xxhash64(n, whole, F.get("c", a + n + (reach - 1 - _span(k))))
        return F.struct(_hash_at(p, k).alias("fp"), a.alias("a"), n.alias("n"), sh.alias("sh"), again.alias("tight"))

    return units.select("row", "doc_id", "u", F.transform("found", pick).alias("picks"))


def repeated_runs(texts: DataFrame, plan: WinnowPlan = WinnowPlan(), folder: str | None = None) -> DataFrame:
    """(row, start, end, from_row, from_start): line runs of at least `reach` lines of a distinct text that an earlier place has.

    `texts` has doc_id and text; row is a text's key. Earlier means a smaller
    doc_id (null last), then a smaller key, then an earlier line. Every stretch of
    `reach` lines that any earlier place has is in some run; runs overlap. Within
    one text, a short phrase over and over is no repeat.
    """
    folder = folder or work_folder(texts.sparkSession)
    reach = plan.reach
    units = stored(winnowed(texts, plan), folder, "units")
    picks = units.select("row", "doc_id", F.explode("picks").alias("x")).select("row", "doc_id", "x.*")
    place = lambda at: F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "row", F.col(at).alias("at"))
    again = picks.groupBy("fp").agg(F.count("*").alias("times"), F.min("sh").alias("low"), F.max("sh").alias("high"))
    again = again.where("times > 1").select("fp", (F.col("low") != F.col("high")).alias("mixed"))
    hits = stored(picks.join(again, "fp"), folder, "hits")
    first = hits.groupBy("fp", "sh").agg(F.min(place("a")).alias("first"))
    first = first.select("fp", "sh", F.col("first.row").alias("row0"), F.col("first.at").alias("a0"))
    leads, inside = F.expr("row = row0 and a = a0"), F.expr("row = row0 and tight")
    seen = hits.join(first, ["fp", "sh"]).withColumn("covered", ~leads & ~inside).where("covered or mixed")
    seen = stored(seen.select("row", "doc_id", "a", "n", "tight", "row0", "a0", "covered"), folder, "seen")
    whole = seen.where("covered").select("row", F.col("a").alias("start"), (F.col("a") + F.col("n") + (reach - 1)).alias("end"), F.col("row0").alias("from_row"), F.col("a0").alias("from_start"))
    # One group is one text's picks, so it is as long as the text itself.
    asked = seen.where("not covered").groupBy("row").agg(F.collect_list(F.struct("a", "n", "tight")).alias("asks"))
    asked = with_rolled(asked.join(units.select("row", "doc_id", "u"), "row"), reach)
    each = lambda x: F.transform(F.sequence(x["a"], x["a"] + x["n"] - 1), lambda s: F.struct(s.alias("s"), _hash_at(s, reach).alias("sh"), x["tight"].alias("tight")))
    asked = asked.select("row", "doc_id", F.explode(F.flatten(F.transform("asks", each))).alias("y")).select("row", "doc_id", "y.tight", "y.s", "y.sh")
    asked = stored(asked, folder, "stretches")
    first = asked.groupBy("sh").agg(F.min(place("s")).alias("first"), F.count("*").alias("times")).where("times > 1")
    first = first.select("sh", F.col("first.row").alias("row0"), F.col("first.at").alias("s0"))
    single = asked.join(first, "sh").where("not (row = row0 and (s = s0 or tight))")
    single = single.select("row", F.col("s").alias("start"), (F.col("s") + reach).alias("end"), F.col("row0").alias("from_row"), F.col("s0").alias("from_start"))
    return whole.unionByName(single)


def without_repeats(docs: DataFrame, plan: WinnowPlan = WinnowPlan()) -> DataFrame:
    """`docs` with `text` less its repeated runs, and n_runs, removed_words, removed_spans added.

    removed_spans lists start:end code points (end exclusive) in the given text.
    The copy of a passage in the smallest doc_id stays. A text that a smaller
    doc_id has as a whole is one repeated run if it has `min_words` words, else it
    stays; rows that repeat both id and text are one place and stay alike.
    Null and empty texts stay as they are; rows without id come last. Columns named
    like those added are replaced.
    """
    folder = work_folder(docs.sparkSession)
    own = ("n_runs", "removed_words", "removed_spans")
    keep = [c for c in docs.columns if c not in own]
    text = F.col("text").cast("string")
    pairs = docs.select(F.col("doc_id").alias("doc_id"), text.alias("text"))
    runs = repeated_runs(pairs, plan, folder)
    runs = runs.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("runs"))
    firsts = pairs.where("text is not null").groupBy(text_key(F.col("text")).alias("row")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("times"))
    known = firsts.where("times > 1").join(runs, "row", "full").select("row", "first_id", "runs")
    known = stored(known, folder, "known")
    pack = F.struct(*keep)
    found = docs.select(pack.alias("doc"), text_key(text).alias("row")).join(known, "row", "left")
    whole = F.coalesce(F.col("first_id").isNotNull() & ~F.col("doc.doc_id").eqNullSafe(F.col("first_id")), F.lit(False))
    body = F.col("doc.text").cast("string")
    found = found.select("doc", "runs", whole.alias("whole"), body.alias("body"))
    n_words = lambda x: F.regexp_count(x, F.lit(WORD))
    parts = F.when(F.col("runs").isNotNull() & ~F.col("whole"), lines(F.col("body")))
    found = evaluated_once(found.withColumn("parts", parts), "parts")
    found = evaluated_once(found.withColumn("part_words", F.transform("parts", n_words)), "part_words")
    total = lambda r: F.aggregate(F.slice("part_words", r["start"] + 1, r["end"] - r["start"]), F.lit(0), lambda a, x: a + x)
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    # Sorted runs that overlap or touch become one.
    joined = F.aggregate(
        "runs", nothing,
        lambda a, r: F.when((F.size(a) > 0) & (F.element_at(a, -1)["end"] >= r["start"]), F.concat(
            F.slice(a, 1, F.size(a) - 1),
            F.array(F.struct(F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], r["end"]).alias("end"))),
        )).otherwise(F.concat(a, F.array(F.struct(r["start"].alias("start"), r["end"].alias("end"))))),
    )
    found = evaluated_once(found.withColumn("cut", F.when(F.col("parts").isNotNull(), joined)), "cut")
    # What counts is the run that all earlier places cover together.
    held = lambda r: F.char_length(F.array_join(F.slice("parts", r["start"] + 1, r["end"] - r["start"]), ""))
    found = evaluated_once(found.withColumn("cut", F.filter("cut", lambda r: (total(r) >= plan.min_words) & ((F.lit(plan.min_chars) <= 0) | (held(r) >= plan.min_chars)))), "cut")
    chars = lambda a, b: F.char_length(F.array_join(F.slice("parts", a + 1, b - a), ""))
    spans = F.transform("cut", lambda r: F.struct(chars(F.lit(0), r["start"]).alias("a"), chars(F.lit(0), r["end"]).alias("b"), total(r).cast("long").alias("n")))
    copy = F.when(F.col("whole") & (n_words(F.col("body")) >= plan.min_words), F.array(F.struct(F.lit(0).alias("a"), F.char_length("body").alias("b"), n_words(F.col("body")).cast("long").alias("n"))))
    empty = F.array().cast("array<struct<a:int,b:int,n:bigint>>")
    found = evaluated_once(found.withColumn("spans", F.coalesce(F.when(F.col("whole"), copy).otherwise(spans), empty)), "spans")
    gap = lambda i: F.substring(F.col("body"), F.get("spans", i - 1)["b"] + 1, F.get("spans", i)["a"] - F.get("spans", i - 1)["b"])
    left = F.concat(
        F.substring(F.col("body"), F.lit(1), F.get("spans", F.lit(0))["a"]),
        F.array_join(F.transform(F.sequence(F.lit(1), F.size("spans") - 1), gap), ""),
        F.substring(F.col("body"), F.element_at("spans", -1)["b"] + 1, F.char_length("body")),
    )
    left = F.when(F.size("spans") == 0, F.col("body")).when(F.size("spans") == 1, F.concat(
        F.substring(F.col("body"), F.lit(1), F.get("spans", F.lit(0))["a"]), F.substring(F.col("body"), F.get("spans", F.lit(0))["b"] + 1, F.char_length("body")),
    )).otherwise(left)
    shown = F.array_join(F.transform("spans", lambda r: F.concat_ws(":", r["a"].cast("string"), r["b"].cast("string"))), ",")
    return found.select(
        *[left.alias(c) if c == "text" else F.col("doc")[c].alias(c) for c in keep], F.size("spans").cast("long").alias("n_runs"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, r: a + r["n"]).alias("removed_words"), shown.alias("removed_spans"),
    )
