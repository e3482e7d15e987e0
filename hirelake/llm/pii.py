"""Personal data by weak supervision, with DataFrame functions only.

Candidate spans come from strict and looser patterns, and from runs that may be keys or tokens. Labelers (form, gazetteer,
context, surroundings, layout) vote on each; expectation-maximisation over the
counts of vote patterns estimates how reliable each labeler is for each kind, and
the resulting soft labels train a naive Bayes classifier on the spans' features.
Spans that meet the base rules always stay; the classifier adds others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.stored import stored, work_folder
from hirelake.operators.stages import evaluated_once

KINDS = ["email", "ip", "card", "phone"]
# Kinds beyond the base rules: all their spans are the method's. They come after the base kinds in order.
MORE_KINDS = ["secret"]
# The base patterns, written so that one search over a text takes linear time: no
# repetition gives back, and a run is tried from its first character (or where the
# last match ended) only, as the leftmost match begins there anyway.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser forms of the same kinds.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20at\x20|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9-]++(?:(?:\x20dot\x20|\.)[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9.(])(?<!\+[0-9]{1,3}[\x20.-]{0,1})\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    # Keys, tokens and hashes: unbroken runs of letters, digits, _ and -; which of them have digits enough is asked afterwards.
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+",
}
# Gazetteers of top-level domains, card issuers' first digits, and country codes.
DOMAINS = ["com", "org", "net", "edu", "gov", "info", "io", "co", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at"]
ISSUERS = ["4", "51", "52", "53", "54", "55", "34", "37", "35", "36", "38", "60", "62", "64", "65"]
COUNTRIES = ["1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "86", "91"]
# Words before a span that speak for and against each kind.
FOR = {
    "email": r"mail|contact|write|correo|courriel", "ip": r"\bip\b|host|server|address|adresse|from",
    "card": r"card|visa|credit|karte|carte|tarjeta|pay", "phone": r"phone|call|tel|fax|mobile|contact|handy",
    "secret": r"token|secret|passw|api.?key|access.?key|private.?key|auth|bearer|credential|\bpwd\b",
}
AGAINST = r"version|\bv\.?$|isbn|sha|token|key|serial|invoice|order|password|license|build|#$|="
# What stands before hashes and ids that are no secret.
AGAINST_SECRET = r"sha-?[0-9]|md5|commit|checksum|digest|\brev|uuid|\bid\b|https?:|/$|isbn|version"
# First characters of tokens of well-known issuers.
PREFIXES = ["ghp_", "gho_", "sk-", "pk-", "sk_", "pk_", "xoxb-", "xoxp-", "AKIA", "AIza", "eyJ", "glpat-"]


@dataclass(frozen=True)
class PiiPlan:
    """`context` characters on each side are read; `accept` is the classifier's least probability."""

    context: int = 32
    rounds: int = 25
    accept: float = 0.8


@dataclass(frozen=True)
class PiiModel:
    """Per kind: prior, (P(vote 1 | true), P(vote 1 | false)) of each labeler, and the
    log-odds of (feature, value); all of fixed size."""

    prior: dict[str, float]
    reliability: dict[str, list[tuple[float, float]]]
    weights: dict[tuple[str, int, str], float]
    bias: dict[str, float]


LABELERS = 5
FEATURES = 5


def let(value: Column, use) -> Column:
    """`use` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def meets_base(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda x: let(F.ltrim(x, F.lit("0")), lambda y: (F.length(y) <= 3) & (F.coalesce(y.try_cast("int"), F.lit(0)) <= 255)))
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def plausible(kind: str, m: Column) -> Column:
    """Whether a match is long enough to be of its kind at all; others are no candidates."""
    if kind == "card":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(12, 19)
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(7, 15)
    if kind == "secret":
        return m.rlike("[A-Za-z]") & (F.length(F.regexp_replace(m, "[^0-9]", "")) >= 4)
    return F.lit(True)


def _votes(kind: str, m: Column, before: Column, after: Column, base: Column) -> list[Column]:
    """Each labeler's 1, 0 or -1 (abstains)."""
    if kind == "secret":
        return _secret_votes(m, before, after)
    digits = F.regexp_replace(m, "[^0-9]", "")
    yes = lambda c: F.when(c, 1).otherwise(0)
    known = {
        "email": F.regexp_extract(m, r"([A-Za-z]+)$", 1).isin(DOMAINS),
        "ip": ~m.rlike(r"^0*(0|127|255)\."),
        "card": F.substring(digits, 1, 2).isin(ISSUERS) | F.substring(digits, 1, 1).isin([x for x in ISSUERS if len(x) == 1]),
        "phone": F.regexp_extract(m, r"^\+([0-9]{1,2})", 1).isin(COUNTRIES) | F.regexp_extract(m, r"^\+([0-9])", 1).isin(COUNTRIES) | m.rlike(r"^\(?[2-9]"),
    }[kind]
    layout = {
        "email": m.rlike(r"^[A-Za-z0-9]"), "ip": m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"),
        "card": m.rlike(r"^([0-9]{13,16}|[0-9]{4}([ -][0-9]{4}){3}|3[0-9]{3}[ -][0-9]{6}[ -][0-9]{5})$"), "phone": m.rlike(r"[ ().-]"),
    }[kind]
    context = F.when(before.rlike("(?i)" + AGAINST), 0).when(before.rlike("(?i)" + FOR[kind]), 1).otherwise(-1)
    alone = ~before.rlike(r"[\p{L}0-9_]$") & ~after.rlike(r"^[\p{L}0-9_]")
    return [yes(base), yes(known), context, yes(alone), yes(layout)]


def _secret_votes(m: Column, before: Column, after: Column) -> list[Column]:
    """The same labelers for keys and tokens: form, issuers' prefixes, context, surroundings, layout."""
    yes = lambda c: F.when(c, 1).otherwise(0)
    form = m.rlike(r"^([0-9a-f]{32,}|[0-9A-F]{32,})$") | m.rlike(r"[0-9][A-Za-z]+[0-9]+[A-Za-z]+[0-9]")
    known = F.when(F.reduce(F.array(*map(F.lit, PREFIXES)), F.lit(False), lambda a, x: a | F.startswith(m, x)), 1).when(m.rlike("^[0-9A-Fa-f]+$"), -1).otherwise(0)
    context = F.when(before.rlike("(?i)" + FOR["secret"]), 1).when(before.rlike("(?i)" + AGAINST_SECRET), 0).otherwise(-1)
    assigned = before.rlike(r"[=:]\s*[\"'`]?$") | (before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]"))
    layout = ~m.rlike("[-_]{2}|^[-_]|[-_]$") & ~m.rlike("^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-") & ~m.rlike("[A-Za-z]{12}")
    return [yes(form), known, context, yes(assigned), yes(layout)]


def _features(m: Column, before: Column, after: Column, loose: bool) -> list[Column]:
    side = lambda c, p: F.when(c.rlike(p % r"\p{L}"), "letter").when(c.rlike(p % "[0-9]"), "digit").when(c.rlike(p % r"\s"), "blank").when(c == "", "edge").otherwise("mark")
    return [
        F.least(F.length(m) / 4, F.lit(12)).cast("int").cast("string"), F.least(F.length(F.regexp_replace(m, "[^0-9]", "")), F.lit(24)).cast("string"),
        side(before, "%s$"), side(after, "^%s"), F.lit("loose" if loose else "strict"),
    ]


def _located(df: DataFrame, found: dict[str, tuple[str, Column, str, bool]], context: int) -> DataFrame:
    """Add, per pattern, <name>_c: (match, start, before, after) of all its matches, in time linear in their number.

    A search gives the matches, a split the text between them; places are running
    sums of both lengths, in chunks of 256 so that no long list is copied for each step.
    """
    text = F.col("text")
    for name, (_, gate, pattern, _) in found.items():
        df = df.withColumn(f"{name}_m", F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
        df = df.withColumn(f"{name}_s", F.when(gate, F.split(text, pattern, -1)))
    df = evaluated_once(df, *[f"{n}{x}" for n in found for x in ("_m", "_s")]).drop("text")
    for step in (_measured, _offsets, _places):
        for name in found:
            df = step(df, name, context)
        df = evaluated_once(df, *[f"{n}{step.suffix}" for n in found])
    for name in found:
        df = _assembled(df, name)
    return df.drop(*[f"{n}{x}" for n in found for x in ("_m", "_s", "_e", "_o", "_p")])


CHUNK = 256


def _measured(df: DataFrame, name: str, context: int) -> DataFrame:
    m, s = F.col(f"{name}_m"), F.col(f"{name}_s")
    each = F.transform(m, lambda x, i: F.struct(
        x.alias("m"), F.char_length(F.get(s, i)).alias("gap"), F.char_length(x).alias("len"),
        F.right(F.get(s, i), F.lit(context)).alias("before"), F.left(F.get(s, i + 1), F.lit(context)).alias("after"),
    ))
    return df.withColumn(f"{name}_e", F.when(F.size(m) > 0, each))


def _part(e: Column, c: Column) -> Column:
    return F.slice(e, c * CHUNK + 1, CHUNK)


def _offsets(df: DataFrame, name: str, _: int) -> DataFrame:
    e = F.col(f"{name}_e")
    chunks = F.sequence(F.lit(0), F.floor((F.size(e) - 1) / CHUNK).cast("int"))
    sums = F.transform(chunks, lambda c: F.aggregate(_part(e, c), F.lit(0), lambda a, x: a + x["gap"] + x["len"]))
    return df.withColumn(f"{name}_o", F.when(e.isNotNull(), F.aggregate(sums, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))))


def _places(df: DataFrame, name: str, _: int) -> DataFrame:
    e, o = F.col(f"{name}_e"), F.col(f"{name}_o")

    def starts(c: Column) -> Column:
        first = F.struct(F.get(o, c).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(_part(e, c), first, lambda a, x: F.struct(
            (a["at"] + x["gap"] + x["len"]).alias("at"), F.concat(a["out"], F.array(a["at"] + x["gap"])).alias("out")), lambda a: a["out"])

    return df.withColumn(f"{name}_p", F.when(e.isNotNull(), F.flatten(F.transform(F.sequence(F.lit(0), F.size(o) - 2), starts))))


_measured.suffix, _offsets.suffix, _places.suffix = "_e", "_o", "_p"


def _assembled(df: DataFrame, name: str) -> DataFrame:
    p = F.col(f"{name}_p")
    return df.withColumn(f"{name}_c", F.transform(F.col(f"{name}_e"), lambda x, i: F.struct(
        x["m"].alias("m"), F.get(p, i).alias("start"), (F.get(p, i) + x["len"]).alias("end"), x["before"].alias("before"), x["after"].alias("after"))))


def candidates(docs: DataFrame, plan: PiiPlan = PiiPlan()) -> DataFrame:
    """(doc_id, c): all candidate spans of each row as (kind, start, end, base, votes, features)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select("doc_id", text.alias("text"))
    digit, has = F.col("text").rlike("[0-9]"), lambda x: F.contains(F.col("text"), F.lit(x))
    df = evaluated_once(df.withColumn("digit", digit), "digit")
    gates = {"email": has("@"), "ip": F.col("digit") & has("."), "card": F.col("digit"), "phone": has("+")}
    secret = F.col("digit") & F.col("text").rlike(r"[A-Za-z0-9_-]{20}")
    loose = {"secret": secret, "email": has("[at]") | has("(at)") | (has(" at ") & (has(".") | has(" dot "))), "phone": F.col("digit")}
    found = {k: (k, gates[k], BASE[k], False) for k in KINDS} | {f"loose_{k}": (k, loose[k], LOOSE[k], True) for k in LOOSE}
    df = _located(df, found, plan.context).drop("digit")

    def span(kind: str, is_loose: bool):
        def make(x: Column) -> Column:
            base = F.lit(False) if is_loose else F.coalesce(meets_base(kind, x["m"]), F.lit(False))
            return F.struct(
                F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), base.alias("base"),
                F.array(*_votes(kind, x["m"], x["before"], x["after"], base)).alias("votes"), F.array(*_features(x["m"], x["before"], x["after"], is_loose)).alias("features"),
            )
        return make

    def fits(kind: str):
        return lambda x: plausible(kind, x["m"])

    none = "array<struct<kind:string,start:int,end:int,base:boolean,votes:array<int>,features:array<string>>>"
    parts = [F.coalesce(F.transform(F.filter(f"{n}_c", fits(k)), span(k, is_loose)).cast(none), F.array().cast(none)) for n, (k, _, _, is_loose) in found.items()]
    return df.select("doc_id", F.concat(*parts).alias("c"))


def reliabilities(patterns: DataFrame, rounds: int) -> DataFrame:
    """(kind, prior, yes, no) by expectation-maximisation over (kind, votes, n).

    At most 3^5 vote patterns a kind exist, however many spans. Start: labelers
    are right in 0.8 of their votes. Small pseudo-counts keep rates inside 0 and 1.
    """
    rows = patterns.groupBy("kind").agg(F.collect_list(F.struct("votes", "n")).alias("ps"))
    idx = F.array(*[F.lit(i) for i in range(LABELERS)])
    fill = lambda x: F.array(*[F.lit(x)] * LABELERS)
    start = F.struct(F.lit(0.5).alias("prior"), fill(0.8).alias("yes"), fill(0.2).alias("no"))

    def posterior(p: Column, at: Column) -> Column:
        def odds(total: Column, i: Column) -> Column:
            v, y, n = F.get(p["votes"], i), F.get(at["yes"], i), F.get(at["no"], i)
            return total + F.when(v == 1, F.log(y / n)).when(v == 0, F.log((1 - y) / (1 - n))).otherwise(0.0)
        z = F.aggregate(idx, F.log(at["prior"] / (1 - at["prior"])), odds)
        return 1 / (1 + F.exp(-z))

    def step(at: Column, _: Column) -> Column:
        soft = F.transform("ps", lambda p: F.struct(p["votes"].alias("votes"), p["n"].cast("double").alias("n"), posterior(p, at).alias("q")))

        def update(ps: Column) -> Column:
            total = lambda f: F.aggregate(ps, F.lit(0.0), lambda a, p: a + f(p))
            rate = lambda i, w: (total(lambda p: F.when(F.get(p["votes"], i) == 1, w(p)).otherwise(0.0)), total(lambda p: F.when(F.get(p["votes"], i) >= 0, w(p)).otherwise(0.0)))
            def smoothed(i: Column, w, hits: float, of: float) -> Column:
                a, b = rate(i, w)
                return (a + hits) / (b + of)
            return F.struct(
                ((total(lambda p: p["n"] * p["q"]) + 1) / (total(lambda p: p["n"]) + 2)).alias("prior"),
                F.transform(idx, lambda i: smoothed(i, lambda p: p["n"] * p["q"], 1.6, 2.0)).alias("yes"),
                F.transform(idx, lambda i: smoothed(i, lambda p: p["n"] * (1 - p["q"]), 0.4, 2.0)).alias("no"),
            )

        return let(soft, update)

    fitted = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)
    return rows.select("kind", fitted.alias("p")).select("kind", "p.*")


def fit(found: DataFrame, plan: PiiPlan = PiiPlan()) -> PiiModel:
    """Reliabilities, then the classifier's log-odds from soft labels; both from grouped counts over all spans."""
    spans = found.select(F.explode("c").alias("x")).select("x.*")
    rel = reliabilities(spans.groupBy("kind", "votes").agg(F.count("*").alias("n")), plan.rounds).collect()
    prior = {r.kind: r.prior for r in rel}
    pairs = {r.kind: list(zip(r.yes, r.no)) for r in rel}
    if not rel:
        return PiiModel({}, {}, {}, {})
    labelled = spans.groupBy("kind", "votes", "features").agg(F.count("*").alias("n")).withColumn("q", soft_label(prior, pairs))
    tidy = labelled.select("kind", "n", "q", F.posexplode("features").alias("f", "value"))
    sums = tidy.groupBy("kind", "f", "value").agg(F.sum(F.col("n") * F.col("q")).alias("yes"), F.sum(F.col("n") * (1 - F.col("q"))).alias("no")).collect()
    # One row a kind, feature and value: at most a few hundred.
    total = {k: (sum(r.yes for r in sums if r.kind == k and r.f == 0), sum(r.no for r in sums if r.kind == k and r.f == 0)) for k in prior}
    from math import log

    values = {(r.kind, r.f): 0 for r in sums}
    for r in sums:
        values[r.kind, r.f] += 1
    weights = {}
    for r in sums:
        y, n = total[r.kind]
        v = values[r.kind, r.f]
        weights[r.kind, r.f, r.value] = log((r.yes + 0.5) / (y + 0.5 * v)) - log((r.no + 0.5) / (n + 0.5 * v))
    return PiiModel(prior, pairs, weights, {k: log((y + 1) / (n + 1)) for k, (y, n) in total.items()})


def soft_label(prior: dict[str, float], pairs: dict[str, list[tuple[float, float]]]) -> Column:
    """P(personal | votes) by the estimated reliabilities."""
    from math import log

    z = F.lit(0.0)
    for kind, rates in pairs.items():
        s = F.lit(log(prior[kind] / (1 - prior[kind])))
        for i, (y, n) in enumerate(rates):
            v = F.get("votes", F.lit(i))
            s = s + F.when(v == 1, log(y / n)).when(v == 0, log((1 - y) / (1 - n))).otherwise(0.0)
        z = F.when(F.col("kind") == kind, s).otherwise(z)
    return 1 / (1 + F.exp(-z))


def probability(x: Column, model: PiiModel) -> Column:
    """The classifier's probability for a candidate struct; values never seen weigh nothing."""
    keys = [f"{k}/{f}/{v}" for k, f, v in model.weights]
    if not keys:
        return F.lit(0.0)
    table = F.map_from_arrays(F.array(*map(F.lit, keys)), F.array(*map(F.lit, model.weights.values())))
    bias = F.coalesce(*[F.when(x["kind"] == k, F.lit(b)) for k, b in model.bias.items()], F.lit(0.0))
    z = bias
    for f in range(FEATURES):
        z = z + F.coalesce(F.try_element_at(table, F.concat(x["kind"], F.lit(f"/{f}/"), F.get(x["features"], F.lit(f)))), F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def _joined(spans: Column) -> Column:
    order = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS + MORE_KINDS)), x["kind"]).alias("k"), x["end"].alias("end"), x["kind"].alias("kind"))))
    return F.array_join(F.transform(order, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def find(docs: DataFrame, plan: PiiPlan = PiiPlan()) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_secret) for every row.

    Counts and hash are of the base spans; spans adds those that only the
    classifier accepts: looser forms of the base kinds, and spans of MORE_KINDS (keys and
    tokens), n_secret of them. A null text is an empty one; rows that repeat an id get
    a row each; columns other than doc_id and text are not read.
    """
    folder = work_folder(docs.sparkSession)
    found = stored(candidates(docs, plan), folder, "candidates")
    model = fit(found, plan)
    base = F.filter("c", lambda x: x["base"])
    added = F.filter("c", lambda x: ~x["base"] & (probability(x, model) >= plan.accept))
    out = evaluated_once(found.select("doc_id", base.alias("base"), added.alias("added")), "base", "added")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"),
        F.size(F.filter("added", lambda x: x["kind"] == "secret")).cast("long").alias("n_secret"),
    )
