"""Free-form salary grammar: text to (min, max, currency, period, status).

The text is reduced step by step to `[word] AMOUNT [connector AMOUNT]` and must
then match that shape as a whole, so anything not understood ends as `failed`.
A text without numbers is understood if its words, but for nouns such as
`salary`, are one of the known phrases, whatever punctuation stands between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.text import squeeze

# Phrases that carry no number but are understood.
NO_NUMBER_PHRASES = [
    "You'll love it",
    "You'll love it!",
    "You'll surely love it",
    "Very attractive!!!",
    "Attractive",
    "Attractive salary",
    "Attractive package",
    "Highly competitive",
    "Highly competitive salary",
    "Competitive",
    "Competitive package",
    "Competitve",
    "Negotiable",
    "Negotiation",
    "Negotiated",
    "Let's discuss",
    "Thỏa thuận",
    "Thoả thuận",
    "Thỏa thuận theo năng lực",
    "Thương lượng",
    "Allowance provided",
    "Allowance provided.",
    "Monthly support",
]
# Words that never change a number.
IGNORED_WORDS = (
    "gross|net|salary|package|approximately|hoặc|or|theo +năng +lực|"
    "negotiable|negotiation|negotiated|thỏa +thuận|thoả +thuận|thương +lượng"
)
# Ours: what may stand around a phrase; no digit, sign or currency is among them.
PUNCTUATION = ".,;:!?()-'\""
NOUNS = ["gross", "net", "salary", "package"]
MONTH_PATTERN = r"(/ ?month|per month|/ ?tháng|mỗi tháng)"
YEAR_PATTERN = r"(/ ?year|per year|mỗi năm)"
UP_TO_WORDS = "up to|upto|up|đến|tối đa"
FROM_WORDS = "from|từ|ít nhất|tối thiểu"
MILLION_WORDS = "m|triệu|tr"
VND_WORDS = "vnđ|vnd|đồng|đ"
USD_WORDS = r"usd|\$"

_NUMBER = r"[0-9]{1,3}(?:[.,][0-9]{3})+|[0-9]+[.,][0-9]{1,2}|[0-9]+"
# four groups: currency before, number, million word, currency after
_AMOUNT = (
    rf"(?:({USD_WORDS}|{VND_WORDS}) ?)?({_NUMBER})(?: ?({MILLION_WORDS}))?"
    rf"(?: ?({USD_WORDS}|{VND_WORDS}))?"
)
SHAPE = (
    rf"^(?:({UP_TO_WORDS}|{FROM_WORDS}) )?{_AMOUNT}"
    rf"(?: ?(?:-|đến|to) ?(?:(?:{UP_TO_WORDS}) )?{_AMOUNT})?$"
)
GROUPS = ["word", "pre1", "num1", "mil1", "post1", "pre2", "num2", "mil2", "post2"]


def _plain(text: Column) -> Column:
    """Lower case, one kind of dash and apostrophe, single spaces."""
    return squeeze(F.translate(F.lower(text), "–—’", "--'"))


def _phrase_key(text: Column) -> Column:
    """The text's words without punctuation and without the nouns that only say what it is about."""
    words = F.filter(F.split(F.translate(text, PUNCTUATION, " " * len(PUNCTUATION)), " "), lambda w: (w != "") & ~w.isin(NOUNS))
    return F.array_join(words, " ")


def _phrase_keys(phrases: list[str]) -> list[str]:
    blank = str.maketrans(PUNCTUATION, " " * len(PUNCTUATION))
    return sorted({" ".join(w for w in p.lower().translate(blank).split() if w not in NOUNS) for p in phrases})


def _value(number: Column) -> Column:
    grouped = number.rlike(r"^[0-9]{1,3}([.,][0-9]{3})+$")
    # No cast of an empty group: a failed number parse is slow.
    return F.when(grouped, F.translate(number, ".,", "").try_cast("double")).when(
        number != "", F.replace(number, F.lit(","), F.lit(".")).try_cast("double")
    )


def _currency(before: Column, million: Column, after: Column) -> Column:
    """VND, USD, '' when no unit is given, 'conflict' when the units disagree."""
    is_usd = before.rlike(f"^({USD_WORDS})$") | after.rlike(f"^({USD_WORDS})$")
    is_vnd = before.rlike(f"^({VND_WORDS})$") | after.rlike(f"^({VND_WORDS})$") | (million != "")
    return F.when(is_usd & is_vnd, "conflict").when(is_usd, "USD").when(is_vnd, "VND").otherwise("")


def parse_freeform_salary(
    column: str = "salary",
    outputs: tuple[str, str, str, str, str] = ("min_salary", "max_salary", "currency", "period", "parse_status"),
) -> Callable[[DataFrame], DataFrame]:
    """Add the five free-form salary columns."""
    phrases = _phrase_keys(NO_NUMBER_PHRASES)

    def run(df: DataFrame) -> DataFrame:
        kept = df.columns
        df = df.withColumn("_plain", _plain(F.col(column)))
        df = df.withColumn(
            "_period",
            F.when(F.col("_plain").rlike(MONTH_PATTERN), "month").when(F.col("_plain").rlike(YEAR_PATTERN), "year"),
        )
        bare = F.regexp_replace("_plain", f"{MONTH_PATTERN}|{YEAR_PATTERN}", " ")
        bare = F.regexp_replace(F.concat(bare, F.lit(" ")), r"[()]|, ", " ")
        # Every word gets its own two spaces, so neighbouring words can both go.
        spaced = F.concat(F.lit(" "), F.replace(bare, F.lit(" "), F.lit("  ")), F.lit(" "))
        core = squeeze(F.regexp_replace(spaced, f" ({IGNORED_WORDS}) ", " "))
        marks = ";".join(f"${i + 1}" for i in range(len(GROUPS)))
        df = df.withColumn("_parts", F.split(F.regexp_replace(core, SHAPE, marks), ";"))
        df = df.withColumns({f"_{g}": F.get("_parts", F.lit(i)) for i, g in enumerate(GROUPS)})
        df = df.withColumns({
            "_matched": F.size("_parts") == len(GROUPS),
            "_is_range": F.col("_num2") != "",
            "_v1": _value(F.col("_num1")),
            "_v2": _value(F.col("_num2")),
            "_c1": _currency(F.col("_pre1"), F.col("_mil1"), F.col("_post1")),
            "_c2": _currency(F.col("_pre2"), F.col("_mil2"), F.col("_post2")),
        })
        million = F.lit(1_000_000.0)
        unitless = (F.col("_c1") == "") & (~F.col("_is_range") | (F.col("_c2") == ""))
        # A unit given once holds for both ends, unless that end is already in millions.
        own_million = {
            "1": (F.col("_mil1") != "") | ((F.col("_c1") == "") & (F.col("_mil2") != "") & (F.col("_v1") < million)),
            "2": (F.col("_mil2") != "") | ((F.col("_c2") == "") & (F.col("_mil1") != "") & (F.col("_v2") < million)),
        }
        df = df.withColumns({
            "_cur": F.when(F.col("_c1") == "conflict", None)
            .when(F.col("_is_range") & (F.col("_c2") == "conflict"), None)
            .when(
                unitless,
                F.when((F.col("_v1") >= million) & (~F.col("_is_range") | (F.col("_v2") >= million)), "VND"),
            )
            .when(~F.col("_is_range") | (F.col("_c2") == "") | (F.col("_c1") == F.col("_c2")), F.nullif("_c1", F.lit("")))
            .when(F.col("_c1") == "", F.col("_c2")),
            "_a1": F.when(own_million["1"], F.col("_v1") * million).otherwise(F.col("_v1")),
            "_a2": F.when(own_million["2"], F.col("_v2") * million).otherwise(F.col("_v2")),
        })
        # 'up to 20m - 30m' states two maxima; only 'from' may open a range.
        up_to = F.col("_word").rlike(f"^({UP_TO_WORDS})$")
        from_ = F.col("_word").rlike(f"^({FROM_WORDS})$")
        usable = (
            F.col("_matched") & F.col("_cur").isNotNull()
            & (~F.col("_is_range") | (~up_to & (F.col("_a1") <= F.col("_a2"))))
        )
        df = df.withColumn("_usable", F.coalesce(usable, F.lit(False)))
        phrase = F.coalesce(_phrase_key(F.col("_plain")).isin(phrases), F.lit(False))
        values = [
            F.when(F.col("_usable") & ~(up_to & ~F.col("_is_range")), F.col("_a1")),
            F.when(F.col("_usable") & F.col("_is_range"), F.col("_a2"))
            .when(F.col("_usable") & ~from_, F.col("_a1")),
            F.when(F.col("_usable"), F.col("_cur")),
            F.when(F.col("_usable"), F.col("_period")),
            F.when(F.col("_usable") | phrase, "success").otherwise("failed"),
        ]
        return df.select(*kept, *[v.alias(n) for v, n in zip(values, outputs)])

    return run
