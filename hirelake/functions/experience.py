"""Experience text to years, and the checks on a years value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.text import squeeze

# The wording of the experience rules.
NOT_REQUIRED = "không yêu cầu"
OVER_WORD = "trên"
UNDER_WORD = "dưới"
LEADING_WORDS = "trên|dưới|từ|ít nhất|tối thiểu"
# word, years, upper years, months
EXPERIENCE_PATTERN = (
    rf"^.*?({LEADING_WORDS})? ?([0-9]+(?:[.,][0-9]+)?) ?"
    r"(?:(?:năm )?(?:-|đến) ?([0-9]+(?:[.,][0-9]+)?) ?năm|năm(?: ([0-9]+) tháng)?).*$"
)


def _number(text: Column) -> Column:
    # No cast of an empty group: a failed number parse is slow.
    return F.when(text != "", F.replace(text, F.lit(","), F.lit(".")).try_cast("double"))


def half_steps(value: Column) -> Column:
    """Nearest multiple of 0.5, ties upwards."""
    return F.floor(value * 2 + 0.5) / F.lit(2.0)


def parse_experience(column: str = "experience", output: str = "experience_years") -> Callable[[DataFrame], DataFrame]:
    """Add the years as a double, null where the wording is not known.

    The text is matched in a projection of its own: every rule below reads the
    four groups, and must not repeat the match.
    """

    def run(df: DataFrame) -> DataFrame:
        kept = df.columns
        plain = F.translate(F.lower(squeeze(F.col(column))), "–—", "--")
        df = df.withColumn("_plain", plain)
        df = df.withColumn("_parts", F.split(F.regexp_replace("_plain", EXPERIENCE_PATTERN, "$1;$2;$3;$4"), ";"))
        word = F.get("_parts", F.lit(0))
        years, upper, months = (_number(F.get("_parts", F.lit(i))) for i in (1, 2, 3))
        df = df.withColumns({"_word": word, "_years": years, "_upper": upper, "_months": months})
        value = (
            F.when(F.col("_plain").contains(NOT_REQUIRED), F.lit(0.0))
            .when(F.size("_parts") != 4, F.lit(None).cast("double"))
            .when(F.col("_upper").isNotNull(), (F.col("_years") + F.col("_upper")) / 2)
            .when(F.col("_months").isNotNull(), half_steps(F.col("_years") + F.col("_months") / 12))
            .when(F.col("_word") == OVER_WORD, F.col("_years") + 0.5)
            .when(F.col("_word") == UNDER_WORD, F.greatest(F.lit(0.0), F.col("_years") - 0.5))
            .otherwise(F.col("_years"))
        )
        return df.select(*kept, value.alias(output))

    return run


def experience_error(years: Column) -> Column:
    """Null for a valid value (or null), else the name of the broken rule."""
    infinite = F.isnan(years) | (F.abs(years) == F.lit(float("inf")))
    return F.when(infinite | (years < 0), "not_finite_or_negative").when(
        F.abs(years * 2 - F.rint(years * 2)) > F.greatest(F.abs(years * 2), F.abs(F.rint(years * 2))) * 1e-9,
        "not_half_step",
    )
