"""Token grammar for salaries such as '10 - 20 triệu' or 'Tới 2,000 USD'.

The parser is a short chain of native projections: normalise, split, choose
the branch, pick the three tokens it needs, convert. Nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.text import squeeze

# Fixed values.
PARSER_VERSION = "salary_parser_v4"
UNITS = {  # unit: (currency, multiplier)
    "triệu": ("VND", 1_000_000),
    "tr": ("VND", 1_000_000),
    "usd": ("USD", 1),
}
NEGOTIABLE_FIRST_WORDS = ["thoả", "thỏa"]
NEGOTIABLE_SECOND_WORD = "thuận"
UP_TO_WORD = "tới"
FROM_WORD = "từ"
NUMBER_PATTERN = r"^[+]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"

FIELDS = (
    "min_amount", "max_amount", "currency", "period",
    "salary_type", "parse_status", "parser_version", "parse_error",
)


def _amount(text: Column, unit: Column) -> Column:
    digits = F.when(unit == "usd", F.replace(text, F.lit(","), F.lit(""))).otherwise(
        F.replace(text, F.lit(","), F.lit("."))
    )
    return F.when(digits.rlike(NUMBER_PATTERN), digits.try_cast("double"))


def parse_salary(column: str = "salary", output: str = "salary_parsed") -> Callable[[DataFrame], DataFrame]:
    """Add the 8-field salary struct; use as ``df.transform(parse_salary())``."""

    def run(df: DataFrame) -> DataFrame:
        kept = df.columns
        dashes = F.translate(F.lower(F.col(column)), "–—", "--")
        df = df.withColumn("_text", squeeze(F.replace(dashes, F.lit("-"), F.lit(" - "))))
        df = df.withColumn("_tokens", F.split("_text", " "))

        def token(i: int | Column) -> Column:
            return F.get("_tokens", F.lit(i) if isinstance(i, int) else i)

        df = df.withColumns({
            "_n": F.size("_tokens"),
            "_dash": F.array_position("_tokens", "-").cast("int") - 1,
            "_type": F.when(F.col("_text").isNull() | (F.col("_text") == ""), "empty")
            .when(token(0).isin(NEGOTIABLE_FIRST_WORDS) & (token(1) == NEGOTIABLE_SECOND_WORD), "negotiable")
            .when(token(0) == UP_TO_WORD, "maximum")
            .when(token(0) == FROM_WORD, "minimum")
            .when(F.array_contains("_tokens", "-"), "range")
            .otherwise("other"),
        })
        is_range = F.col("_type") == "range"
        df = df.withColumns({
            "_low": F.when(is_range, token(F.col("_dash") - 1)).otherwise(token(1)),
            "_high": F.when(is_range, token(F.col("_dash") + 1)).otherwise(token(1)),
            "_unit": F.when(is_range, token(F.col("_dash") + 2)).otherwise(token(2)),
            "_complete": F.when(is_range, (F.col("_dash") >= 1) & (F.col("_dash") + 2 < F.col("_n")))
            .otherwise(F.col("_n") >= 3),
        })
        currency, factor = F.lit(None).cast("string"), F.lit(None).cast("double")
        for unit, (code, multiplier) in UNITS.items():
            currency = F.when(F.col("_unit") == unit, code).otherwise(currency)
            factor = F.when(F.col("_unit") == unit, F.lit(float(multiplier))).otherwise(factor)
        df = df.withColumns({
            "_currency": currency,
            "_factor": factor,
            "_low": _amount(F.col("_low"), F.col("_unit")),
            "_high": _amount(F.col("_high"), F.col("_unit")),
        })
        has_amount = F.col("_type").isin("maximum", "minimum", "range")
        df = df.withColumn(
            "_error",
            F.when(F.col("_type") == "empty", "empty_salary")
            .when(F.col("_type") == "other", "unsupported_format")
            .when(has_amount & ~F.col("_complete"), "missing_number_or_unit")
            .when(has_amount & F.col("_currency").isNull(), F.concat(F.lit("unsupported_unit:"), "_unit"))
            .when(has_amount & (F.col("_low").isNull() | F.col("_high").isNull()), "invalid_number")
            .when(has_amount & (F.col("_low") > F.col("_high")), "min_greater_than_max"),
        )
        parsed = has_amount & F.col("_error").isNull()
        reversed_range = F.col("_error") == "min_greater_than_max"
        return df.select(
            *kept,
            F.struct(
                F.when(parsed, F.col("_low") * F.col("_factor")).alias("min_amount"),
                F.when(parsed & (F.col("_type") != "minimum"), F.col("_high") * F.col("_factor")).alias("max_amount"),
                F.when(parsed | reversed_range, F.col("_currency")).alias("currency"),
                F.lit(None).cast("string").alias("period"),
                F.when(F.col("_type").isin("empty", "other"), "unknown").otherwise(F.col("_type")).alias("salary_type"),
                F.when(F.col("_error").isNull(), "success").when(reversed_range, "invalid")
                .otherwise("unparsed").alias("parse_status"),
                F.lit(PARSER_VERSION).alias("parser_version"),
                F.col("_error").alias("parse_error"),
            ).alias(output),
        )

    return run


def flatten_salary(struct: str = "salary_parsed", prefix: str = "salary_") -> Callable[[DataFrame], DataFrame]:
    """Replace the struct by eight prefixed columns."""
    names = {
        "min_amount": "min", "max_amount": "max", "currency": "currency", "period": "period",
        "salary_type": "type", "parse_status": "parse_status",
        "parser_version": "parser_version", "parse_error": "parse_error",
    }

    def run(df: DataFrame) -> DataFrame:
        return df.withColumns({prefix + short: F.col(f"{struct}.{f}") for f, short in names.items()}).drop(struct)

    return run
