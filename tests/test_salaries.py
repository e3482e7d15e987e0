import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hirelake.functions.salary_freeform import NO_NUMBER_PHRASES, parse_freeform_salary
from hirelake.functions.salary_token import PARSER_VERSION, flatten_salary, parse_salary
from tests.conftest import plan_of

M = 1_000_000.0
# text: (min, max, currency, type, status, error)
TOKEN_CASES = {
    None: (None, None, None, "unknown", "unparsed", "empty_salary"),
    "   ": (None, None, None, "unknown", "unparsed", "empty_salary"),
    "Thoả thuận": (None, None, None, "negotiable", "success", None),
    "Thỏa  thuận theo năng lực": (None, None, None, "negotiable", "success", None),
    "Thoả": (None, None, None, "unknown", "unparsed", "unsupported_format"),
    "Tới 20 triệu": (20 * M, 20 * M, "VND", "maximum", "success", None),
    "Tới 2,000 USD": (2000.0, 2000.0, "USD", "maximum", "success", None),
    "Tới 20": (None, None, None, "maximum", "unparsed", "missing_number_or_unit"),
    "Tới 20 đồng": (None, None, None, "maximum", "unparsed", "unsupported_unit:đồng"),
    "Tới x triệu": (None, None, None, "maximum", "unparsed", "invalid_number"),
    "Từ 10,5 triệu": (10.5 * M, None, "VND", "minimum", "success", None),
    "Từ 10 - 20 triệu": (None, None, None, "minimum", "unparsed", "unsupported_unit:-"),
    "10 - 20 triệu": (10 * M, 20 * M, "VND", "range", "success", None),
    "10–20 tr": (10 * M, 20 * M, "VND", "range", "success", None),
    "10—20 TRIỆU": (10 * M, 20 * M, "VND", "range", "success", None),
    "lương 10 - 20 triệu net": (10 * M, 20 * M, "VND", "range", "success", None),
    "10 triệu - 20 triệu": (None, None, None, "range", "unparsed", "invalid_number"),
    "1,000 - 2,000 USD": (1000.0, 2000.0, "USD", "range", "success", None),
    "1.500 - 2.500 usd": (1.5, 2.5, "USD", "range", "success", None),
    "60 - 50 triệu": (None, None, "VND", "range", "invalid", "min_greater_than_max"),
    "- 20 triệu": (None, None, None, "range", "unparsed", "missing_number_or_unit"),
    "10 - 20": (None, None, None, "range", "unparsed", "missing_number_or_unit"),
    "10 - 20 triệu/tháng": (None, None, None, "range", "unparsed", "unsupported_unit:triệu/tháng"),
    "20 triệu": (None, None, None, "unknown", "unparsed", "unsupported_format"),
    "trên 20 triệu": (None, None, None, "unknown", "unparsed", "unsupported_format"),
    "nan - 20 triệu": (None, None, None, "range", "unparsed", "invalid_number"),
    "10 - 20　triệu": (10 * M, 20 * M, "VND", "range", "success", None),
}
# text: (min, max, currency, period, status)
FREEFORM_CASES = {
    "800 - 1,500 USD": (800.0, 1500.0, "USD", None, "success"),
    "30,000,000 - 50,000,000đ": (30 * M, 50 * M, "VND", None, "success"),
    "25 triệu – 35 triệu": (25 * M, 35 * M, "VND", None, "success"),
    "35 - 50m": (35 * M, 50 * M, "VND", None, "success"),
    "Up to $2200": (None, 2200.0, "USD", None, "success"),
    "Upto 52m/month": (None, 52 * M, "VND", "month", "success"),
    "From $1300": (1300.0, None, "USD", None, "success"),
    "Từ 20tr đến 40tr /tháng": (20 * M, 40 * M, "VND", "month", "success"),
    "Up to 37,000$ /year": (None, 37000.0, "USD", "year", "success"),
    "Vnd 3.000.000 per month": (3 * M, 3 * M, "VND", "month", "success"),
    "Approximately $230": (230.0, 230.0, "USD", None, "success"),
    "Negotiable (20m – 30m)": (20 * M, 30 * M, "VND", None, "success"),
    "You'll love it": (None, None, None, None, "success"),
    "Thỏa thuận theo năng lực": (None, None, None, None, "success"),
    None: (None, None, None, None, "failed"),
    "": (None, None, None, None, "failed"),
    "35 - 40m, thỏa thuận": (35 * M, 40 * M, "VND", None, "success"),
    "60-90m hoặc thỏa thuận": (60 * M, 90 * M, "VND", None, "success"),
    "30m - up to 50m": (30 * M, 50 * M, "VND", None, "success"),
    "10,000,000": (10 * M, 10 * M, "VND", None, "success"),
    "5.000.000 VNĐ gross": (5 * M, 5 * M, "VND", None, "success"),
    "$2,200": (2200.0, 2200.0, "USD", None, "success"),
    "3.000 USD": (3000.0, 3000.0, "USD", None, "success"),
    "Tối đa 20 triệu": (None, 20 * M, "VND", None, "success"),
    "Tối thiểu 15tr": (15 * M, None, "VND", None, "success"),
    "50m - 30m": (None, None, None, None, "failed"),
    "call 42": (None, None, None, None, "failed"),
    "1000": (None, None, None, None, "failed"),
    "20m - $3000": (None, None, None, None, "failed"),
    "$20m": (None, None, None, None, "failed"),
    "$2k": (None, None, None, None, "failed"),
    "up to 20m - 30m": (None, None, None, None, "failed"),
    "10m 20m 30m": (None, None, None, None, "failed"),
    "Competitive salary": (None, None, None, None, "success"),
    "Salary: negotiable": (None, None, None, None, "success"),
    "Negotiable (gross)": (None, None, None, None, "success"),
    "Attractive salary package!": (None, None, None, None, "success"),
    "salary": (None, None, None, None, "failed"),
    "Not negotiable": (None, None, None, None, "failed"),
    "Negotiable 42": (None, None, None, None, "failed"),
    "1k - 2k USD": (None, None, None, None, "failed"),
}


def test_token_truth_table(spark):
    df = spark.createDataFrame([(t,) for t in TOKEN_CASES], "salary string")
    for r in df.transform(parse_salary()).collect():
        p = r.salary_parsed
        got = (p.min_amount, p.max_amount, p.currency, p.salary_type, p.parse_status, p.parse_error)
        assert got == TOKEN_CASES[r.salary], r.salary
        assert p.period is None and p.parser_version == PARSER_VERSION


def test_flatten_names_eight_columns(spark):
    df = spark.createDataFrame([("x",)], "salary string").transform(parse_salary()).transform(flatten_salary())
    assert df.columns == [
        "salary", "salary_min", "salary_max", "salary_currency", "salary_period", "salary_type",
        "salary_parse_status", "salary_parser_version", "salary_parse_error",
    ]


def test_freeform_cases(spark):
    df = spark.createDataFrame([(t,) for t in FREEFORM_CASES], "salary string").transform(parse_freeform_salary())
    for r in df.collect():
        got = (r.min_salary, r.max_salary, r.currency, r.period, r.parse_status)
        assert got == FREEFORM_CASES[r.salary], r.salary


def test_phrases_without_number_are_understood(spark):
    df = spark.createDataFrame([(t,) for t in NO_NUMBER_PHRASES], "salary string").transform(parse_freeform_salary())
    assert {(r.parse_status, r.min_salary, r.currency) for r in df.collect()} == {("success", None, None)}


@pytest.mark.parametrize("parser", [parse_salary(), parse_freeform_salary()])
def test_no_python_step(spark, parser):
    df = spark.createDataFrame([("10 - 20 triệu",)], "salary string").transform(parser)
    assert not any(w in plan_of(df) for w in ("EvalPython", "InArrow", "InPandas"))


WORDS = st.sampled_from(["10", "20,5", "1.000", "-", "–", "triệu", "tr", "usd", "$", "m", "tới", "từ", "up to", "đ", "/month", "x", "", "9e9"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(WORDS, max_size=6).map(" ".join) | st.text(max_size=20), min_size=20, max_size=60))
def test_any_text_parses_without_error(spark, texts):
    texts = [t.replace("\x00", "") for t in texts if t.isprintable()] or ["1"]
    df = spark.createDataFrame([(t,) for t in texts], "salary string")
    for r in df.transform(parse_salary()).transform(parse_freeform_salary()).collect():
        p = r.salary_parsed
        assert p.parse_status in ("success", "unparsed", "invalid")
        if p.min_amount is not None and p.max_amount is not None:
            assert p.min_amount <= p.max_amount
        if r.min_salary is not None and r.max_salary is not None:
            assert r.min_salary <= r.max_salary
        assert (r.parse_status == "success") or (r.min_salary, r.max_salary, r.currency, r.period) == (None,) * 4
