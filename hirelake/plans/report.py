"""Report text from the aggregate tables, built as one DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Texts, headings and list sizes of the report.
NO_DATA = "Không có dữ liệu"
TITLE = "📊 **BÁO CÁO TUYỂN DỤNG IT — {date}**"
JOBS_HEADING = "🆕 [Data Engineer] Tổng số tin tuyển dụng: "
SKILLS_HEADING = "🛠️ [Data Engineer] Top kỹ năng được yêu cầu nhiều nhất:"
SENIORITY_HEADING = "🧑‍💼 [Toàn ngành IT] Phân bố theo cấp bậc:"
SALARY_HEADING = "💰 [Toàn ngành IT] Lương trung bình (VNĐ): "
CITY_HEADING = "📍 [Toàn ngành IT] Top 5 thành phố nhiều tin tuyển dụng nhất:"
DATA_ROLE_HEADING = "📈 [Toàn ngành IT] Top vị trí liên quan Data (theo số tin & KN trung bình):"
TREND_HEADING = "🔥 [Toàn ngành IT] Xu hướng tuyển dụng theo vị trí:"
SKILL_ROWS, CITY_ROWS, DATA_ROLE_ROWS, TREND_ROWS = 10, 5, 10, 10


def top(df: DataFrame, count: str, label: str, k: int | None = None) -> DataFrame:
    """Rows by count, ties by label; all of them when `k` is None."""
    ordered = df.orderBy(F.desc(count), F.asc(label))
    return ordered if k is None else ordered.limit(k)


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("None"))


def numbered(rank: Column, label: Column, rest: Column) -> Column:
    return F.concat(rank.cast("string"), F.lit(". "), _text(label), F.lit(" — "), rest)


def lines(df: DataFrame, count: str, label: str, line) -> DataFrame:
    """One row, column `text`: the formatted rows by rank, or the no-data text.

    For short lists (top-k results, enum groups): they end in a single string.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.orderBy(F.desc(count), F.asc(label))))
    each = ranked.select(F.struct("_rank", line(F.col("_rank")).alias("line")).alias("l"))
    listed = F.transform(F.array_sort(F.collect_list("l")), lambda l: l["line"])
    return each.agg(F.coalesce(F.nullif(F.array_join(listed, "\n"), F.lit("")), F.lit(NO_DATA)).alias("text"))


def jobs_suffix(count: Column) -> Column:
    return F.concat(count.cast("string"), F.lit(" tin"))


def skill_lines(skills: DataFrame) -> DataFrame:
    return lines(top(skills, "job_count", "skill", SKILL_ROWS), "job_count", "skill",
                 lambda i: numbered(i, F.col("skill"), jobs_suffix(F.col("job_count"))))


def seniority_lines(levels: DataFrame) -> DataFrame:
    return lines(top(levels, "total_jobs", "seniority"), "total_jobs", "seniority",
                 lambda i: F.concat(F.lit("• "), _text(F.col("seniority")), F.lit(": "), jobs_suffix(F.col("total_jobs"))))


def city_lines(cities: DataFrame) -> DataFrame:
    return lines(top(cities, "TongCongViec", "city", CITY_ROWS), "TongCongViec", "city",
                 lambda i: numbered(i, F.col("city"), jobs_suffix(F.col("TongCongViec"))))


def data_role_lines(roles: DataFrame) -> DataFrame:
    def line(i: Column) -> Column:
        average = F.format_string("%.1f", "avg_experience_years")
        rest = F.concat(jobs_suffix(F.col("total_jobs")), F.lit(" (KN TB: "), average, F.lit(" năm)"))
        return numbered(i, F.col("primary_role"), rest)

    return lines(top(roles, "total_jobs", "primary_role", DATA_ROLE_ROWS), "total_jobs", "primary_role", line)


def trend_lines(trend: DataFrame) -> DataFrame:
    return lines(top(trend, "TongSoTuyenDung", "primary_role", TREND_ROWS), "TongSoTuyenDung", "primary_role",
                 lambda i: numbered(i, F.col("primary_role"), jobs_suffix(F.col("TongSoTuyenDung"))))


def _money(value: Column) -> Column:
    return F.format_number(value, 0)


def _sections(gold: Mapping[str, DataFrame]) -> list[tuple[str, DataFrame]]:
    total = gold["career_data_engineer"].select(
        F.concat(F.lit("**"), F.col("NumberofDataEngineer").cast("string"), F.lit("**")).alias("text")
    )
    salary = gold["Luong_trung_binh_IT"].select(F.coalesce(
        F.concat(F.lit("**"), _money(F.col("LUONG_TRUNG_BINH_MIN")), F.lit(" — "),
                 _money(F.col("LUONG_TRUNG_BINH_MAX")), F.lit("**")),
        F.lit(NO_DATA),
    ).alias("text"))
    return [
        (JOBS_HEADING, total),
        (SKILLS_HEADING + "\n", skill_lines(gold["skil_DE_need"])),
        (SENIORITY_HEADING + "\n", seniority_lines(gold["hiring_seniority"])),
        (SALARY_HEADING, salary),
        (CITY_HEADING + "\n", city_lines(gold["phan_bo_viec_lam"])),
        (DATA_ROLE_HEADING + "\n", data_role_lines(gold["TheMostCVinData"])),
        (TREND_HEADING + "\n", trend_lines(gold["Trend_hiring"])),
    ]


def report_text(gold: Mapping[str, DataFrame], day: dt.date) -> DataFrame:
    """One row, column `report`: seven sections under a dated title.

    Every section is one row by then, so the last aggregate sees seven rows.
    """
    parts = [
        df.select(F.lit(i).alias("n"), F.concat(F.lit(heading), "text").alias("text"))
        for i, (heading, df) in enumerate(_sections(gold))
    ]
    united = reduce(DataFrame.unionByName, parts)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda s: s["text"]), "\n\n")
    title = TITLE.format(date=day.strftime("%d/%m/%Y"))
    return united.agg(F.concat(F.lit(title + "\n\n"), body, F.lit("\n")).alias("report"))
