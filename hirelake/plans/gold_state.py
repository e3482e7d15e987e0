"""Aggregate tables kept up to date from the changed rows of the cleaned tables.

Each posting adds a few rows of counts and sums, one per model and key. Added up they
are the state of all models; a changed posting adds its new row's and takes its old row's
away, so a batch costs what it changes and not a scan of the tables. Sums are decimals,
so that taking away leaves exactly what a full computation would have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.text import keyword_match
from hirelake.plans.gold import DATA_ENGINEER_KEYWORDS, TOP_SKILLS, USD_TO_VND
from hirelake.sources.bucketed import BucketedTable
from hirelake.sources.folders import is_committed, names_in, remove

STATE = "model string, key string, n long, jobs long, n_low long, low decimal(38,6), n_high long, high decimal(38,6)"
_MEASURES = ["n", "jobs", "n_low", "low", "n_high", "high"]


def _part(model: str, key: Column, jobs: Column, low: Column | None = None, high: Column | None = None) -> Column:
    low, high = (F.lit(None) if x is None else x for x in (low, high))
    exact = lambda x: F.coalesce(x.try_cast("decimal(38,6)"), F.lit(0).cast("decimal(38,6)"))
    return F.struct(
        F.lit(model).alias("model"), key.cast("string").alias("key"), F.lit(1).cast("long").alias("n"), jobs.isNotNull().cast("long").alias("jobs"),
        low.isNotNull().cast("long").alias("n_low"), exact(low).alias("low"), high.isNotNull().cast("long").alias("n_high"), exact(high).alias("high"),
    )


def parts_a(rows: DataFrame) -> DataFrame:
    """What each posting of board A adds: to the count, and to each of its different skills."""
    job, no_key = F.col("job_id"), F.lit(None)
    wanted = rows.where(keyword_match(F.col("title"), DATA_ENGINEER_KEYWORDS))
    skills = F.transform(F.array_distinct(F.coalesce("skills", F.array().cast("array<string>"))), lambda s: _part("skil_DE_need", s, job))
    return wanted.select("sign", F.inline(F.concat(F.array(_part("career_data_engineer", no_key, job)), skills)))


def parts_b(rows: DataFrame, rate: float = USD_TO_VND) -> DataFrame:
    """What each posting of board B adds: level, salary, city, role."""
    job, role, years = F.col("job_id"), F.col("primary_role"), F.col("experience_years")
    factor = F.when(F.col("salary_currency").contains("USD"), F.lit(float(rate))).when(F.col("salary_currency").contains("VND"), F.lit(1.0))
    parts = F.array(
        F.when(F.col("seniority").isNotNull(), _part("hiring_seniority", F.col("seniority"), job)),
        _part("Luong_trung_binh_IT", F.lit(None), job, F.col("salary_min") * factor, F.col("salary_max") * factor),
        _part("phan_bo_viec_lam", F.col("city"), job),
        F.when(years.isNotNull() & F.lower(role).contains("data"), _part("TheMostCVinData", role, job, years)),
        _part("Trend_hiring", role, role),
    )
    return rows.select("sign", F.inline(F.array_compact(parts)))


PARTS = {"a": parts_a, "b": parts_b}


def added_up(parts: DataFrame) -> DataFrame:
    """One row per model and key. A change may leave a count as it was and move a sum, so rows of count 0 stay."""
    return parts.groupBy("model", "key").agg(*[F.sum(c).cast("decimal(38,6)" if c in ("low", "high") else "long").alias(c) for c in _MEASURES])


def state_of(changes: DataFrame, board: str) -> DataFrame:
    """What rows (sign, columns of the cleaned table) add to the state."""
    parts = PARTS[board](changes)
    return added_up(parts.select("model", "key", *[(F.col(c) * F.col("sign")).alias(c) for c in _MEASURES]))


def advance(table: BucketedTable, folder: str, board: str) -> DataFrame:
    """Bring the stored state up to the table's version and return it.

    A state is stored under the version it describes, so a job that ran before finds it
    done. States go from version to version by the changes; where the table no longer keeps a
    version in between, the state is computed from all rows once.
    """
    spark, folder = table.spark, folder.rstrip("/")
    at = lambda v: f"{folder}/v{v:08d}"
    now = table.current_version() or 0
    done = [int(n[1:]) for n in names_in(spark, folder) if n[1:].isdigit() and is_committed(spark, f"{folder}/{n}")]
    if now in done:
        return spark.read.schema(STATE).parquet(at(now))
    steps = [v for v in table.versions() if v > max(done, default=-1)]
    changed = [table.changes(v) for v in steps] if done else [None]
    follows = bool(done) and all(c is not None for c in changed) and _no_gap(table, max(done), steps)
    if follows:
        state = spark.read.schema(STATE).parquet(at(max(done)))
        for c in changed:
            state = added_up(state.unionByName(state_of(c, board)))
    else:
        state = state_of(table.read().select(F.lit(1).alias("sign"), "*"), board)
    # Left over by a job that was lost while writing it.
    remove(spark, at(now))
    # A key that no posting has any more is no row of any model.
    state.where("n != 0").write.parquet(at(now))
    for v in done:
        if v < max(done):
            remove(spark, at(v))
    return spark.read.schema(STATE).parquet(at(now))


def _no_gap(table: BucketedTable, state_version: int, steps: list[int]) -> bool:
    """Whether the version right before the first step is the one that the state describes."""
    return state_version in table.versions() or (state_version == 0 and steps[:1] == [1])


def tables_from_state(state_a: DataFrame, state_b: DataFrame) -> dict[str, DataFrame]:
    """The seven aggregate tables, with the columns of `gold.build_all`."""
    a, b = (lambda m: state_a.where(F.col("model") == m)), (lambda m: state_b.where(F.col("model") == m))
    mean = lambda total, n: F.when(F.sum(n) > 0, F.sum(total) / F.sum(n)).cast("double")
    years = F.round((F.col("low") / F.col("n_low")).cast("decimal(22,10)"), 1).cast("double")
    return {
        "career_data_engineer": a("career_data_engineer").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("NumberofDataEngineer")),
        "skil_DE_need": a("skil_DE_need").select(F.col("key").alias("skill"), F.col("jobs").alias("job_count"))
        .orderBy(F.desc("job_count"), F.asc("skill")).limit(TOP_SKILLS),
        "hiring_seniority": b("hiring_seniority").select(F.col("key").alias("seniority"), F.col("n").alias("total_jobs")),
        "Luong_trung_binh_IT": b("Luong_trung_binh_IT").agg(
            mean("low", "n_low").alias("LUONG_TRUNG_BINH_MIN"), mean("high", "n_high").alias("LUONG_TRUNG_BINH_MAX")),
        "phan_bo_viec_lam": b("phan_bo_viec_lam").select(F.col("key").alias("city"), F.col("jobs").alias("TongCongViec")),
        "TheMostCVinData": b("TheMostCVinData").select(F.col("key").alias("primary_role"), years.alias("avg_experience_years"), F.col("n").alias("total_jobs")),
        "Trend_hiring": b("Trend_hiring").select(F.col("key").alias("primary_role"), F.col("jobs").alias("TongSoTuyenDung")),
    }
