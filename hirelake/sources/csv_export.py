"""CSV export of board A rows: fixed columns, arrays as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.schemas import RAW_A

COLUMNS = RAW_A.fieldNames()
ARRAYS = [f.name for f in RAW_A if isinstance(f.dataType, T.ArrayType)]
_DIALECT = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "emptyValue": "", "nullValue": ""}
_MARK = "\ufeff"  # byte-order mark; leads each file when put before the first header


#: Rows of a part file. A file with line breaks in its values is read by one task, so files stay small however few tasks write.
FILE_ROWS = 100_000


def write_csv(df: DataFrame, path: str, byte_order_mark: bool = True, file_rows: int = FILE_ROWS) -> None:
    """Write the export columns in order, `file_rows` rows a file at most; other columns are ignored."""
    empty = F.array().cast("array<string>")
    columns = [F.to_json(F.coalesce(c, empty)).alias(c) if c in ARRAYS else F.col(c) for c in COLUMNS]
    out = df.select(*columns)
    if byte_order_mark:
        out = out.withColumnRenamed(COLUMNS[0], _MARK + COLUMNS[0])
    # Whitespace belongs to the values.
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    out.write.options(**_DIALECT, **keep, maxRecordsPerFile=file_rows).csv(path)


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Read an export back to the typed raw schema.

    `multi_line` keeps values with line breaks whole, and lets Spark read a file in one
    task only; turn it off for large files whose values are known to hold none.
    """
    text = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
    rows = spark.read.options(**_DIALECT, enforceSchema=True, multiLine=multi_line).schema(text).csv(path)
    typed = {
        f.name: F.from_json(f.name, "array<string>") if f.name in ARRAYS
        else F.col(f.name).try_cast("bigint") if isinstance(f.dataType, T.LongType)
        else F.coalesce(f.name, F.lit(""))
        for f in RAW_A
    }
    return rows.select(*[c.alias(n) for n, c in typed.items()])
