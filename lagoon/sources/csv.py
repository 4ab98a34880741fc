"""CSV panels with a declared schema and an explicit check, made by the pass that loads them.

The CSV source reports every field as nullable whatever the declared schema
says, and a blank line parses to a row of nulls.  ``load_csv_panel`` stores the panel
as Parquet and counts rows, unparsable lines and nulls of the required columns while
it does (observed metrics: no second pass, a handful of numbers to the driver).
``read_csv_panel`` is the lazy form; it counts nulls in a job of its own.  Both raise
if any are found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagoon.functions.columns import yes_no_flag
from lagoon.session import scratch_path

# Column layouts of the two CSV inputs of the original workflow.
HOUSEHOLD_SCHEMA = T.StructType([
    T.StructField("Household_ID", T.StringType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Energy_Consumption_kWh", T.DoubleType()),
    T.StructField("Household_Size", T.IntegerType()),
    T.StructField("Avg_Temperature_C", T.DoubleType()),
    T.StructField("Has_AC", T.StringType()),
    T.StructField("Peak_Hours_Usage_kWh", T.DoubleType()),
])

DIAGNOSIS_SCHEMA = T.StructType([
    T.StructField("Age", T.IntegerType()),
    T.StructField("BMI", T.DoubleType()),
    T.StructField("Menstrual_Irregularity", T.IntegerType()),
    T.StructField("Testosterone_Level(ng/dL)", T.DoubleType()),
    T.StructField("Antral_Follicle_Count", T.IntegerType()),
    T.StructField("PCOS_Diagnosis", T.IntegerType()),
])


#: Settings of the caller's session that decide how a CSV parses.
_READ_CONF = ("spark.sql.session.timeZone", "spark.sql.legacy.timeParserPolicy", "spark.sql.csv.parser.columnPruning.enabled")


class NullValuesError(ValueError):
    """Required CSV columns hold nulls (blank lines, unparsable values)."""


def null_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    row = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols]).first()
    return {c: int(row[c] or 0) for c in cols}


def read_csv_panel(spark: SparkSession, path: str, schema: T.StructType, *,
                   date_format: str | None = None, flags: dict[str, str] | None = None,
                   required: Sequence[str] | None = None, check_nulls: bool = True) -> DataFrame:
    """Read a headed CSV with ``schema``; optionally convert yes/no flags and refuse nulls.

    ``flags`` maps a string column to its "yes" spelling; the column becomes
    boolean (anything else, null included, is false).  ``required``
    defaults to every schema column.
    """
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    if date_format:
        reader = reader.option("dateFormat", date_format)
    df = reader.csv(path)
    if check_nulls:
        cols = list(required) if required is not None else [f.name for f in schema.fields]
        bad = {c: n for c, n in null_counts(df, cols).items() if n}
        if bad:
            raise NullValuesError(f"Null values in required columns: {bad}")
    for c, yes in (flags or {}).items():
        df = df.withColumn(c, yes_no_flag(c, yes))
    return df


class BadLinesError(ValueError):
    """CSV lines that do not parse under the declared schema."""


def load_csv_panel(spark: SparkSession, path: str, schema: T.StructType, *, date_format: str | None = None,
                   flags: dict[str, str] | None = None, required: Sequence[str] | None = None, strict: bool = True,
                   to: str | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Load a headed CSV into Parquet; the panel and ``{rows, bad_lines, null_<column>..}``, counted on the way.

    ``strict`` raises ``BadLinesError`` for unparsable lines and ``NullValuesError`` for nulls in
    ``required`` (default: every column), and names the counts; the Parquet copy is then left as it is.
    """
    corrupt = "_corrupt_record"
    # Once a session has observed metrics it no longer serializes, which later ML stages need; so a sibling session loads.
    side = spark.newSession()
    for k in _READ_CONF:
        side.conf.set(k, spark.conf.get(k))
    reader = (side.read.schema(T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]))
              .option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt))
    if date_format:
        reader = reader.option("dateFormat", date_format)
    cols = list(required) if required is not None else [f.name for f in schema.fields]
    seen = Observation()
    # Columns are named by position in the metrics: any column name will do.
    df = reader.csv(path).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count(F.col(corrupt)).alias("bad_lines"),
        *[F.count_if(F.col(f"`{c}`").isNull() & F.col(corrupt).isNull()).alias(f"null_{i}") for i, c in enumerate(cols)])
    for c, yes in (flags or {}).items():
        df = df.withColumn(c, yes_no_flag(c, yes))
    to = to or scratch_path(spark, "csv-panel")
    df.drop(corrupt).write.mode("overwrite").parquet(to)
    got = {"rows": seen.get["rows"], "bad_lines": seen.get["bad_lines"], **{f"null_{c}": seen.get[f"null_{i}"] for i, c in enumerate(cols)}}
    if strict and got["bad_lines"]:
        raise BadLinesError(f"{got['bad_lines']} of {got['rows']} lines do not parse")
    if strict and any(n for k, n in got.items() if k.startswith("null_")):
        raise NullValuesError(f"Null values in required columns: { {k[5:]: n for k, n in got.items() if k.startswith('null_') and n} }")
    return spark.read.parquet(to), got
