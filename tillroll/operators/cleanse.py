"""Row-by-row cleaning. Every function here is one projection or filter: no shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import as_money, standard_text
from tillroll.schemas import NULL_TOKENS, REQUIRED_KEYS, SHEET_HEADERS, TEXT_COLUMNS, Table
from tillroll.scratch import Scratch
from tillroll.session import require_strict_casts

FAULTS = "array<struct<column:string,value:string,reason:string>>"
# Full timestamps but for days their month lacks, and texts with a character no number has. Spark's
# casts find such cells by exceptions, which take longer than all the rest.
IN_RANGE = r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])([ T]([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9]([.][0-9]{1,6})?)?)?$"
NEVER_A_NUMBER = r"[\x21-\x2A\x2C\x2F\x3A-\x44\x46-\x64\x66-\x7E]"
CONCURRENT_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
FULL_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$"


def rename_columns(df: DataFrame, mapping: Mapping[str, str] = SHEET_HEADERS) -> DataFrame:
    """The mapped columns under their new names, in mapping order, found by name.

    A missing or unknown column is an error, so a changed sheet never loads into the wrong
    columns.
    """
    missing = [c for c in mapping if c not in df.columns]
    unknown = [c for c in df.columns if c not in mapping]
    if missing or unknown:
        raise ValueError(f"sheet does not match: missing columns {missing}, unknown columns {unknown}")
    return df.select(*(F.col(f"`{old}`").alias(new) for old, new in mapping.items()))


def normalize_nulls(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Cells that hold exactly one of the missing-value texts become NULL.

    Cells of blanks only are kept as they are.
    """
    tokens = list(tokens)
    return df.select(*(F.when(~F.col(c).isin(tokens), F.col(c)).alias(c) for c in df.columns))


def standardize_text(df: DataFrame, cols: Iterable[str] = TEXT_COLUMNS) -> DataFrame:
    return df.withColumns({c: standard_text(c) for c in cols})


def is_full_timestamp(column: str) -> Column:
    """Whether a text is a whole date, with or without a time of day and without a zone.

    Spark's own cast also takes a number for a year, a date without day, and drops a zone.
    """
    return F.col(column).rlike(FULL_TIMESTAMP)


def bad_timestamps(df: DataFrame, column: str) -> DataFrame:
    """Rows with a text that ``cast_strict`` refuses as a timestamp."""
    fits = is_full_timestamp(column) & F.col(column).try_cast("timestamp_ntz").isNotNull()
    return df.filter(F.col(column).isNotNull() & ~fits)


def cast_strict(
    df: DataFrame, types: Mapping[str, str], timestamp_format: str | None = None
) -> DataFrame:
    """Text columns to the given types; one value that does not fit fails the job.

    ``timestamp_format`` reads timestamps written another way than ISO, e.g. ``M/d/yyyy H:mm``.
    """
    require_strict_casts(df.sparkSession)

    def cast(name: str, to: str):
        if to == "decimal(10,2)":
            return as_money(F.col(name))
        if to == "timestamp_ntz" and timestamp_format:
            return F.to_timestamp_ntz(name, F.lit(timestamp_format))
        if to == "timestamp_ntz":
            refused = F.raise_error(
                F.concat(F.lit(f"[CAST_INVALID_INPUT] {name} is no full date: "), F.col(name))
            )
            return F.when(is_full_timestamp(name) | F.col(name).isNull(), F.col(name).cast(to)).otherwise(refused)
        return F.col(name).cast(to)

    return df.withColumns({name: cast(name, to) for name, to in types.items()})


def _cell_fault(name: str, to: str, timestamp_format: str | None) -> Column:
    """Why ``cast_strict`` refuses a cell; null if it takes it."""
    cell = F.col(name)
    if to == "timestamp_ntz" and timestamp_format:
        fits, fault = F.try_to_timestamp(cell, F.lit(timestamp_format)).isNotNull(), F.lit(f"not of the form {timestamp_format}")
    elif to == "timestamp_ntz":
        fits = cell.rlike(IN_RANGE) & cell.try_cast(to).isNotNull()
        fault = F.when(is_full_timestamp(name), "no such date or time").otherwise("no full date")
    elif to.startswith("decimal"):
        wide = "decimal(12,2)" if to == "decimal(10,2)" else to
        odd = cell.rlike(NEVER_A_NUMBER)
        fits = ~odd & cell.try_cast(wide).try_cast(to).isNotNull()
        fault = F.when(~odd & cell.try_cast("decimal(38,2)").isNotNull(), "out of range").otherwise("no number")
    else:
        fits = cell.try_cast(to).isNotNull()
        fault = F.when(cell.rlike(r"^\s*[+-]?[0-9]+\s*$"), "out of range").otherwise("no whole number")
    return F.when(cell.isNotNull() & ~fits, fault)


def cast_faults(types: Mapping[str, str], timestamp_format: str | None = None) -> Column:
    """All cells of a row that ``cast_strict`` refuses: (column, value, reason) in the order of
    the columns; an empty array for a row it takes."""
    return _listed({name: _cell_fault(name, to, timestamp_format) for name, to in types.items()})


def _listed(reasons: Mapping[str, Column]) -> Column:
    """The cells that have a reason, as ``cast_faults`` gives them."""
    found = [
        F.struct(F.lit(name).alias("column"), F.col(name).alias("value"), reason.alias("reason"))
        for name, reason in reasons.items()
    ]
    return F.filter(F.array(*found), lambda x: x["reason"].isNotNull())


def split_casts(
    df: DataFrame, types: Mapping[str, str], scratch: Scratch, timestamp_format: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(taken, refused): the rows all of whose cells fit their types, cast, and the others as they
    are, with ``faults``.

    One pass over ``df`` writes both, each to its own folder, so neither output costs a second
    scan, and ``df`` need not give the same rows twice. No row is in both or in none.
    """
    spark = df.sparkSession
    require_strict_casts(spark)
    # Reasons first, in generated code; what lists them is interpreted, and only for rows with any.
    reasons = {name: f"_reason_{name}" for name in types}
    judged = df.withColumns({reasons[name]: _cell_fault(name, to, timestamp_format) for name, to in types.items()})
    refused = F.coalesce(*(F.col(r) for r in reasons.values())).isNotNull()
    found = _listed({name: F.col(r) for name, r in reasons.items()})
    judged = judged.select(*df.columns, F.when(refused, found).otherwise(F.array().cast(FAULTS)).alias("faults"), refused.alias("_refused"))
    # Scratch reads by schema, and a folder without rows has none: so the flag is in the path only.
    path = scratch.new_path("casts")
    # Both files of a task are open at once, so its rows need no sort by the flag.
    writers = spark.conf.get(CONCURRENT_WRITERS)
    spark.conf.set(CONCURRENT_WRITERS, max(int(writers), 2))
    try:
        judged.write.partitionBy("_refused").parquet(path)
    finally:
        spark.conf.set(CONCURRENT_WRITERS, writers)
    both = spark.read.schema(judged.schema).parquet(path)
    taken = both.filter(~F.col("_refused")).select(*df.columns)
    return cast_strict(taken, types, timestamp_format), both.filter("_refused").drop("_refused")


def required_keys(df: DataFrame, keys: Iterable[str] = REQUIRED_KEYS) -> DataFrame:
    """Rows in which every key is present. One test per key, which Parquet can skip by."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def rejected_rows(df: DataFrame, keys: Iterable[str] = REQUIRED_KEYS) -> DataFrame:
    """The rows ``required_keys`` drops, with the missing keys named in ``reason``."""
    missing = F.concat_ws(",", *(F.when(F.col(k).isNull(), F.lit(k)) for k in keys))
    return df.withColumn("reason", missing).filter(F.col("reason") != "")


def apply_defaults(df: DataFrame) -> DataFrame:
    """Fill the columns the tables have a default for: load time and return flag.

    The load time is one value for the whole query.
    """
    now = F.localtimestamp()
    filled = {
        "ingestion_ts": F.coalesce("ingestion_ts", now) if "ingestion_ts" in df.columns else now
    }
    if "return_flag" in df.columns:
        filled["return_flag"] = F.coalesce("return_flag", F.lit(False))
    return df.withColumns(filled)


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Defaults filled in, columns in declared order and of declared type."""
    require_strict_casts(df.sparkSession)
    filled = apply_defaults(df) if "ingestion_ts" in table.column_names else df
    return filled.select(*(F.col(c.name).cast(c.spark_type).alias(c.name) for c in table.columns))
