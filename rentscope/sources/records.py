"""Records with keys of their own -> one frame (as a list of dictionaries
becomes a table): a column for every key that any record has, typed by what
all of its values are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# from the narrowest on; text takes everything
KINDS = ("boolean", "bigint", "double", "timestamp_ntz")
_FORMS = {
    "boolean": r"^(?i:true|false)$",
    "bigint": r"^[+-]?[0-9]{1,18}$",
    "double": r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$",
    "timestamp_ntz": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?)?$",
}
MAX_COLUMNS = 10_000


def _is(kind: str, value: Column) -> Column:
    return value.rlike(_FORMS[kind]) & value.try_cast(kind).isNotNull()


def record_schema(records: DataFrame, record: str = "record") -> DataFrame:
    """(key, kind, records): every key with the narrowest kind that holds all of
    its values.  Kinds are joined pairwise on the way (whole numbers and decimals
    are decimals, any other two are text; an absent or null value joins
    with all), so one partial aggregate per task is enough."""
    pairs = records.select(F.explode(record).alias("key", "value"))
    fits = {k: F.every(F.coalesce(_is(k, F.col("value")), F.lit(True))).alias(k) for k in KINDS}
    seen = pairs.groupBy("key").agg(*fits.values(), F.count("value").alias("records"))
    kind = F.when(F.col("records") == 0, "string")
    for k in KINDS:
        kind = kind.when(F.col(k), k)
    return seen.select("key", kind.otherwise("string").alias("kind"), "records")


def records_to_frame(records: DataFrame, record: str = "record", keep: tuple[str, ...] = ()) -> DataFrame:
    """A row per record (a map of text to text) with a typed column per key, in
    the order of the keys' names, after the columns to ``keep``; a key that a
    record lacks is null.  More than MAX_COLUMNS keys are an error: such records
    are data, not columns."""
    kinds = record_schema(records, record).orderBy("key").limit(MAX_COLUMNS + 1).collect()
    if len(kinds) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} different keys")
    cell = F.col(record)
    return records.select(*keep, *(cell[r["key"]].try_cast(r["kind"]).alias(r["key"]) for r in kinds))
