"""CSV scans that say what they could not read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import named, quoted

# Columns of a checked scan beside the table's own.
REJECTS, RECORD = "_rejects", "_record"
# Why something was rejected.
BAD_FIELD, BAD_LINE = "field", "line"


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _parsed(field: T.StructField, formats: dict[str, str]) -> Column:
    """The text as the column's type; NULL where it is none."""
    text = named(field.name)
    kind = field.dataType
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.DateType) and "dateFormat" in formats:
        return F.try_to_date(text, formats["dateFormat"])
    if isinstance(kind, T.TimestampType) and "timestampFormat" in formats:
        return F.try_to_timestamp(text, F.lit(formats["timestampFormat"]))
    return F.trim(text).try_cast(kind)


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True, **options: str
) -> DataFrame:
    """A CSV scan in the given types, with what did not fit them beside each row.

    As in a permissive scan every line gives a row, and a field that does not parse is NULL. Besides,
    ``_rejects`` is an array of ``(column, text, reason)``: each field that did not parse, and for a line
    with too few or too many fields an entry without a column, whose text is the whole line. ``_record``
    is that line, or NULL. One pass: fields are read as text and cast, so their text is still there. Empty
    fields are NULL and no rejects.
    """
    fields = _schema(schema).fields
    taken = {f.name for f in fields} & {REJECTS, RECORD}
    if taken:
        raise ValueError(f"columns of the scan's own: {sorted(taken)}")
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in fields] + [T.StructField(RECORD, T.StringType())])
    # All columns are read, whichever are wanted: else Spark would not count a line's fields.
    lines = spark.read.options(columnPruning="false", **options).csv(
        path, header=header, schema=raw, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD, enforceSchema=True
    )

    def entry(column: str | None, text: Column, reason: str) -> Column:
        return F.struct(F.lit(column).cast("string").alias("column"), text.alias("text"), F.lit(reason).alias("reason"))

    unread = [
        F.when(named(f.name).isNotNull() & _parsed(f, options).isNull(), entry(f.name, named(f.name), BAD_FIELD))
        for f in fields
        if not isinstance(f.dataType, T.StringType)
    ]
    broken = F.when(F.col(RECORD).isNotNull(), entry(None, F.col(RECORD), BAD_LINE))
    rejects = F.array_compact(F.array(broken, *unread))
    return lines.select(*[_parsed(f, options).alias(f.name) for f in fields], F.col(RECORD), rejects.alias(REJECTS))


def parsed_rows(checked: DataFrame, whole: bool = False) -> DataFrame:
    """The rows of a checked scan; with ``whole`` only those without rejects."""
    kept = checked.where(F.size(REJECTS) == 0) if whole else checked
    return kept.drop(REJECTS, RECORD)


def rejected(checked: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``(keep, column, text, reason)``: one row per reject of a checked scan."""
    return checked.select(*[F.col(quoted(c)) for c in keep], F.inline(REJECTS))
