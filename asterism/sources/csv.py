"""CSV, text and JSON sources.

Columns bind by position: the header line, when present, is skipped and its
names are ignored, exactly as a positional COPY does.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, StringType, StructField, StructType, TimestampNTZType

from asterism.functions.columns import quoted
from asterism.operators.events import with_surrogate_id
from asterism.sources.records import read_records

# Fixed value: the null marker used when empty strings must stay empty.
KEEP_EMPTY_NULL_VALUE = "\\N"


def _as_struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


# The dialect of the source's loads: a quote inside quotes is doubled, a backslash
# is an ordinary character.
DIALECT = {"quote": '"', "escape": '"'}

# The spellings of booleans that a load accepts (any case), and the
# formats tried for a timestamp after ISO 8601.
TRUE_TEXTS = ("t", "true", "y", "yes", "1")
FALSE_TEXTS = ("f", "false", "n", "no", "0")
TIME_FORMATS = ("M/d/yyyy[ H:mm[:ss]]", "yyyy/M/d[ H:mm[:ss]]", "d-MMM-yyyy[ H:mm[:ss]]")

_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def boolean_of(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.isin(*TRUE_TEXTS), True).when(low.isin(*FALSE_TEXTS), False)


def _as_written(text: Column, fmt: str) -> Column:
    """The time that ``text`` states in ``fmt``, whatever the session's zone (NULL if it doesn't fit).

    Spark parses to an instant, and the way back goes through the zone, which has no
    2:30 on some nights. So the text is read as a time in UTC and counted from the
    epoch. A time with a zone of its own becomes that of UTC.
    """
    zoned = re.search("[VzOXxZ]", re.sub("'[^']*'", "", fmt))
    at = F.try_to_timestamp(text, F.lit(fmt)) if zoned else F.try_to_timestamp(F.concat(text, F.lit("+00:00")), F.lit(fmt + "xxx"))
    seconds = (F.unix_micros(at).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


def timestamp_of(text: Column, timestamp_format: str | None = None) -> Column:
    """A time in ``timestamp_format``, or in ISO 8601 or one of TIME_FORMATS; NULL if it is none."""
    if timestamp_format:
        return _as_written(text, timestamp_format)
    return F.coalesce(text.try_cast("timestamp_ntz"), *[_as_written(text, f) for f in TIME_FORMATS])


def truncated_of(text: Column, kind: DecimalType) -> Column:
    # the whole text must be a number; digits beyond the scale go, whatever the sign
    number = F.when(text.rlike(_NUMBER), text.try_cast(DecimalType(38, max(18, kind.scale))))
    cut = F.when(number < 0, F.ceil(number, F.lit(kind.scale))).otherwise(F.floor(number, F.lit(kind.scale)))
    return cut.try_cast(kind)


def _parsed(records: DataFrame, schema: StructType, options: dict[str, str]) -> DataFrame:
    """Records of text as the columns of ``schema``; a quote that is never closed makes a bad record."""
    corrupt = options.get("columnNameOfCorruptRecord")
    row = F.from_csv("record", schema.json(), {**options, "multiLine": "true", "maxCharsPerColumn": "-1"})
    rows = records.select(row.alias("r"), "record", "unclosed")
    if options["mode"] == "FAILFAST":
        failed = F.raise_error(F.concat(F.lit("a quote is not closed in: "), F.left("record", F.lit(200))))
        rows = rows.where(F.when(F.col("unclosed"), failed.cast("boolean")).otherwise(True))
    columns = [F.col("r." + "`" + f.name.replace("`", "``") + "`") for f in schema.fields]
    if corrupt:
        columns[-1] = F.when(F.col("unclosed"), F.col("record")).otherwise(columns[-1]).alias(corrupt)
    return rows.select(*columns)


def read_positional_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str,
                        header: bool = True, mode: str = "FAILFAST",
                        empty_strings: str = "null", scale_mode: str = "round",
                        timestamp_format: str | None = None,
                        corrupt_column: str | None = None, multi_line: bool = False) -> DataFrame:
    """Read CSV with a fixed schema bound by position.

    Quotes inside a quoted field are doubled; a backslash is an ordinary character.
    ``multi_line`` allows line breaks inside quotes. Such files are read by
    :func:`asterism.sources.records.read_records`, in blocks like any other, but in two
    passes with Python in their tasks, so it is off by default. A quoted line break then
    leaves a row short, which fails, unless it stands in the last column and what follows
    it happens to have as many fields as a row: files that may hold such texts need ``multi_line``.
    ``mode="FAILFAST"`` fails the job on a short row or a value that does not fit
    its type (e.g. decimal overflow); ``"PERMISSIVE"`` with ``corrupt_column``
    keeps bad lines aside instead. ``empty_strings="keep"`` keeps a quoted
    ``""`` as an empty string (an unquoted empty field is still NULL).
    ``scale_mode`` decides how extra decimal digits fit ``DECIMAL(p,s)``:
    ``"round"`` (half up) or ``"truncate"``. Booleans take the spellings above;
    timestamps ISO 8601 and ``TIME_FORMATS``, or ``timestamp_format`` alone.
    """
    target = _as_struct(schema)
    if scale_mode not in ("round", "truncate"):
        raise ValueError("scale_mode must be 'round' or 'truncate'")

    def parsed(f: StructField) -> Column | None:
        """The field from its text, where the reader's own parser is too narrow."""
        text = F.trim(quoted(f.name))
        if isinstance(f.dataType, BooleanType):
            return boolean_of(text)
        if isinstance(f.dataType, TimestampNTZType):
            return timestamp_of(text, timestamp_format)
        if isinstance(f.dataType, DecimalType) and scale_mode == "truncate":
            return truncated_of(text, f.dataType)
        return None

    as_text = {f.name for f in target.fields if parsed(f) is not None}
    read_schema = StructType([StructField(f.name, StringType(), f.nullable) if f.name in as_text else f
                              for f in target.fields])
    if corrupt_column:
        read_schema = StructType(read_schema.fields + [StructField(corrupt_column, StringType())])
    options = {**DIALECT, "mode": mode}
    if corrupt_column:
        options["columnNameOfCorruptRecord"] = corrupt_column
    if empty_strings == "keep":
        options |= {"nullValue": KEEP_EMPTY_NULL_VALUE, "emptyValue": ""}
    elif empty_strings != "null":
        raise ValueError("empty_strings must be 'null' or 'keep'")
    if multi_line:
        df = _parsed(read_records(spark, path, header), read_schema, options)
    else:
        df = spark.read.schema(read_schema).options(**options, header=header, enforceSchema=True).csv(path)

    def checked(f: StructField) -> Column:
        raw = quoted(f.name)
        if f.name not in as_text:
            return raw
        value = F.when(F.trim(raw) == "", None).otherwise(parsed(f))
        if mode == "FAILFAST":
            bad = raw.isNotNull() & (F.trim(raw) != "") & value.isNull()
            failed = F.raise_error(F.concat(F.lit(f"not a {f.dataType.simpleString()} in {f.name}: "), raw))
            value = F.when(bad, failed).otherwise(value)
        return value.cast(f.dataType).alias(f.name)

    if not as_text:
        return df
    return df.select(*[checked(f) for f in target.fields], *([quoted(corrupt_column)] if corrupt_column else []))


def read_measure_csv(spark: SparkSession, root: str, name: str, schema: StructType | str,
                     **options) -> DataFrame:
    """One wide measure file ``{root}/{name}.csv`` (S4), schema from :func:`measure_schemas`."""
    return read_positional_csv(spark, f"{root.rstrip('/')}/{name}.csv", schema, **options)


def read_ordered_names(spark: SparkSession, path: str, name_col: str = "station_name",
                       id_col: str = "id", expected: Sequence[str] | None = None) -> DataFrame:
    """A headerless one-name-per-line CSV file with its 1-based line order.

    Order matters: wide columns are labelled by it. Blank lines are skipped.
    When ``expected`` (e.g. the header of the data file) is given, the names must
    match it in order, else this raises instead of mislabelling every value.
    Numbering is by a range layout, so no task sees all names; it writes the names
    once under the scratch folder when called.
    """
    lines = (spark.read.schema("name STRING").options(**DIALECT).csv(path)
             .select(F.monotonically_increasing_id().alias("_at"), F.trim("name").alias(name_col))
             .where(F.col(name_col) != ""))
    out = (with_surrogate_id(lines, id_col, ["_at"])
           .select(F.col(id_col).cast("int").alias(id_col), quoted(name_col)))
    if expected is not None:
        # no more names than the caller holds, and one to see that there are others
        got = [r[1] for r in out.where(quoted(id_col) <= len(expected) + 1).orderBy(id_col).collect()]
        if [g.lower() for g in got] != [e.lower() for e in expected]:
            raise ValueError(f"names in {path} do not match the expected order: {got} vs {list(expected)}")
    return out


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """The header names of a CSV file (first line only)."""
    first = spark.read.options(**DIALECT).option("header", False).csv(path).first()
    return [v for v in first] if first else []


def write_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` with a header line in the dialect that :func:`read_positional_csv` reads back
    (with ``multi_line`` and ``empty_strings="keep"`` where texts hold line breaks or are empty)."""
    (df.write.options(**DIALECT).option("header", True).option("nullValue", KEEP_EMPTY_NULL_VALUE)
     .option("emptyValue", '""').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The JSON manifest of input files: one row per ``{local, s3}`` pair."""
    return (spark.read.option("multiLine", True).json(path)
            .select(F.explode("data_files").alias("f"))
            .select(F.col("f.local").alias("local"), F.col("f.s3").alias("s3")))
