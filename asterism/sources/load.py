"""Loads that split good rows from bad ones in one pass (V3), and the manifest that names a build's files."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, StringType, StructField, StructType, TimestampNTZType, VarcharType

from asterism.functions.columns import quoted
from asterism.session import scratch_path
from asterism.sources import csv as csv_src
from asterism.sources.records import read_records

#: Columns that a load adds to its stored rows; the fields of a schema can't have these names.
FILE, LINE, RECORD, ERRORS = "_file", "_line", "_record", "_errors"

SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:/*"


class LoadError(ValueError):
    """More bad rows than a load allows."""


@dataclass
class Load:
    """A stored load: good ``rows`` (with ``_file`` and ``_line`` where asked for), ``errors``
    (``file, line, column, reason, value, record``, a row for each), and its counts."""

    rows: DataFrame
    errors: DataFrame
    n_rows: int
    n_bad: int
    stored: DataFrame

    def by_file(self) -> DataFrame:
        """``file, n_rows, n_bad`` of each file that has a record."""
        return (self.stored.groupBy(F.col(FILE).alias("file"))
                .agg(F.count_if(F.size(ERRORS) == 0).alias("n_rows"), F.count_if(F.size(ERRORS) > 0).alias("n_bad")))


def _typed(field: StructField, text: Column, scale_mode: str, timestamp_format: str | None) -> tuple[Column, Column]:
    """A field's value from its text, and the reason why it can't be had (NULL if it can)."""
    kind, trimmed = field.dataType, F.trim(text)
    given = text.isNotNull() & (trimmed != "")
    if isinstance(kind, (StringType, VarcharType)):
        longest = getattr(kind, "length", None)
        reason = F.when(F.length(text) > longest, F.lit(f"longer than {longest}")) if longest else F.lit(None).cast("string")
        value = text
    else:
        if isinstance(kind, BooleanType):
            parsed = csv_src.boolean_of(trimmed)
        elif isinstance(kind, TimestampNTZType):
            parsed = csv_src.timestamp_of(trimmed, timestamp_format)
        elif isinstance(kind, DecimalType) and scale_mode == "truncate":
            parsed = csv_src.truncated_of(trimmed, kind)
        else:
            parsed = trimmed.try_cast(kind)
        value = F.when(given, parsed)
        reason = F.when(given & parsed.isNull(), F.lit(f"not a {kind.simpleString()}"))
    if not field.nullable:
        reason = F.coalesce(reason, F.when(value.isNull(), F.lit("missing")))
    return value, reason


def load_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str, max_errors: int = 0,
             stored: str | None = None, header: bool = True, empty_strings: str = "null", scale_mode: str = "round",
             timestamp_format: str | None = None, lineage: bool = False) -> Load:
    """Load CSV files, keeping bad rows aside with file, line, column and reason.

    Records are read in blocks, line breaks inside quotes included, parsed once, and
    stored with what is wrong with them (under ``stored``, else the scratch folder); good
    rows and errors both read the stored table. The number of bad rows is observed by the
    write itself. Above ``max_errors`` the load fails with :class:`LoadError`, and what it
    stored stays, for a look at the errors. Observed counts are of the tasks that finished
    the write, each once.

    A record is bad if it has another number of fields than ``schema``, if its quote is never
    closed, or if a field isn't of its type, too long (``VARCHAR(n)``), or missing though
    ``NOT NULL``. Options are those of :func:`asterism.sources.csv.read_positional_csv`.
    """
    target = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    options = dict(csv_src.DIALECT) | {"mode": "PERMISSIVE", "multiLine": "true", "maxCharsPerColumn": "-1",
                                       "columnNameOfCorruptRecord": RECORD}
    if empty_strings == "keep":
        options |= {"nullValue": csv_src.KEEP_EMPTY_NULL_VALUE, "emptyValue": ""}
    texts = StructType([*(StructField(f.name, StringType()) for f in target.fields), StructField(RECORD, StringType())])
    parsed = (read_records(spark, path, header)
              .select("file", "line", "record", "unclosed", F.from_csv("record", texts.json(), options).alias("r")))

    broken = F.when(F.col("unclosed"), "a quote is not closed").when(
        F.col("r")[RECORD].isNotNull(), F.lit(f"not {len(target.fields)} fields"))
    error = lambda column, reason, value: F.struct(
        F.lit(column).cast("string").alias("column"), reason.alias("reason"), value.cast("string").alias("value"))
    values, wrong = [], []
    for f in target.fields:
        value, reason = _typed(f, F.col("r")[f.name], scale_mode, timestamp_format)
        values.append(value.alias(f.name))
        wrong.append(F.when(broken.isNull() & reason.isNotNull(), error(f.name, reason, F.col("r")[f.name])))
    listed = F.array_compact(F.array(F.when(broken.isNotNull(), error(None, broken, F.lit(None))), *wrong))
    seen = Observation()
    bad = F.size(ERRORS) > 0
    # only bad rows keep their text
    rows = (parsed.select(F.col("file").alias(FILE), F.col("line").alias(LINE), listed.alias(ERRORS), "record", *values)
            .withColumn(RECORD, F.when(bad, F.col("record"))).drop("record")
            .observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad")))
    at = stored or scratch_path(spark, "load")
    rows.write.parquet(at)
    n, n_bad = (seen.get.get(k) or 0 for k in ("n", "bad"))
    if n_bad > max_errors:
        raise LoadError(f"{n_bad} of {n} records are bad, {max_errors} allowed; see {at}")
    kept = spark.read.parquet(at)
    columns = [quoted(f.name) for f in target.fields] + ([F.col(FILE), F.col(LINE)] if lineage else [])
    errors = (kept.where(bad).select(F.col(FILE).alias("file"), F.col(LINE).alias("line"), F.explode(ERRORS).alias("e"), RECORD)
              .select("file", "line", "e.column", "e.reason", "e.value", F.col(RECORD).alias("record")))
    return Load(kept.where(~bad).select(*columns), errors, n - n_bad, n_bad, kept)


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, bytes`` of all files under a folder (relative paths); no file is read."""
    bare = lambda path: re.sub(SCHEME, "/", path)  # noqa: E731  listed paths carry the store's scheme
    base = f"{bare(root).rstrip('/')}/"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    path = F.regexp_replace("path", SCHEME, "/")
    return found.select(F.substr(path, F.lit(len(base) + 1)).alias("path"), F.col("length").alias("bytes"))


def check_manifest(spark: SparkSession, manifest: DataFrame, root: str) -> DataFrame:
    """``local, s3, listed, files, bytes`` of each pair of a manifest: how often it lists the target, and the files
    that its local path has under ``root`` (itself, or a folder's), 0 where there is none."""
    pairs = manifest.groupBy("local", "s3").agg(F.count(F.lit(1)).alias("n"))
    listed = pairs.groupBy("s3").agg(F.sum("n").alias("listed"))
    # a file belongs to each of its parent folders, so pairs meet files by equality
    files = listed_files(spark, root).withColumn("parts", F.split("path", "/"))
    parents = files.select("path", "bytes", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("parts")), lambda n: F.array_join(F.slice("parts", F.lit(1), n), "/"))).alias("local"))
    sizes = parents.groupBy("local").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    return (pairs.join(listed, "s3").join(sizes, "local", "left")
            .select("local", "s3", "listed", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).alias("bytes")))


def manifest_paths(spark: SparkSession, manifest: DataFrame, root: str, required: Sequence[str] = ()) -> Mapping[str, str]:
    """The path of each target that a manifest names, checked: every file present, no target named twice, none missing.

    A manifest has a row for each input of a build, so its pairs are few.
    """
    try:
        pairs = check_manifest(spark, manifest, root).collect()
    except AnalysisException as e:
        raise FileNotFoundError(f"no folder {root}") from e
    twice = sorted({p["s3"] for p in pairs if p["listed"] > 1})
    absent = sorted(p["local"] for p in pairs if not p["files"])
    unnamed = sorted(set(required) - {p["s3"] for p in pairs})
    for what, names in (("named twice", twice), ("not found", absent), ("not in the manifest", unnamed)):
        if names:
            raise ValueError(f"{what}: {', '.join(names)}")
    return {p["s3"]: f"{root.rstrip('/')}/{p['local']}" for p in pairs}
