"""Reshaping operators: split lists to rows (R1), pivot names to counts (R3),
unpivot wide measures (R2), and N-way full joins of measures (J10 / H3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.functions.columns import any_null, quoted, regex_literal
from asterism.functions.names import pivot_column_names
from asterism.session import scratch_path


def split_to_rows(df: DataFrame, id_cols: Sequence[str], col: str, delim: str = ";",
                  name_col: str = "offense_name", count_col: str = "name_cnt",
                  num_col: str = "num") -> DataFrame:
    """One row per element of a delimited string: ``(ids…, count, num 1-based, name)``.

    No trimming, case folding or dedup. ``'A;'`` gives ``A`` and ``''`` (count 2);
    ``''`` gives one empty name; NULL gives no rows. A narrow operator: the input
    partitioning is kept, so a following aggregate on the ids needs no shuffle.
    """
    # Split once into a column; the count and the explode both read it.
    split = df.select(*[quoted(c) for c in id_cols],
                      F.split(quoted(col), regex_literal(delim), -1).alias("_parts"))
    exploded = split.select(
        *[quoted(c) for c in id_cols],
        F.size("_parts").cast("long").alias(count_col),
        F.posexplode("_parts").alias("_pos", name_col),
    )
    return exploded.select(
        *[quoted(c) for c in id_cols],
        quoted(count_col),
        (F.col("_pos") + 1).cast("long").alias(num_col),
        quoted(name_col),
    )


def vocabulary_frame(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of ``col`` as a DataFrame (partial aggregation, one shuffle)."""
    return df.select(quoted(col)).distinct()


#: Names that :func:`vocabulary` collects at most: each becomes a column.
MAX_NAMES = 20_000


def vocabulary(df: DataFrame, col: str, max_names: int = MAX_NAMES) -> list[str]:
    """Sorted distinct non-NULL values of ``col``, collected for use as pivot columns.

    Runs a job when called. Each value becomes a column of the caller's result, so more
    than ``max_names`` of them fail, before more than one name beyond has reached the
    driver; :func:`count_names` gives the same counts as rows, for any number of names.
    """
    names = vocabulary_frame(df, col).where(quoted(col).isNotNull())
    found = [r[0] for r in names.take(max_names + 1)]
    if len(found) > max_names:
        raise ValueError(f"{col} has more than {max_names} names to become columns; count_names gives them as rows")
    return sorted(found)


def count_names(df: DataFrame, group_cols: Sequence[str], name_col: str = "offense_name",
                count_col: str = "num") -> DataFrame:
    """The long form of :func:`pivot_counts`: ``(groups…, name, n)``, a row for each name that
    a group has, however many names there are."""
    return (df.where(quoted(name_col).isNotNull()).groupBy(*[quoted(c) for c in group_cols], quoted(name_col))
            .agg(F.count(quoted(count_col)).alias("n")))


def pivot_counts(df: DataFrame, group_cols: Sequence[str], name_col: str = "offense_name",
                 count_col: str = "num", vocab: Sequence[str] | None = None,
                 flags: bool = False) -> DataFrame:
    """Names to columns: for each name, ``count(count_col)`` of rows carrying it.

    Values are counts (``'A;A'`` → 2), 0 when absent; ``flags=True`` gives booleans.
    Columns are the lower-cased names (``''`` → ``not_named``) in vocabulary order.
    Built as one conditional-count aggregate per name, which Spark combines map-side.
    """
    if vocab is None:
        vocab = vocabulary(df, name_col)
    columns = pivot_column_names(vocab, reserved=group_cols)
    name = quoted(name_col)
    aggs = [F.count(F.when(name == F.lit(value), quoted(count_col))).alias(c)
            for value, c in columns.items()]
    keys = [quoted(c) for c in group_cols]
    # With no names at all (e.g. every list NULL) only the groups remain.
    out = df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()
    if flags:
        out = out.select(*[quoted(c) for c in group_cols],
                         *[(quoted(c) > 0).alias(c) for c in columns.values()])
    return out


def list_vocabulary(df: DataFrame, col: str, delim: str = ";") -> list[str]:
    """Sorted distinct names found in the delimited lists of ``col`` (see :func:`vocabulary`)."""
    names = df.select(F.explode(F.split(quoted(col), regex_literal(delim), -1)).alias("_name"))
    return vocabulary(names, "_name")


def count_list_names(df: DataFrame, col: str, vocab: Sequence[str] | None = None, delim: str = ";",
                     keep_cols: Sequence[str] | None = None, count_col: str = "name_cnt",
                     flags: bool = False) -> DataFrame:
    """Split then pivot (R1 then R3) in one narrow step, for names that come from one row's list.

    Each row with a non-NULL list gives ``keep_cols…`` (default: all columns),
    ``count_col`` = number of names, and per vocabulary name the number of
    times it occurs in the row's list. This equals grouping the split rows by
    a unique row id and pivoting, without the explode, the shuffle and the
    join back — so the list column's rows must be unique by their id.
    """
    if vocab is None:
        vocab = list_vocabulary(df, col, delim)
    keep = list(df.columns if keep_cols is None else keep_cols)
    columns = pivot_column_names(vocab, reserved=keep + [count_col])
    # Split and marked once, into columns that every count reads.
    parts = F.split(quoted(col), regex_literal(delim), -1)
    split = df.where(quoted(col).isNotNull()).select(
        *[quoted(c) for c in keep], parts.alias("_parts") if len(delim) != 1 else F.size(parts).alias("_n"),
        *([_marked(quoted(col), delim).alias("_marked")] if len(delim) == 1 else []))
    size = F.col("_n") if len(delim) == 1 else F.size("_parts")
    counts = []
    for value, name in columns.items():
        n = (_occurrences(F.col("_marked"), value, delim) if len(delim) == 1
             # names − names left after removing this one (array functions, no lambda)
             else F.size("_parts") - F.size(F.array_remove("_parts", F.lit(value)))).cast("long")
        counts.append((n > 0 if flags else n).alias(name))
    return split.select(*[quoted(c) for c in keep], size.cast("long").alias(count_col), *counts)


def _mark(delim: str) -> str:
    return "," if delim == "." else "."


def _marked(text: Column, delim: str) -> Column:
    """A list with each name between delimiters of its own, after a mark that keeps it from being empty: ``;.A;;.B;``."""
    return F.concat(F.lit(delim + _mark(delim)), F.replace(text, F.lit(delim), F.lit(delim + delim + _mark(delim))), F.lit(delim))


def _occurrences(marked: Column, name: str, delim: str) -> Column:
    """How often a name stands in a :func:`_marked` list: the bytes that go with it, by those of one.

    A name with the delimiter in it is none. No array is made: several times as fast as removing it from one.
    """
    if delim in name:
        return F.lit(0)
    whole = delim + _mark(delim) + name + delim
    return (F.octet_length(marked) - F.octet_length(F.replace(marked, F.lit(whole), F.lit("")))) / len(whole.encode())


def unpivot_measures(df: DataFrame, id_cols: Sequence[str], value_cols: Sequence[str],
                     var_name: str = "stn", value_name: str = "value") -> DataFrame:
    """Wide → long, **keeping NULL cells**: ``(ids…, var_name, value_name)``.

    The variable values are the column names, in ``value_cols`` order. Narrow.
    """
    return df.unpivot([quoted(c) for c in id_cols], [quoted(c) for c in value_cols],
                      var_name, value_name)


def _ordered(frames: Mapping[str, DataFrame] | Sequence[DataFrame]) -> list[DataFrame]:
    if isinstance(frames, Mapping):
        return [frames[k] for k in sorted(frames)]
    return list(frames)


#: Rows of one input that a group of the full join holds at most; a key with more is split.
MAX_GROUP_ROWS = 4096
#: Rows that a gathered group's product has at most; a key with more is joined, not gathered.
MAX_GATHERED_PRODUCT = 4096
#: Rows that a joined group's product has at most, as far as dealing its largest input can help.
MAX_JOINED_PRODUCT = 4_000_000
#: Rows that a task of the joined groups makes, up to MAX_JOINED_TASKS tasks; beyond, tasks make more.
JOINED_TASK_ROWS = 20_000_000
MAX_JOINED_TASKS = 10_000
#: Split keys at most, whose shares are broadcast; beyond, groups grow.
MAX_SPLIT_KEYS = 1_000_000


def _product(columns) -> Column:
    return reduce(lambda a, b: a * b, columns, F.lit(1))


def key_shares(dfs: Sequence[DataFrame], keys: Sequence[str], group_rows: int = MAX_GROUP_ROWS,
               max_keys: int = MAX_SPLIT_KEYS) -> DataFrame | None:
    """``keys…, _s0, _s1, …``: into how many pieces each input's rows of a key are dealt, 0 for an input without
    any; only keys with more than ``group_rows`` rows of an input or a product of more than
    MAX_GATHERED_PRODUCT rows have a row. None where no key has. Stored.

    One map-side counted aggregate over the keys of all inputs.
    """
    return _split_keys(dfs, keys, group_rows, max_keys)[0]


def _split_keys(dfs: Sequence[DataFrame], keys: Sequence[str], group_rows: int = MAX_GROUP_ROWS,
                max_keys: int = MAX_SPLIT_KEYS) -> tuple[DataFrame | None, float]:
    """The :func:`key_shares`, and how many rows the products of their keys have together."""
    spark, n = dfs[0].sparkSession, range(len(dfs))
    stacked = reduce(DataFrame.unionByName, [d.where(~any_null(keys)).select(*[quoted(k) for k in keys], F.lit(i).alias("_i"))
                                             for i, d in enumerate(dfs)])
    most, product = F.greatest(*[F.col(f"_s{i}") for i in n]), _product([F.greatest(F.col(f"_s{i}"), F.lit(1)).cast("double") for i in n])
    counts = (stacked.groupBy(*[quoted(k) for k in keys]).agg(*[F.count_if(F.col("_i") == i).alias(f"_s{i}") for i in n])
              .withColumn("_most", most).withColumn("_product", product))
    many = lambda factor: (F.col("_most") > group_rows * factor) | (F.col("_product") > MAX_GATHERED_PRODUCT * factor)
    path = scratch_path(spark, "key-shares")
    counts.where(many(1)).write.parquet(path)
    stored, factor = spark.read.parquet(path), 1
    split = lambda: stored.where(many(factor)).agg(F.count(F.lit(1)), F.sum("_product")).first()
    while (found := split())[0] > max_keys:
        factor *= 2
    if not found[0]:
        return None, 0.0
    rows, share = [F.col(f"_s{i}") for i in n], [F.ceil(F.col(f"_s{i}") / (group_rows * factor)) for i in n]
    # pieces of the largest input, beyond its own, that bring down the product of a group
    group = _product([F.when(rows[i] > 0, rows[i] / share[i]).otherwise(1.0) for i in n])
    finer = F.ceil(group / MAX_JOINED_PRODUCT)
    largest = [(rows[i] == F.col("_most")) & ~reduce(lambda a, b: a | b, [rows[j] == F.col("_most") for j in range(i)], F.lit(False))
               for i in n]
    dealt = [F.when(largest[i], F.least(rows[i], share[i] * finer)).otherwise(share[i]).cast("long").alias(f"_s{i}") for i in n]
    return stored.where(many(factor)).select(*[quoted(k) for k in keys], *dealt), found[1]


def _dealt(df: DataFrame, keys: Sequence[str], at: int, shares: DataFrame, n: int) -> DataFrame:
    """The rows of split keys of input ``at`` with the groups (``_g``) that they go to.

    A group is a choice of one piece of each input, numbered in mixed radix; a row lies in one
    piece of its own input, and goes to all choices of the others. Rows are stored with
    their piece, so that a rerun task can't deal them otherwise.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "split-rows")
    size = lambda over: _product([F.greatest(F.col(f"_s{j}"), F.lit(1)) for j in over])
    # repeated rows share a hash, so rows are dealt by their place; hashed, as a key's rows may lie at equal distances
    piece = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col(f"_s{at}"))
    (df.join(F.broadcast(shares), list(keys)).withColumn("_piece", piece).write.parquet(path))
    after = size(range(at + 1, n))
    other = F.explode(F.sequence(F.lit(0).cast("long"), size([j for j in range(n) if j != at]) - 1))
    return (spark.read.parquet(path).withColumn("_other", other)
            .withColumn("_g", (F.floor(F.col("_other") / after) * F.col(f"_s{at}") + F.col("_piece")) * after + F.col("_other") % after)
            .select(*[quoted(c) for c in df.columns], F.col("_g").cast("long").alias("_g")))


def _joined(dfs: Sequence[DataFrame], keys: Sequence[str], shares: DataFrame, rows_out: float) -> DataFrame:
    """The products of the split keys: the groups of all inputs joined, a shuffle for each input.

    An input without a row of a key gives each of its groups one row of NULLs. So the joins
    are inner ones, and a group that lacks a piece of some input has no rows. The ``rows_out``
    that they make together say how many tasks they have.
    """
    n, on = len(dfs), [*keys, "_g"]
    # a set number, since the rows that come out, and not those that are shuffled, are the work
    partitions = max(int(shares.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                     int(min(MAX_JOINED_TASKS, rows_out / JOINED_TASK_ROWS)))
    groups = F.sequence(F.lit(0).cast("long"), _product([F.greatest(F.col(f"_s{i}"), F.lit(1)) for i in range(n)]) - 1)
    inputs = []
    for i, d in enumerate(dfs):
        lacking = shares.where(F.col(f"_s{i}") == 0).select(*[quoted(k) for k in keys], F.explode(groups).alias("_g"))
        rows = _dealt(d, keys, i, shares, n).unionByName(lacking, allowMissingColumns=True)
        inputs.append(rows.repartition(partitions, *[quoted(c) for c in on]))
    return reduce(lambda a, b: a.join(b.hint("merge"), on), inputs).drop("_g")


def full_join_measures(frames: Mapping[str, DataFrame] | Sequence[DataFrame],
                       keys: Sequence[str], assume_unique: bool = False,
                       group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """N-way ``FULL JOIN … USING (keys)``; keys coalesced, tables in name order.

    A key's rows are the product of the inputs' rows of that key, NULL for inputs without
    one, just as in a chain of joins, but grouped once: all inputs' rows meet in one
    shuffle, a group holds each input's rows of a key, and the product is exploded. No
    intermediate result is shuffled. A task holds all rows that it explodes from a group,
    so a key with more than ``group_rows`` rows of an input or a larger product is
    split (:func:`key_shares`, counted beforehand when called): its rows are dealt to pieces,
    each choice of pieces is a group of its own, and the inputs are joined by group, which
    makes the rows one after another. Rows with a NULL key match nothing and
    are appended. With ``assume_unique=True`` (each input has at most one row per non-NULL
    key) the form :func:`union_measures` is used.
    """
    dfs = _ordered(frames)
    if not dfs:
        raise ValueError("no measure tables")
    if len(dfs) == 1:
        return dfs[0]
    if assume_unique:
        return union_measures(dfs, keys)
    by, n = [quoted(k) for k in keys], len(dfs)
    shares, rows_out = _split_keys(dfs, keys, group_rows)
    columns = [[c for c in d.columns if c not in keys] for d in dfs]
    parts = []
    for i, d in enumerate(dfs):
        keyed = d.where(~any_null(keys))
        # an input without measures still has rows to multiply
        row = F.struct(*[quoted(c) for c in columns[i]], F.lit(1).alias("_row")).alias(f"_r{i}")
        whole = keyed if shares is None else keyed.join(F.broadcast(shares.select(*by)), list(keys), "left_anti")
        parts.append(whole.select(*by, row))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    grouped = stacked.groupBy(*by).agg(*[F.collect_list(f"_r{i}").alias(f"_r{i}") for i in range(n)])
    for i in range(n):
        grouped = grouped.withColumn(f"_r{i}", F.explode_outer(f"_r{i}"))
    out = [grouped.select(*by, *[F.col(f"_r{i}")[c].alias(c) for i in range(n) for c in columns[i]])]
    if shares is not None:
        out.append(_joined([d.where(~any_null(keys)) for d in dfs], keys, shares, rows_out))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*out, *[d.where(any_null(keys)) for d in dfs]])


def union_measures(frames: Mapping[str, DataFrame] | Sequence[DataFrame],
                   keys: Sequence[str]) -> DataFrame:
    """The full join of measure tables with unique keys as one union + one aggregate.

    Rows are stacked (missing measure columns NULL) and grouped by the keys, so
    the whole combine is one hash shuffle however many inputs there are, and the
    aggregate combines map-side. Rows with a NULL key never match, exactly as in
    the join, and pass through unchanged. A key that repeats within an input fails
    the job, counted in the same aggregate.
    """
    dfs = _ordered(frames)
    if len(dfs) == 1:
        return dfs[0]
    measure_cols: list[str] = []
    for d in dfs:
        measure_cols += [c for c in d.columns if c not in keys and c not in measure_cols]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                     [d.withColumn("_input", F.lit(i)) for i, d in enumerate(dfs)])
    # A row with a NULL key gets a unique tag so it stays a group of its own;
    # matched rows have a NULL tag and group by the keys alone. The inputs'
    # hash partitioning on the keys survives the union, so the aggregate is
    # planned with no further shuffle.
    tag = F.when(any_null(keys), F.monotonically_increasing_id()).alias("_unmatched")
    combined = (stacked.groupBy(*[quoted(k) for k in keys], tag)
                .agg(*[F.max(quoted(c)).alias(c) for c in measure_cols],
                     *[F.count_if(F.col("_input") == i).alias(f"_rows{i}") for i in range(len(dfs))]))
    repeated = F.greatest(*[F.col(f"_rows{i}") for i in range(len(dfs))]) > 1
    once = F.when(repeated, F.raise_error(F.lit("a key repeats within a measure table"))).otherwise(F.lit(True))
    return combined.where(once).select(*[quoted(c) for c in list(keys) + measure_cols])


def number_names(df: DataFrame, name_col: str, num_col: str = "num") -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY name)`` over the distinct names.

    Uses the distributed surrogate id, so no single task sees all names.
    """
    from asterism.operators.events import with_surrogate_id

    names = df.select(quoted(name_col)).distinct()
    return with_surrogate_id(names, num_col, [name_col], first=False).select(
        quoted(name_col), F.col(num_col).cast("int").alias(num_col))
