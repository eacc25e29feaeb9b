"""Round-trip properties of the reshaping operators, on generated inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asterism.operators.reshape import pivot_counts, split_to_rows, unpivot_measures

NAME = st.text(alphabet="AB, /&x", max_size=4)
LIST = st.one_of(st.none(), st.lists(NAME, min_size=1, max_size=5).map(";".join))
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(LIST, min_size=1, max_size=30))
def test_split_then_ordered_join_is_input(spark, lists):
    df = spark.createDataFrame(list(enumerate(lists)), "id long, offenses string")
    names = split_to_rows(df, ["id"], "offenses")
    back = (names.groupBy("id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("num", "offense_name"))), lambda e: e["offense_name"]), ";")
        .alias("offenses")))
    got = {r.id: r.offenses for r in back.collect()}
    assert got == {i: s for i, s in enumerate(lists) if s is not None}
    counts = {r.id: r.name_cnt for r in names.select("id", "name_cnt").distinct().collect()}
    assert counts == {i: len(s.split(";")) for i, s in enumerate(lists) if s is not None}


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)),
                          st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False))), min_size=1, max_size=20))
def test_unpivot_then_pivot_is_input(spark, cells):
    wide = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(cells)], "datetime long, s1 double, s2 double")
    long = unpivot_measures(wide, ["datetime"], ["s1", "s2"], "stn", "v")
    assert long.count() == 2 * len(cells)
    back = long.groupBy("datetime").pivot("stn", ["s1", "s2"]).agg(F.max("v"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))


@SETTINGS
@given(st.lists(LIST, min_size=1, max_size=30))
def test_pivot_counts_sum_to_name_count(spark, lists):
    df = spark.createDataFrame(list(enumerate(lists)), "id long, offenses string")
    p = pivot_counts(split_to_rows(df, ["id"], "offenses"), ["id", "name_cnt"])
    names = [c for c in p.columns if c not in ("id", "name_cnt")]
    for r in p.collect():
        assert sum(r[c] for c in names) == r.name_cnt


ROW = st.tuples(st.one_of(st.none(), st.sampled_from(["k1", "k2", "k3"])),
                st.one_of(st.none(), st.sampled_from(["a", "b"])),
                st.one_of(st.none(), st.integers(0, 2)))


@SETTINGS
@given(st.lists(ROW, min_size=1, max_size=25))
def test_conform_partitions_the_distinct_rows(spark, data):
    from asterism.operators.quality import conform_dimension

    df = spark.createDataFrame(data, "k string, a string, v int")
    c = conform_dimension(df, ["k"])
    clean, quarantine = [tuple(r) for r in c.clean.collect()], [tuple(r) for r in c.quarantine.collect()]
    distinct = set(data)
    assert sorted(clean + quarantine, key=repr) == sorted(distinct, key=repr)
    assert len(clean) + len(quarantine) == len(distinct)
    q_keys = {r[0] for r in quarantine}
    assert None not in q_keys and not q_keys & {r[0] for r in clean}
    for key in {r[0] for r in clean} - {None}:
        assert sum(1 for r in clean if r[0] == key) == 1


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 3)), min_size=0, max_size=40))
def test_surrogate_ids_are_row_numbers(spark, data):
    from pyspark.sql import Window

    from asterism.operators.events import with_surrogate_id

    df = spark.createDataFrame(data, "a int, b int").distinct()
    got = with_surrogate_id(df, "id", ["a", "b"], num_partitions=3)
    want = df.select(F.row_number().over(Window.orderBy(F.col("a").asc_nulls_first(), "b")).cast("long").alias("id"),
                     "a", "b")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
