"""CSV records with line breaks inside quotes, read in blocks, against Python's own CSV reader."""

import csv
import random

import pyarrow as pa
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from asterism.sources import records
from asterism.sources.csv import read_positional_csv
from tests.conftest import rows


@pytest.fixture()
def block_size(spark):
    """Sets the size of the blocks that files are read in."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def use(size):
        for n, v in zip(names, (size, "1", "1")):
            spark.conf.set(n, v)

    yield use
    for n, v in before.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def field(r):
    text = "".join(r.choice(["a", "b", " ", '"', ",", "\n", "\r\n", "xyz", "\\", ',"', '"\n"']) for _ in range(r.choice([1, 3, 8, 60])))
    return '"' + text.replace('"', '""') + '"' if r.random() < 0.7 else "".join(r.choice("abc 12") for _ in range(5))


def make(path, seed, n, end="\n"):
    r = random.Random(seed)
    with open(path, "w", newline="") as f:
        f.write(f"h1,h2,h3{end}")
        for k in range(n):
            f.write(f"{k},{field(r)},{field(r)}{end}" + (end if r.random() < 0.05 else ""))
    with open(path, newline="") as f:
        return [(int(a), b, c) for a, b, c in [x for x in csv.reader(f) if x][1:]]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", ["64m", "4k", "700", "90"])
def test_blocks_of_any_size_give_the_same_records(spark, tmp_dir, block_size, size, end):
    want = make(f"{tmp_dir}/a.csv", 1, 60, end) + make(f"{tmp_dir}/b.csv", 2, 40, end)
    block_size(size)
    got = read_positional_csv(spark, tmp_dir, "k INT, a STRING, b STRING", multi_line=True)
    assert rows(got) == sorted(want)


def test_a_file_is_read_in_many_tasks(spark, tmp_dir, block_size):
    want = make(f"{tmp_dir}/a.csv", 3, 3000)
    block_size("20k")
    df = read_positional_csv(spark, f"{tmp_dir}/a.csv", "k INT, a STRING, b STRING", multi_line=True)
    found = records.blocks(spark, f"{tmp_dir}/a.csv")
    assert found.count() > 5 and found.where("open").count() > 0
    assert df.rdd.getNumPartitions() > 5
    assert sorted(rows(df)) == sorted(want)


def test_a_field_longer_than_many_blocks(spark, tmp_dir, block_size):
    long = "line, with a comma\n" * 500
    with open(f"{tmp_dir}/l.csv", "w") as f:
        f.write(f'k,s\n1,x\n2,"{long}"\n3,y\n4,"{long}""q"""\n')
    block_size("400")
    df = read_positional_csv(spark, f"{tmp_dir}/l.csv", "k INT, s STRING", multi_line=True)
    assert rows(df) == [(1, "x"), (2, long), (3, "y"), (4, long + '"q"')]


def test_records_name_their_file(spark, tmp_dir, block_size):
    for name in ("a b.csv", "c%20d+é.csv"):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write('k\n1\n"2\n"\n')
    block_size("5")
    got = rows(records.read_records(spark, tmp_dir).selectExpr("record", "file"))
    assert len(got) == 4 and len({f for _, f in got}) == 2 and all(f and f.startswith("file:") for _, f in got)
    want = {r[0] for r in spark.read.text(tmp_dir).select("_metadata.file_path").distinct().collect()}
    assert {f for _, f in got} == want


def test_lines_of_records(spark, tmp_dir, block_size):
    with open(f"{tmp_dir}/n.csv", "w") as f:
        f.write('\n \nk,s\n1,"a\nb"\n\n2,c\n3,"d\n\n\ne"\n4,f')
    for size in ("64m", "6"):
        block_size(size)
        assert rows(records.read_records(spark, f"{tmp_dir}/n.csv"), "line", "record") == [
            (4, '1,"a\nb"'), (7, "2,c"), (8, '3,"d\n\n\ne"'), (12, "4,f")]
    assert rows(records.read_records(spark, f"{tmp_dir}/n.csv", header=False), "line")[0] == (3,)


def test_quotes_within_unquoted_fields_open_nothing(spark, tmp_dir, block_size):
    with open(f"{tmp_dir}/q.csv", "w") as f:
        f.write('k,s\n1,5" nail\n2,"x\ny"\n3,a"b"c\n4,"p ""q"",\nr"\n')
    for size in ("64m", "8"):
        block_size(size)
        assert rows(records.read_records(spark, f"{tmp_dir}/q.csv"), "record") == sorted(
            [('1,5" nail',), ('2,"x\ny"',), ('3,a"b"c',), ('4,"p ""q"",\nr"',)])


@pytest.mark.parametrize("size", ["64m", "9"])
def test_a_quote_that_is_never_closed(spark, tmp_dir, block_size, size):
    with open(f"{tmp_dir}/o.csv", "w") as f:
        f.write('k,s\n1,a\n2,"b\n3,c\n')
    block_size(size)
    with pytest.raises((PySparkException, Py4JJavaError), match="not closed"):
        read_positional_csv(spark, f"{tmp_dir}/o.csv", "k INT, s STRING", multi_line=True).collect()
    kept = read_positional_csv(spark, f"{tmp_dir}/o.csv", "k INT, s STRING", multi_line=True, mode="PERMISSIVE", corrupt_column="bad")
    assert [r[2] for r in rows(kept)] == [None, '2,"b\n3,c']


def test_a_record_beyond_the_limit_fails(spark, tmp_dir, block_size, monkeypatch):
    with open(f"{tmp_dir}/x.csv", "w") as f:
        f.write('k,s\n1,"' + "word\n" * 400 + '"\n2,b\n')
    block_size("300")
    monkeypatch.setattr(records, "MAX_RECORD_BYTES", 1000)
    with pytest.raises((PySparkException, Py4JJavaError), match="more than 1000 bytes"):
        read_positional_csv(spark, f"{tmp_dir}/x.csv", "k INT, s STRING", multi_line=True).collect()
    lines = {"block": [1, 1], "open": [False, False], "value": ['1,"' + "w" * 1200, "x"]}
    with pytest.raises(ValueError, match="more than 1000 bytes"):
        list(records._cut(iter([pa.RecordBatch.from_pydict(lines)])))


def test_line_states_equal_a_scan_of_each_line():
    r = random.Random(8)
    for _ in range(400):
        texts = ["".join(r.choice(['"', ",", "a", ',"', '",', '""', " "]) for _ in range(r.randrange(7))) for _ in range(r.randrange(1, 9))]
        lines = pa.array(["skip", *texts])[1:]  # an offset into the buffer
        for inside in (False, True):
            states = [inside]
            for t in texts:
                states.append(records.ends_inside(t, states[-1]))
            assert records._line_states(lines, inside).tolist() == states


def test_records_that_cross_batches(spark, tmp_dir, block_size):
    want = make(f"{tmp_dir}/a.csv", 5, 300)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size, batch in (("64m", "1"), ("64m", "3"), ("3k", "2")):
            block_size(size)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            assert rows(read_positional_csv(spark, tmp_dir, "k INT, a STRING, b STRING", multi_line=True)) == sorted(want)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_empty_files(spark, tmp_dir):
    open(f"{tmp_dir}/e.csv", "w").close()
    assert rows(read_positional_csv(spark, f"{tmp_dir}/e.csv", "k INT, s STRING", multi_line=True)) == []
    with open(f"{tmp_dir}/h.csv", "w") as f:
        f.write("k,s\n")
    assert rows(read_positional_csv(spark, f"{tmp_dir}/h.csv", "k INT, s STRING", multi_line=True)) == []


def test_short_rows_and_types(spark, tmp_dir):
    with open(f"{tmp_dir}/t.csv", "w") as f:
        f.write('k,d,s\n1,1.005,"a\nb"\n2,"x"\n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_positional_csv(spark, f"{tmp_dir}/t.csv", "k INT, d DECIMAL(5,2), s STRING", multi_line=True).collect()
    got = read_positional_csv(spark, f"{tmp_dir}/t.csv", "k INT, d DECIMAL(5,2), s STRING", multi_line=True, mode="PERMISSIVE",
                              corrupt_column="bad")
    assert [(r.k, str(r.d), r.s, r.bad) for r in got.orderBy("k").collect()] == [
        (1, "1.01", "a\nb", None), (2, "None", None, '2,"x"')]
