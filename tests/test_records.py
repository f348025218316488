"""CSV records with line breaks in fields, cut by splits of any size."""

import contextlib
import datetime as dt
import io
import random

import pandas as pd
import pytest
from pyspark.errors import PySparkException

from tidemark.sources import extract, records

RUN_TS = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)
SPLIT, OPEN = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


@contextlib.contextmanager
def splits_of(spark, size):
    before = {k: spark.conf.get(k) for k in (SPLIT, OPEN)}
    spark.conf.set(SPLIT, str(size))
    spark.conf.set(OPEN, "1")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def read(spark, path, size, **options):
    with splits_of(spark, size):
        found = extract.read_extract(spark, str(path), RUN_TS, multi_line=True, **options)
        rows = found.rows.orderBy(*extract.ORDER).collect()
        return found, [tuple(r[n] for n in found.names) for r in rows]


def expected(text, width):
    frame = pd.read_csv(
        io.StringIO(text, newline=""), dtype=str, names=range(width), header=0, engine="c"
    )
    return [tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False)]


def field(rng):
    kind = rng.randrange(8)
    plain = "".join(rng.choice("abc ;") for _ in range(rng.randrange(6)))
    if kind < 3:
        return plain or "x"
    if kind == 3:
        return 'a"b' + plain  # a quote inside an unquoted field is itself
    inner = "".join(rng.choice(['""', "\n", ",", "a", "b", "\r\n", " "]) for _ in range(rng.randrange(9)))
    return f'"{inner or "y"}"'


def document(rng, lines, end="\n"):
    rows = [",".join(field(rng) for _ in range(3)) for _ in range(lines)]
    return end.join(["one,two,three", *rows]) + (end if rng.random() < 0.5 else "")


@pytest.mark.parametrize("seed", range(3))
def test_random_files_in_small_splits(spark, tmp_path, seed):
    rng = random.Random(seed)
    text = document(rng, 40, rng.choice(["\n", "\r\n"]))
    path = tmp_path / "extract.csv"
    path.write_bytes(text.encode())
    want = expected(text, 3)
    for size in (67, 1 << 20):
        found, rows = read(spark, path, size)
        assert rows == want
    with splits_of(spark, 67):
        found = extract.read_extract(spark, str(path), RUN_TS, multi_line=True)
        assert found.rows.select("source_block").distinct().count() > 3
        assert records.read_lines(spark, str(path)).rdd.getNumPartitions() > 5


def test_many_lines_of_a_split_are_folded_in_numbers(spark, tmp_path):
    rng = random.Random(9)
    text = document(rng, 900)
    path = tmp_path / "extract.csv"
    path.write_bytes(text.encode())
    for size in (1500, 1 << 20):
        assert read(spark, path, size)[1] == expected(text, 3)
    with splits_of(spark, 1 << 20):
        splits = records._splits(records.read_lines(spark, str(path)))
        # The longest list of the fold has one element for 64 lines at most.
        plan = splits._jdf.queryExecution().optimizedPlan().toString()
        lists = [k for k, line in enumerate(plan.splitlines()) if "collect_list" in line]
        folds = [k for k, line in enumerate(plan.splitlines()) if "bit_or" in line]
        assert lists and folds and max(lists) < min(folds)


def test_a_record_over_many_splits(spark, tmp_path):
    long = "\n".join(f"line {k}, with ""no quote" for k in range(200))
    text = f'a,b\n1,"{long}"\n2,"x"\n"",""\n3,"{long}\n"\n'
    path = tmp_path / "extract.csv"
    path.write_text(text)
    _, rows = read(spark, path, 64)
    assert rows == [("1", long), ("2", "x"), (None, None), ("3", long + "\n")]


def test_whole_files_without_breaks_are_not_put_in_order(spark, tmp_path):
    path = tmp_path / "extract.csv"
    path.write_text('a,b\n' + '"1, 2",x\n' * 50)
    lines = records.read_lines(spark, str(path))
    assert not any(r.broken for r in records._splits(lines).collect())
    assert len(read(spark, path, 64)[1]) == 50


def test_folders_headers_and_blank_lines(spark, tmp_path):
    folder = tmp_path / "extract"
    folder.mkdir()
    (folder / "a.csv").write_text('\n"na\nme",v\n\n"x\n\ny",1\n \n')
    (folder / "b.csv").write_text('"na\nme",v\nz,"2\n"\n')
    found, rows = read(spark, folder, 8)
    assert found.names == ("name", "v")
    assert sorted(rows) == [("x\n\ny", "1"), ("z", "2\n")]
    (folder / "b.csv").write_text('"na\nmes",v\nz,"2\n"\n')
    with pytest.raises(ValueError, match="different headers"):
        read(spark, folder, 8)


def test_an_open_quote_at_the_end_is_refused(spark, tmp_path):
    path = tmp_path / "extract.csv"
    path.write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="does not end"):
        read(spark, path, 4)


def test_over_long_records(spark, tmp_path):
    path = tmp_path / "extract.csv"
    path.write_text('a,b\n1,"x\ny",3\n2\n"p\n,q",r\n')
    with pytest.raises(PySparkException, match="more fields"):
        read(spark, path, 5)
    found, rows = read(spark, path, 5, strict=False)
    assert rows == [("2", None), ("p\n,q", "r")]
    with splits_of(spark, 5):
        assert [r.line for r in found.rejected.collect()] == ['1,"x\ny",3']


def test_a_header_alone(spark, tmp_path):
    path = tmp_path / "extract.csv"
    path.write_text("a,b\n")
    assert read(spark, path, 4)[1] == []
