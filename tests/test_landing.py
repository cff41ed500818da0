"""Landing files read by ranges of bytes, against Spark's reading of whole files."""

import random

import pytest
from pyspark.errors import PySparkException

from innledger.sources.landing import REJECTED, read_landing, records

HEAD = "customer_id,name,email\n"
PAID = "payment_id,amount,currency\n"


@pytest.fixture
def ranges_of(spark):
    """Sets the largest range of a file, and puts it back."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def set_to(size):
        for k in keys:
            spark.conf.set(k, size)

    yield set_to
    for k, v in before.items():
        spark.conf.set(k, v)


def odd_cell(rng):
    parts = ["a", "B c", ",", '""', "\n", "\n\n", "\r\n", "é", "  ", "1,200", "x" * 30]
    return '"' + "".join(rng.choices(parts, k=rng.randint(0, 9))) + '"'


def landed(folder, seed, rows=400):
    rng = random.Random(seed)
    text = HEAD
    for k in range(rows):
        number = rng.choice([str(k), f'"{k}"', "", "12x"])
        name = rng.choice([odd_cell(rng), "plain", "", " blank ", odd_cell(rng)])
        last = rng.choice(["a@b", odd_cell(rng), "", "a@b,too many"])
        text += f"{number},{name},{last}" + rng.choice(["\n", "\n", "\n\n"])
    (folder / f"part-{seed}.csv").write_bytes(text.rstrip("\n").encode())


def counted(df):
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=repr)


@pytest.mark.parametrize("size", [64, 700, 5000, 1 << 27])
def test_ranges_read_what_whole_files_hold(spark, tmp_path, ranges_of, size):
    for seed in range(3):
        landed(tmp_path, seed)
    whole = read_landing(spark, str(tmp_path), "customers")
    want = counted(whole.drop(REJECTED))
    ranges_of(size)
    found = read_landing(spark, str(tmp_path), "customers", ranges=True)
    assert counted(found.drop(REJECTED)) == want and len(want) == 1200
    assert found.columns == whole.columns and found.dtypes == whole.dtypes
    rejected = [r[REJECTED] for r in found.collect() if r[REJECTED] is not None]
    assert len(rejected) == sum(r[REJECTED] is not None for r in whole.collect()) > 0


def test_cells_of_other_types(spark, tmp_path, ranges_of):
    cells = ["1.5", '"2.5"', "", '"1,200.50"', "-3", '"4\n"', "NaN", "1e3"]
    (tmp_path / "one.csv").write_text(
        PAID + "".join(f'{k},{x},"a\nb"\n' for k, x in enumerate(cells * 20)) + "too,few\n"
    )
    whole = read_landing(spark, str(tmp_path), "payments").collect()
    ranges_of(128)
    found = read_landing(spark, str(tmp_path), "payments", ranges=True).collect()
    plain = lambda rows: sorted((repr(tuple(r)[:-1]), r[REJECTED] is None) for r in rows)
    assert plain(found) == plain(whole) and len(found) == 161
    assert any(r[REJECTED] for r in found)


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path, ranges_of):
    landed(tmp_path, 7, 2000)
    ranges_of(4096)
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 5
    plan = records(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "multiLine" not in plan
    # Of whole lines there is one exchange, by file and range; the pieces ranges share follow.
    whole = [x for x in plan.splitlines() if "REPARTITION_BY_COL" in x]
    assert whole and all("hashpartitioning(file" in x and "range" in x for x in whole)


def test_a_cell_over_many_ranges(spark, tmp_path, ranges_of):
    cell = "line, and more\n" * 500
    (tmp_path / "one.csv").write_text(HEAD + f'1,"{cell}",a\n2,"{cell}{cell}","b"\n3,c,d')
    ranges_of(256)
    found = read_landing(spark, str(tmp_path), "customers", ranges=True).collect()
    assert sorted((r.customer_id, r.name, r.email) for r in found) == [
        ("1", cell, "a"), ("2", cell * 2, "b"), ("3", "c", "d"),
    ]


@pytest.mark.parametrize("text", ["", "\n\n", "\r\n"])
def test_no_records(spark, tmp_path, text):
    (tmp_path / "one.csv").write_text(HEAD + text)
    assert read_landing(spark, str(tmp_path), "customers", ranges=True).collect() == []


@pytest.mark.parametrize("bad", ['1,5" pipe,a\n2,6" pipe,b\n', '1,"a"b,c\n', '1,"never closed,a\n2,b,c\n'])
def test_quotes_inside_cells_fail(spark, tmp_path, ranges_of, bad):
    (tmp_path / "one.csv").write_text(HEAD + bad)
    ranges_of(16)
    with pytest.raises(PySparkException, match="quotes inside a cell"):
        read_landing(spark, str(tmp_path), "customers", ranges=True).collect()


def test_types_are_not_inferred_from_ranges(spark, tmp_path):
    with pytest.raises(ValueError, match="declared"):
        read_landing(spark, str(tmp_path), "customers", infer=True, ranges=True)
