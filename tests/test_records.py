"""Records over line ends, read from many splits."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyroute.sources import dumps, files, records


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "100")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set(name, before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def csv_text(rng, n):
    letters = ["a", "é", " ", '""', ",", "\n", "x'y", "\n\n", "\r\n", "#", "\\"]
    lines = ["id,who"]
    for k in range(n):
        value = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 3, 40])))
        kind = rng.random()
        lines.append(f'{k},"{value}"' if kind < 0.7 else f'{k},5" pipe "x' if kind < 0.8 else f"{k},")
    return "\n".join(lines) + "\n"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_csv_fields_over_lines_and_splits(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    for k in range(2):
        (tmp_path / f"{k}.csv").write_text(csv_text(rng, 60), newline="")
    path = str(tmp_path)
    assert files.csv_records(spark, path).select("file").distinct().count() == 2
    read = files.read_csv_records(spark, path)
    want = files.read_csv_text(spark, path, multi_line=True)

    def plain(df):  # the file reader turns line ends in quotes into plain ones
        return rows(df.select("id", F.regexp_replace("who", "\r\n", "\n").alias("who")))

    assert read.columns == ["id", "who"] and plain(read) == plain(want) and len(plain(read)) == 120


def test_csv_in_latin_letters_and_without_a_last_line_end(spark, tmp_path, small_splits):
    text = 'Lead\nNumber,b\n"1\n'.replace("Lead\nNumber", '"Lead\nNumber"') + 'é",2\n3,"é\n"'
    (tmp_path / "a.csv").write_bytes(text.encode("latin-1"))
    df = files.read_csv_records(spark, str(tmp_path / "a.csv"), files.LATIN)
    assert df.columns == ["Lead Number", "b"]
    assert rows(df) == [("1\né", "2"), ("3", "é\n")]


def test_records_are_numbered_in_file_order(spark, tmp_path, small_splits):
    lines = [f'{k},"{"x" * (k % 9)}\n{k}"' if k % 3 else f"{k},y" for k in range(200)]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    found = files.csv_records(spark, str(tmp_path / "a.csv")).orderBy("record").collect()
    assert [r["record"] for r in found] == list(range(1, 201))
    assert [r["text"] for r in found] == lines and all(r["whole"] for r in found)
    assert [r["ended"] for r in found] == [True] * 199 + [False]


def test_a_quote_that_is_never_closed_is_not_gathered(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('a,b\n1,2\n3,"4\n' + "5,6\n" * 300)
    found = records.csv_records(spark, str(tmp_path / "a.csv"), longest=500)
    counts = {r["whole"]: r["count"] for r in found.groupBy("whole").count().collect()}
    assert counts == {True: 2, False: 301}


PIECES = ["a", "(", ")", "),(", ",", "\n", "--", "/*", ";", "é", "#", " "]
ESCAPES = {"\\'": "'", "''": "'", "\\\\": "\\", "b": "b"}


def dump(rng, n, gap):
    """Tuples as text, and the values they hold (white space around one does not count)."""
    out, want = [], []
    for k in range(n):
        parts = [rng.choice(PIECES + list(ESCAPES)) for _ in range(rng.choice([0, 1, 5, 30]))]
        out.append(f"({k},{gap}'{''.join(parts)}'{gap},NULL)")
        value = "".join(ESCAPES.get(p, p) for p in parts).strip()
        want.append((str(k), None if value.upper() in ("", "NULL") else value, None))
    return out, want


@pytest.mark.parametrize("gap,between", [("", ","), ("\n  ", ",\n"), (" ", " ,\n-- it's one\n")])
def test_dump_tuples_over_lines_and_splits(spark, tmp_path, small_splits, gap, between):
    rng = random.Random(len(between))
    tuples, want = dump(rng, 150, gap)
    text = ("-- a dump, don't\n/* it's */ SET NAMES x;\nINSERT INTO `t` (`a`, b, c) VALUES "
            + between.join(tuples[:90]) + ";\nUNLOCK TABLES;\nINSERT INTO `t` (`a`, b, c) VALUES\n"
            + between.join(tuples[90:]) + ";\n")
    (tmp_path / "d.sql").write_text(text)
    good, failed = dumps.read_dump_checked(spark, str(tmp_path / "d.sql"), ["a", "b", "c"])
    got = [tuple(r) for r in good.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert failed.count() == 0


def test_dump_without_line_ends_and_with_parts_that_cannot_be_read(spark, tmp_path, small_splits):
    text = "INSERT INTO t (a, b) VALUES (1,'x'),(2),(3, 'it''s (y)'),garbage (4,5),(6,NOW()),(7,'q"
    (tmp_path / "d.sql").write_text(text)
    good, failed = dumps.read_dump_checked(spark, str(tmp_path / "d.sql"), ["a", "b"])
    assert rows(good) == [("1", "x"), ("3", "it's (y)")]
    assert sorted(r[0] for r in failed.collect()) == sorted(
        ["(2)", ",garbage (4,5)", ",(6,NOW()", ")", ",(7,'q"])


def test_a_dump_cut_off_in_a_tuple(spark, tmp_path):
    (tmp_path / "d.sql").write_text("INSERT INTO t (a, b) VALUES (1,2),(3,4")
    good, failed = dumps.read_dump_checked(spark, str(tmp_path / "d.sql"), ["a", "b"])
    assert rows(good) == [("1", "2")] and rows(failed) == [(",(3,4",)]


def test_plan_holds_no_python(spark, tmp_path):
    (tmp_path / "d.sql").write_text("(1,2)")
    plan = dumps.read_dump(spark, str(tmp_path), ["a", "b"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
