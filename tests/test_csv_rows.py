"""Rows of CSV files cut by byte ranges, against a reader that walks through the whole text."""

import random

import pytest
from pyspark.sql import functions as F

from tillwise.sources import csv_rows
from tillwise.sources.tables import read_upload


def walked(text):
    """Rows of cells, character by character; every quote switches, two inside quotes are one."""
    rows, row, cell, inside, i = [], [], "", False, 0
    while i < len(text):
        c = text[i]
        if c == '"' and inside and text[i + 1 : i + 2] == '"':
            cell, i = cell + c, i + 1
        elif c == '"':
            inside = not inside
        elif c == "," and not inside:
            row, cell = [*row, cell], ""
        elif c in "\r\n" and not inside:
            i += c == "\r" and text[i + 1 : i + 2] == "\n"
            rows, row, cell = [*rows, [*row, cell]], [], ""
        else:
            cell += c
        i += 1
    return [r for r in [*rows, [*row, cell]] if any(x.strip(" \t\r\n") for x in r)]


@pytest.fixture()
def small_ranges(spark):
    """Files are cut into ranges of some hundred bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def read_all(spark, path, names):
    rows = sorted(read_upload(spark, path).collect(), key=lambda r: r._tillwise_row)
    assert [r._tillwise_row for r in rows] == list(range(len(rows)))
    return [[r[n] for n in names] for r in rows]


def random_text(seed, line_end, odd_quotes):
    draw = random.Random(seed)
    pieces = ["plain", "", "12.5", "漢字", '"a,b"', '"two\nlines"', '"say ""hi"""', '"\r\n\n,\r"', '""', '"' + "long\n" * 30 + '"', " "]
    if odd_quotes:
        pieces += ['5" pipe"', 'x"y,\n"z', '"a""b"c']
    body = "".join(",".join(draw.choices(pieces, k=draw.choice((3, 3, 3, 2, 4, 1)))) + line_end for _ in range(60))
    return f"one,two,three{line_end}" + body


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
@pytest.mark.parametrize("odd_quotes", [False, True])
def test_rows_equal_those_of_a_walk(spark, tmp_path, small_ranges, line_end, odd_quotes):
    text = random_text(1, line_end, odd_quotes)
    path = tmp_path / "t.csv"
    path.write_text(text, newline="")
    wanted = [[*r, "", ""][:3] for r in walked(text)[1:]]
    assert csv_rows.read_lines(spark, str(path)).rdd.getNumPartitions() > 3
    assert read_all(spark, str(path), ("one", "two", "three")) == wanted


def test_too_many_open_ranges_to_broadcast(spark, tmp_path, small_ranges, monkeypatch):
    text = random_text(7, "\n", True)
    (tmp_path / "t.txt").write_text(text, newline="")
    monkeypatch.setattr(csv_rows, "broadcast_if_small", lambda df: df)
    assert read_all(spark, str(tmp_path / "t.txt"), ("one", "two", "three")) == [[*r, "", ""][:3] for r in walked(text)[1:]]


@pytest.mark.parametrize("body", ['a,b\n1,"never\nclosed\n' + "x\n" * 400 + "x", "a,b\r1,2\r\r3,4", "a,b\n1,2", '\n , \n"a",b\n1,2\n,\n\n'])
def test_odd_files(spark, tmp_path, small_ranges, body):
    (tmp_path / "t.csv").write_text(body, newline="")
    assert read_all(spark, str(tmp_path / "t.csv"), ("a", "b")) == [[*r, ""][:2] for r in walked(body)[1:]]


def test_quotes_of_one_file_do_not_reach_the_next(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text('a,b\n1,"open\nrow\n', newline="")
    (tmp_path / "b.csv").write_text('a,b\n2,"x\ny"\n3,z\n', newline="")
    assert read_all(spark, str(tmp_path), ("a", "b")) == [["1", "open\nrow"], ["2", "x\ny"], ["3", "z"]]
    with pytest.raises(ValueError, match="Unsupported"):
        read_upload(spark, str(tmp_path / "a.parquet"))


def test_signs_are_swapped_without_taking_text_apart(spark):
    """Translating goes through every character of every cell, which was most of the time of reading an upload."""
    from tillwise.functions.parsing import WHITE_SPACE
    from tillwise.sources.csv_rows import CELL_END, ROW_END, UNKNOWN, is_blank, rows_of

    texts = {
        f'a{CELL_END}b,"x{ROW_END},y"\rz': [[f"a{UNKNOWN}b", f"x{UNKNOWN},y"], ["z"]],
        "\U0001f600,é": [["\U0001f600", "é"]],
        WHITE_SPACE.replace("\r", "").replace("\n", "") + ',"\n"': [],
        "​": [["​"]],
        "\x00,": [["\x00", ""]],
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    read = df.select("t", F.filter(rows_of(F.col("t")), lambda row: ~is_blank(row)).alias("rows"))
    assert "translate" not in read._jdf.queryExecution().optimizedPlan().toString()
    assert {r.t: r["rows"] for r in read.collect()} == texts
