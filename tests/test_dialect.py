"""SRC1: separators, columns by name and line breaks in fields, against Python's csv module."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from adlens.session import isolated
from adlens.sources import dialect, readers


def put(path, name, text, encoding="utf-8"):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "wb") as f:
        f.write(text.encode(encoding))


def rows_of(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_columns_are_matched_by_name(spark, tmp_dir):
    put(tmp_dir, "a.csv", "kwd_id,imp\n1,10\n")
    put(tmp_dir, "b.csv", "imp,kwd_id\n20,2\n")
    put(tmp_dir, "c.csv", "kwd_id;click;imp\n3;5;30\n")
    df = readers.read_csv_text(spark, tmp_dir)
    assert df.columns == ["kwd_id", "imp", "click"]
    assert rows_of(df, df.columns) == [("1", "10", None), ("2", "20", None), ("3", "30", "5")]


@pytest.mark.parametrize("sep", dialect.SEPARATORS)
def test_separators_are_found(spark, tmp_dir, sep):
    out = io.StringIO()
    w = csv.writer(out, delimiter=sep, lineterminator="\n")
    data = [[str(i), f"a{sep}b, c; d | e\t{i}", 'say "x"', "2024-01-0" + str(i)] for i in range(1, 9)]
    w.writerows([["id", "text", "quote", "day"], *data])
    put(tmp_dir, "a.csv", out.getvalue())
    assert rows_of(readers.read_csv_text(spark, tmp_dir), ["id", "text", "quote", "day"]) == sorted(map(tuple, data))


def test_a_separator_that_is_not_clear_is_an_error(spark, tmp_dir):
    put(f"{tmp_dir}/two", "a.csv", "a,b;c\n1,2;3\n4,5;6\n")
    with pytest.raises(ValueError, match="not clear"):
        readers.read_csv_text(spark, f"{tmp_dir}/two")
    assert readers.read_csv_text(spark, f"{tmp_dir}/two", sep=";").columns == ["a,b", "c"]
    put(f"{tmp_dir}/ragged", "a.csv", "a,b\n1;2\n3\n")
    with pytest.raises(ValueError, match="not clear"):
        readers.read_csv_text(spark, f"{tmp_dir}/ragged")
    put(f"{tmp_dir}/one", "a.csv", "name\nx\ny\n")
    assert rows_of(readers.read_csv_text(spark, f"{tmp_dir}/one"), ["name"]) == [("x",), ("y",)]
    put(f"{tmp_dir}/none", "a.csv", "\n")
    with pytest.raises(ValueError, match="no records"):
        readers.read_csv_text(spark, f"{tmp_dir}/none")


def test_encodings_are_found_by_file(spark, tmp_dir):
    put(tmp_dir, "a.csv", "id,name\n1,캠페인\n")
    put(tmp_dir, "b.csv", "name;id\n캠페인;2\n", "cp949")
    put(tmp_dir, "c.csv", "﻿id\tname\r\n3\t캠페인\r\n")
    df = readers.read_csv_text(spark, tmp_dir)
    assert rows_of(df, ["id", "name"]) == [(str(i), "캠페인") for i in (1, 2, 3)]
    put(tmp_dir, "d.csv", "id,name\n1,ok\n")
    with open(f"{tmp_dir}/d.csv", "ab") as f:
        f.write(b"2,\xff\xff\n")
    with pytest.raises(ValueError, match="no encoding"):
        readers.read_csv_text(spark, tmp_dir)


def random_csv(rnd, n):
    bits = ["x", "line\nbreak", "\n\n", 'a "quote"', ";", ",", "\r\n", "", "é", '"', "\n,\n", " "]
    data = [["id", "text", "note"]] + [[str(i), "".join(rnd.choices(bits, k=rnd.randint(0, 5))), "n" + rnd.choice(bits)] for i in range(n)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(data)
    return out.getvalue()


def test_line_breaks_over_many_splits(spark, tmp_dir):
    rnd = random.Random(2)
    for name in ("a.csv", "b.csv"):
        put(tmp_dir, name, random_csv(rnd, 400))
    put(tmp_dir, "c.csv", "id,text,note\n" + 'x,"' + "long\n" * 400 + '",end\n')
    own = spark.newSession()
    for k, v in (("spark.sql.files.maxPartitionBytes", "500"), ("spark.sql.files.openCostInBytes", "0")):
        own.conf.set(k, v)
    df = readers.read_csv_text(own, tmp_dir, multi_line=True, place="at", corrupt="bad")
    assert dialect.lines(own, tmp_dir).rdd.getNumPartitions() > 20           # several tasks a file
    want = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .schema("id string, text string, note string").csv(tmp_dir))
    got = rows_of(df, ["id", "text", "note"])
    assert got == rows_of(want, ["id", "text", "note"]) and len(got) == 801
    assert df.where("bad is not null").count() == 0
    order = [r.id for r in df.where(F.col("at.file").endswith("a.csv")).orderBy("at").collect()]
    assert order == [str(i) for i in range(400)]


def test_a_quote_never_closed_is_an_error(spark, tmp_dir):
    put(tmp_dir, "a.csv", 'id,text\n1,"open\n2,x\n')
    with pytest.raises(ValueError, match="never closed"):
        readers.read_csv_text(spark, tmp_dir, multi_line=True)


def test_survey_reads_the_files_once(spark, tmp_path):
    for k, text in enumerate(["a,b\n1,2\n", "a;b\n1;2\n"]):
        (tmp_path / f"{k}.csv").write_text(text)
    told = dialect.survey(dialect.lines(spark, str(tmp_path)), ["UTF-8", "MS949"])
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and "FileScan parquet" in plan
    assert sorted((r["sep"], r["header"], r["charset"]) for r in told.collect()) == [(",", "a,b", "UTF-8"), (";", "a;b", "UTF-8")]


def test_survey_plain_records_beside_others(spark, tmp_path):
    rows = ["a,b", "plain,1", "가나,2", 'x,"q,r"']
    for name, charset in (("u", "UTF-8"), ("m", "MS949"), ("plain", "ascii")):
        own = [r for r in rows if charset != "ascii" or r.isascii()]
        (tmp_path / f"{name}.csv").write_bytes("\n".join(own).encode("cp949" if charset == "MS949" else charset))
    (tmp_path / "none.csv").write_bytes(b"a,b\n\xff\xff,1\n")
    own = isolated(spark, {"spark.sql.legacy.javaCharsets": "true", "spark.sql.legacy.codingErrorAction": "true"})
    told = dialect.survey(dialect.lines(own, str(tmp_path)), ["UTF-8", "MS949", "EUC-KR"]).collect()
    assert {r["file"].rsplit("/", 1)[1]: (r["charset"], r["sep"]) for r in told} == {
        "u.csv": ("UTF-8", ","), "m.csv": ("MS949", ","), "plain.csv": ("UTF-8", ","), "none.csv": (None, ",")}
