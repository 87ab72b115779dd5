"""Quoted line breaks, doubled quotes, malformed records, headers: against the csv module, for splits of any size."""

from __future__ import annotations

import csv
import io
import random

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortlens.sources import readers, records, writers


@pytest.fixture(params=["128m", "200b"])
def splits(spark, request):
    """Whole files as one split, and lines cut over many."""
    before = spark.conf.get("spark.sql.files.openCostInBytes"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield
    spark.conf.set("spark.sql.files.openCostInBytes", before[0])
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[1])


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode())


def cells(rng):
    return "".join(rng.choice(["a", "b,", '"', "\n", "é", " ", "\r\n", '""']) for _ in range(rng.randint(0, 6)))


def test_records_against_the_csv_module(spark, tmp_path, splits):
    rng, want = random.Random(4), []
    for f in range(4):
        buffer = io.StringIO()
        out = csv.writer(buffer, lineterminator="\r\n" if f == 2 else "\n")
        out.writerow([" id", "text, of it", "n"])
        for k in range(120):
            text = f"plain{k}" if f == 1 or k % 3 == 0 else cells(rng)
            text = text.replace("\r", "") if f == 2 else text
            out.writerow([f"{f}-{k}", text, k])
            want.append((f"{f}-{k}", text or None, str(k)))
        put(tmp_path, f"f{f}.csv", ("﻿" if f == 3 else "") + buffer.getvalue())
    load = records.read_csv_records(spark, str(tmp_path))
    assert load.columns == load.rows.columns == ["id", "text, of it", "n"]
    assert rows(load.rows) == sorted(want, key=lambda r: (r[0], r[2]))
    assert load.rejects.count() == 0 and load.strict().count() == len(want)


def test_a_record_longer_than_several_splits(spark, tmp_path, splits):
    long = "\n".join(f'line {k} "" of one cell' for k in range(60))
    put(tmp_path, "a.csv", f'id,text\n1,"{long}"\n2,next\n3,"{long}"\n')
    got = dict(tuple(r) for r in records.read_csv_records(spark, str(tmp_path)).rows.collect())
    assert got == {"1": long.replace('""', '"'), "2": "next", "3": long.replace('""', '"')}


def test_rejects(spark, tmp_path, splits, monkeypatch):
    monkeypatch.setattr(records, "MAX_LINES", 5)
    put(tmp_path, "a.csv", 'a,b\n1,2\n3\n4,5,6\n\n7,"x\ny"\n8,"' + "z\n" * 9 + '"\n9,10\n')
    put(tmp_path, "b.csv", 'a,b\n11,12\n13,"open\n14,15\n')
    load = records.read_csv_records(spark, str(tmp_path))
    assert rows(load.rows) == [("1", "2"), ("11", "12"), ("7", "x\ny"), ("9", "10")]
    got = sorted((r.reason, r.record) for r in load.rejects.collect())
    too_long = ['8,"z', '"', *["z"] * 8]
    assert got == sorted(
        [(records.CELLS, "3"), (records.CELLS, "4,5,6"), (records.UNCLOSED, '13,"open'), (records.UNCLOSED, "14,15"), *[(records.TOO_LONG, x) for x in too_long]]
    )
    assert {r.file.rsplit("/", 1)[1] for r in load.rejects.where(F.col("reason") == records.UNCLOSED).collect()} == {"b.csv"}
    with pytest.raises(PySparkException, match="wrong number of cells|quote is not closed|too many lines"):
        readers.read_text_table(spark, str(tmp_path)).count()


def test_headers(spark, tmp_path):
    put(tmp_path / "x", "a.csv", 'a,"b\nc",a,\n1,2,3,4\n')
    assert records.read_csv_records(spark, str(tmp_path / "x")).rows.columns == ["a", "b\nc", "a2", "_c3"]
    put(tmp_path / "x", "b.csv", "a,other,a,\n1,2,3,4\n")
    with pytest.raises(PySparkException, match="another header"):
        records.read_csv_records(spark, str(tmp_path / "x")).rows.count()
    put(tmp_path / "y", "a.csv", "")
    assert records.read_csv_records(spark, str(tmp_path / "y")).rows.count() == 0
    put(tmp_path / "z", "a.csv", "a,b\n")
    put(tmp_path / "z", "b.csv", "a,b")
    load = records.read_csv_records(spark, str(tmp_path / "z"))
    assert load.rows.columns == ["a", "b"] and load.rows.count() == load.rejects.count() == 0


def test_files_without_quoted_breaks_are_not_shuffled(spark, tmp_path):
    """Their lines meet the odd files' names as a broadcast only."""
    put(tmp_path, "a.csv", "a,b\n1,2\n")
    plan = records.records(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    plain = plan[: plan.index("Join Inner", plan.index("LeftAnti"))] if "Join Inner" in plan[plan.index("LeftAnti") :] else plan
    assert "LeftAnti" in plain and "rightHint=(strategy=broadcast)" in plain


def test_lines_of_a_split_meet_in_its_task(spark, tmp_path):
    """No shuffle and no window gathers the lines of whole splits; what splits cut is a small table."""
    put(tmp_path, "a.csv", "a,b\n" + "".join(f'{k},"one\ntwo ""{k}"""\n' for k in range(500)))
    load = records.read_csv_records(spark, str(tmp_path))
    assert rows(load.rows) == sorted((str(k), f'one\ntwo "{k}"') for k in range(500))
    plan = load.rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("MapInArrow" in line for line in plan) and not any("Window [" in line and "quotes" in line for line in plan)


def test_landing_is_counted_while_it_is_written(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS landed")
    put(tmp_path / "raw", "studentInfo.csv", 'id_student,code_module\n1,"A\nB"\n2,C,too many\n3,D\n')
    put(tmp_path / "raw", "studentAssessment.csv", "id_student\n1\n")
    put(tmp_path / "raw", "assessments.csv", "id_assessment,date\n")
    loads = readers.read_raw_records(spark, str(tmp_path / "raw"))
    audit = writers.land_records(loads, "landed", str(tmp_path / "out"))
    assert rows(audit) == [("assessments", 0, 0), ("student_assessment", 1, 0), ("student_info", 2, 1)]
    assert rows(spark.table("landed.student_info")) == [("1", "A\nB"), ("3", "D")]
    assert [r.record for r in spark.table("landed.student_info_rejects").collect()] == ["2,C,too many"]
    assert not spark.catalog.tableExists("landed.assessments_rejects")


def test_csv_sinks_keep_cells_as_they_are(spark, tmp_path):
    cells = [(1, 'a "b" c'), (2, " x\ny, "), (3, None), (4, "\\")]
    writers.write_csv(spark.createDataFrame(cells, "id int, t string"), str(tmp_path / "out"))
    assert rows(readers.read_text_table(spark, str(tmp_path / "out"))) == [(str(i), t) for i, t in cells]
