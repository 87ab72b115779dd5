"""Lines below 20 characters: equal ones at every length, near ones from three characters on, against brute force."""

from __future__ import annotations

import random

import brute
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from cohortlens.llm import lines
from cohortlens.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def plain(rows: list[tuple]) -> list[tuple]:
    """The report of all lines that are not blank; identifiers are different numbers."""
    first: dict[str, tuple] = {}
    for i, t in sorted(rows):
        for k, line in enumerate((t or "").split("\n")):
            if line.strip() or len(line) >= 20:
                first.setdefault(line, (i, k))
    long = [x for x in first if len(x) >= 3]
    links = [(a, b) for n, a in enumerate(long) for b in long[n + 1 :] if abs(len(a) - len(b)) <= 2 and brute.edits(a, b) <= 2]
    named = brute.component_of(list(first), links)
    best: dict[str, tuple] = {}
    for line, c in named.items():
        best[c] = min(best.get(c, (first[line], line)), (first[line], line))
    out = []
    for i, t in rows:
        every = (t or "").split("\n")
        equal = [x in first and first[x] != (i, k) for k, x in enumerate(every)]
        near = [x in first and not e and best[named[x]][1] != x for x, e in zip(every, equal, strict=True)]
        kept = "\n".join(x for x, e, n in zip(every, equal, near, strict=True) if not e and not n)
        out.append((i, len(every), sum(equal), sum(near), brute.sha(kept)))
    return out


@pytest.fixture(scope="module")
def texts():
    """Short lines of every length up to 24, with repeats and few edits; blank lines; whole repeats of a document."""
    rng = random.Random(5)
    pool = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé .") for _ in range(n)) for n in range(1, 25) for _ in range(3)]
    for line in rng.sample(pool, 20):
        at = rng.randrange(len(line))
        pool.append(line[:at] + rng.choice(["", "x", line[at] + "q"]) + line[at + 1 :])
    pool += ["", " ", "\t", "　", " " * 25, "nineteen chars here", "twenty-one chars here", "nineteen chars herex"]
    out = ["\n".join(rng.sample(pool, rng.randint(1, 6))) for _ in range(40)]
    return list(enumerate([*out, out[3], "a\nb\nshort\nshort", "a\n\nb\nshort", None, ""]))


def test_short_lines_against_brute_force(spark, texts):
    df = spark.createDataFrame(texts, SCHEMA).repartition(3)
    got = [tuple(r) for r in lines.report(df).collect()]
    assert brute.ordered(got) == brute.ordered(plain(texts))


def test_a_whole_repeat_of_short_lines_goes(spark):
    df = spark.createDataFrame([(1, "One.\n\nTwo words."), (2, "One.\n\nTwo words."), (3, "\n"), (4, None)], SCHEMA)
    assert {r.doc_id: r.text for r in lines.deduped(df).collect()} == {1: "One.\n\nTwo words.", 3: "\n", 4: None}


def test_the_query_leaves_no_equal_lines(spark):
    """Every repeated line that is not blank goes, of whatever length."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    every = docs.select(F.explode(F.split("text", "\n")).alias("line")).where(r"line rlike '\\S'")
    repeats = every.count() - every.distinct().count()
    assert QUERIES["op5_line_dedup"](spark, str(DATA)).agg(F.sum("n_equal")).first()[0] == repeats
