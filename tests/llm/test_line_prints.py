"""A line's fingerprints are stored with its block: equal lines are found from them, without texts."""

from __future__ import annotations

import contextlib
import io

import pyarrow as pa

from cohortlens.llm import lines, packed

SCHEMA = "doc_id long, text string"


def test_equal_lines_are_found_without_texts(spark, monkeypatch):
    """The step that asks about equal lines read and hashed every text again before."""
    plans = {}
    write = lines.materialise

    def recorded(df, name):
        with contextlib.redirect_stdout(io.StringIO()) as out:
            df.explain("formatted")
        plans[name] = out.getvalue()
        return write(df, name)

    monkeypatch.setattr(lines, "materialise", recorded)
    df = spark.createDataFrame([(2, "same line\nother"), (1, "same line"), (None, "same line\n\n \n"), (1, None)], SCHEMA)
    got = {(r.doc_id, r.n_lines, r.n_equal, r.n_near) for r in lines.report(df).collect()}
    assert got == {(2, 2, 1, 0), (1, 1, 0, 0), (None, 4, 1, 0), (1, 1, 0, 0)}
    assert "line_prints#" in plans["lines-equal"] and "texts#" not in plans["lines-equal"]
    assert "texts#" in plans["lines-segments"]


def test_prints_tell_lines_documents_and_blanks():
    texts = ["a\n\nb", "", "\n \n" + " " * 20, "a\0x\na\0y\né\n\U0001f600\n" + "w " * 400]
    every = "\n".join(texts).split("\n")
    known = lines.Lines({"doc_ids": [4, None, 4, 1], **lines.prints(texts)})
    assert known.doc.tolist() == [0, 0, 0, 1, 2, 2, 2, 3, 3, 3, 3, 3] and known.edges.tolist() == [0, 3, 4, 7, 12]
    compared = [k for k, x in enumerate(every) if x.strip() or len(x) >= lines.BLANK_CHARS]
    assert known.compared.tolist() == compared
    assert len(set(known.own.tolist())) == len(set(known.where.tolist())) == len({every[k] for k in compared})
    assert known.own.tolist() != known.where.tolist()
    again = lines.Lines({"doc_ids": [1], **lines.prints(["a"])})
    assert (again.own[0], again.where[0]) == (known.own[0], known.where[0])


def test_a_block_of_blank_lines_has_no_prints():
    known = lines.Lines({"doc_ids": [1, 2], **lines.prints(["", "\n"])})
    assert known.doc.tolist() == [0, 1, 1] and not len(known.compared)
    assert not len(known.standing(None, 4)) and not len(lines.Segments([]).keys()[0])


def test_workers_keep_no_tables_of_powers(spark):
    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [packed.rolling.cache_info().currsize] * batch.num_rows})

    df = spark.createDataFrame([(k, f"line {k}\nline {k + 1} of them") for k in range(200)], SCHEMA).repartition(8)
    assert lines.report(df).count() == 200
    assert {r.n for r in spark.range(64).repartition(16).mapInArrow(held, "n long").collect()} == {0}
