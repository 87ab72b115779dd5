"""CSV records that may hold line breaks, read in parallel, and a table of those that are malformed.

A quoted cell may hold a newline, so where a line belongs depends on all quotes before it. A reader that takes a file as a whole gets that
right in one task per file. Here files are split as usual: every split counts its quotes, the parity of the
splits before tells whether it begins inside a cell, and within a split a running count tells the same of every line. Lines
that begin inside a cell belong to the record that the last line outside began, also when that lies in an
earlier split. A task joins the lines of its splits as they come; only the lines of a record that splits cut, or that has too many lines,
are shuffled. Files without an odd line have one record a line.

Records are parsed by the built-in CSV expression. A record with too few or too many cells, one whose quote is never
closed, and one of more than ``MAX_LINES`` lines (a stray quote swallows what follows it) go to ``rejects``, whole or line
by line, with the reason; nothing is cut or turned into nulls.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from cohortlens.session import materialise

#: Lines of one record at most.
MAX_LINES = 10_000
QUOTING = {"quote": '"', "escape": '"'}
# What a reject says.
TOO_LONG, UNCLOSED, CELLS = "record of too many lines", "quote is not closed", "wrong number of cells"


@dataclass
class CsvLoad:
    """``rows``: all well-formed records, every column as text. ``rejects``: file, reason, record."""

    rows: DataFrame
    rejects: DataFrame
    parsed: DataFrame
    columns: list[str]

    def strict(self) -> DataFrame:
        """The rows; reading them fails at the first malformed record."""
        text = F.concat(F.col("reason"), F.lit(" in "), F.col("file"), F.lit(": "), F.substring("record", 1, 200))
        # ``head`` ties the test to whole records: Spark must not try it on the lines they are made of
        fine = F.when(F.col("reason").isNull() | F.col("head"), F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
        return _named(self.parsed.where(fine), self.columns)

    def counts(self) -> tuple[Column, Column]:
        """Aggregates over ``parsed``: rows, rejects."""
        return F.count_if(F.col("reason").isNull()).alias("rows"), F.count_if(F.col("reason").isNotNull()).alias("rejects")


def _named(parsed: DataFrame, columns: list[str]) -> DataFrame:
    return parsed.select(*[F.col("cells").getField(f"c{k}").alias(c) for k, c in enumerate(columns)])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the files, with their split and a number that follows their order within it."""
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
        F.regexp_count("value", F.lit('"')).alias("quotes"),
    )


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split: whether it begins inside a quoted cell, and whether its file has a line with an odd number of quotes."""
    odd = F.col("quotes") % 2
    splits = lines.groupBy("file", "block", "length").agg((F.sum("quotes") % 2).alias("parity"), F.max(odd).alias("odd"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2).alias("inside")
    return splits.select("file", "block", "length", inside, (F.max("odd").over(W.partitionBy("file")) == 1).alias("spread"))


CUT = "file string, block long, seq long, own long, quotes int, record string, part boolean"


def _cutter(max_lines: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Records of the lines of whole splits, in their order. ``part``: a line of a record that begins or ends in another split, or has more
    than ``max_lines`` lines; ``own`` is the number of the line the record begins with, if this split has it."""
    schema = to_arrow_schema(_parse_datatype_string(CUT))
    names = ("file", "block", "seq", "value", "quotes", "inside")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, odd, own, whole = None, 0, None, True
        kept: list[tuple] = []  # lines of the open record
        out: list[tuple] = []

        def give_up() -> None:
            """The open record's lines go as they are."""
            out.extend((*at, n, own, q, v, True) for n, v, q in kept)
            kept.clear()

        def done() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * len(schema)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for file, block, seq, value, quotes, inside in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if (file, block) != at:
                    give_up()
                    at, odd, own, whole = (file, block), inside, None, not inside
                if not odd:
                    own, whole = seq, True
                kept.append((seq, value, quotes))
                odd ^= quotes & 1
                if not odd and whole and len(kept) <= max_lines:
                    out.append((*at, own, own, 0, value if len(kept) == 1 else "\n".join([v for _, v, _ in kept]), False))
                    kept.clear()
                elif not whole or len(kept) > max_lines:
                    whole = False
                    give_up()
            yield done()
        give_up()
        yield done()

    return cut


def _joined_parts(parts: DataFrame) -> DataFrame:
    """Records of lines that their split could not join: file, block and seq of the first line, record, reason."""
    # the record that is open where a split begins
    lasts = parts.groupBy("file", "block").agg(F.max("own").alias("last"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    open_at = F.last(F.when(F.col("last").isNotNull(), F.struct("block", F.col("last").alias("seq"))), ignorenulls=True).over(before)
    opened = lasts.select("file", "block", open_at.alias("opened"))
    own = F.when(F.col("own").isNotNull(), F.struct("block", F.col("own").alias("seq")))
    keyed = parts.join(opened, ["file", "block"]).withColumn("head", F.coalesce(own, "opened")).drop("own", "opened")
    # counts first: what is not one record in bounds is never collected
    sizes = keyed.groupBy("file", "head").agg(F.count(F.lit(1)).alias("n"), (F.sum("quotes") % 2 == 1).alias("never_closed"))
    bad = sizes.where(F.col("never_closed") | (F.col("n") > MAX_LINES)).select("file", "head", F.when(F.col("never_closed"), UNCLOSED).otherwise(TOO_LONG).alias("reason"))
    loose = keyed.join(bad, ["file", "head"]).select("file", "head", "record", "reason")
    lines_of = F.sort_array(F.collect_list(F.struct("block", "seq", "record")))
    whole = keyed.join(bad.drop("reason"), ["file", "head"], "left_anti").groupBy("file", "head").agg(lines_of.alias("lines"))
    whole = whole.select("file", "head", F.array_join(F.transform("lines", lambda x: x["record"]), "\n").alias("record"), F.lit(None).cast("string").alias("reason"))
    return loose.unionByName(whole).select("file", "head.block", "head.seq", "record", "reason")


def _spread_records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Records of files with odd lines: file, block and seq of the first line, record, reason."""
    # one row per split, broadcast: the lines keep their order
    files = F.broadcast(splits.select("file").distinct())
    placed = lines.join(files, "file", "left_semi").join(F.broadcast(splits.select("file", "block", "length", "inside")), ["file", "block", "length"], "left")
    changed = F.raise_error(F.concat(F.col("file"), F.lit(" has changed since it was first read, or is cut to other splits"))).cast("int")
    cut = placed.select("file", "block", "seq", "value", "quotes", F.coalesce("inside", changed).alias("inside")).mapInArrow(_cutter(MAX_LINES), CUT)
    parts = materialise(cut.where("part").drop("part"), "csv-parts")
    single = cut.where("not part").select("file", "block", "seq", "record", F.lit(None).cast("string").alias("reason"))
    return single.unionByName(_joined_parts(parts))


def records(spark: SparkSession, path: str) -> DataFrame:
    """All records of a file or folder, headers and rejects included: file, head (whether it is the file's first), record, reason.

    Splits and the lines at their edges are looked at now; the rest is read when the records are.
    """
    lines = _lines(spark, path)
    splits = materialise(_splits(lines), "csv-splits")
    odd_files = splits.where("spread")
    # one row per input file, as the driver's own listing has
    none = F.lit(None).cast("string").alias("reason")
    every = lines.join(F.broadcast(odd_files.select("file").distinct()), "file", "left_anti").select("file", "block", "seq", F.col("value").alias("record"), none)
    if not odd_files.isEmpty():
        every = every.unionByName(_spread_records(lines, odd_files))
    firsts = F.broadcast(lines.where("block = 0").groupBy("file").agg(F.min("seq").alias("first")))
    return every.join(firsts, "file").select(
        "file", ((F.col("block") == 0) & (F.col("seq") == F.col("first"))).alias("head"), F.regexp_replace("record", "\r$", "").alias("record"), "reason"
    )


def _header(spark: SparkSession, path: str) -> list[str]:
    """The cells of the first record, trimmed."""
    head = spark.read.option("recursiveFileLookup", "true").csv(path, header=False, multiLine=True, **QUOTING)
    return [(c or "").lstrip("\ufeff").strip() for c in (head.first() or [])] if head.columns else []


def read_csv_records(spark: SparkSession, path: str) -> CsvLoad:
    """A CSV file or folder with a header in each file; names are trimmed. All files must have the same header: another one is an error."""
    cells = _header(spark, path)
    # a column without a name, or with one that came before, is named by its place
    names = [c if c and c not in cells[:k] else f"{c or '_c'}{k}" for k, c in enumerate(cells)]
    if not names:
        nothing = spark.createDataFrame([], "file string, reason string, record string")
        return CsvLoad(nothing.select(), nothing, nothing, [])
    schema = ", ".join([f"c{k} STRING" for k in range(len(names))] + ["bad STRING"])
    options = {**QUOTING, "multiLine": "true", "columnNameOfCorruptRecord": "bad", "maxCharsPerColumn": "-1"}
    found = records(spark, path).withColumn("cells", F.from_csv("record", schema, options))
    header = [F.regexp_replace(F.coalesce(F.col("cells").getField(f"c{k}"), F.lit("")), r"^[\s\x{FEFF}]+|\s+$", "") for k in range(len(names))]
    differs = F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean")
    same = F.when(F.array(*header) == F.array(*[F.lit(c) for c in cells]), F.lit(False)).otherwise(differs)
    # blank lines are no records
    found = found.where(F.when(F.col("head"), same).otherwise(F.trim("record") != ""))
    reason = F.coalesce("reason", F.when(F.col("cells.bad").isNotNull(), F.lit(CELLS)))
    parsed = found.select("file", "head", "record", "cells", reason.alias("reason"))
    rows = _named(parsed.where("reason is null"), names)
    return CsvLoad(rows, parsed.where("reason is not null").select("file", "reason", "record"), parsed, names)
