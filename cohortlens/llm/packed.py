"""Blocks of documents, rolling fingerprints, and questions about keys asked in packed form.

Operators that look for equal strings in the whole corpus hash every place of every text. One row per place would
cost far more than the hash itself, so keys travel packed: a block of documents sends each bucket of the key space one row
with the sorted keys it has there, the bucket answers with one small number per key, and
the answers return to the block. ``ask`` does this with two shuffles of small binary rows. The blocks are
a bucketed table, so neither question nor answer moves a text.

A key that occurs many times in a block is sent once, so a hot key reaches its bucket as one number
per block. Buckets follow ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructType, _parse_datatype_string

from cohortlens.session import scratch_path

from .common import bound_batches, map_arrow, release_memory, text_or_empty, trimmed

#: Bytes of text per block; one longer text is a block of its own.
BLOCK_BYTES = 1 << 20
#: 2 ** HOME_BITS blocks of a task that follow each other have one home, the bucket's key: a file for them all, not one for each. Every
#: file costs a process (Hadoop's local file system starts chmod), and many small ones burden any store.
HOME_BITS = 3

U64 = np.uint64
_MULT = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x = x ^ (x >> U64(27))
    x = x * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


class Rolling:
    """Fingerprints of substrings of a byte or code point sequence, from prefix sums modulo 2**64.

    A symbol is a fixed random number, a substring the sum of its symbols times powers of an odd base, divided by the power at
    its begin, then mixed. Equal substrings have equal fingerprints.
    """

    def __init__(self, which: int = 0):
        self.base = U64(_MULT[which] | 1)
        self.inverse = U64(pow(int(self.base), -1, 1 << 64))
        self.seed = U64(0xD1B54A32D192ED03 * (which + 1) & (1 << 64) - 1)
        self.powers = self.backs = np.ones(1, dtype=U64)
        self.symbols = mix(np.arange(1 << 16, dtype=U64) + self.seed)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            size = max(n + 1, 5 * len(self.powers) // 4)
            self.powers = np.multiply.accumulate(np.concatenate([[U64(1)], np.full(size, self.base)]))
            self.backs = np.multiply.accumulate(np.concatenate([[U64(1)], np.full(size, self.inverse)]))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums of bytes (uint8) or code points (uint32)."""
        self._grow(len(values))
        small = values.dtype == np.uint8 or not len(values) or values.max() < len(self.symbols)
        symbols = self.symbols[values] if small else mix(values.astype(U64) + self.seed)
        out = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum(symbols * self.powers[: len(values)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Fingerprints of [start, end) for arrays of places. Substrings of different length differ through their sums only."""
        return mix((sums[ends] - sums[starts]) * self.backs[starts])


@functools.cache
def rolling(which: int = 0) -> Rolling:
    """One per Python worker, whichever operators run in it: its tables of powers are filled once a task, and kept once."""
    return Rolling(which)


def forget_powers() -> None:
    """Drop the tables: a worker outlives its tasks, and steps that hash nothing would carry 20 MB of them."""
    rolling.cache_clear()


def home() -> Column:
    return F.shiftright("block", HOME_BITS)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blocks(
    docs: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, carry: bool = False,
    derive: Callable[[list[str]], dict[str, bytes]] | None = None, **options: str,
) -> DataFrame:
    """The documents packed to blocks, as a table bucketed by ``home``: home, block, doc_ids, texts. Nothing is shuffled.

    Nulls count as empty texts; null identifiers stay null. With ``carry``, all columns of ``docs`` but the text go along in ``rows``. ``derive`` gives
    further columns of a block, computed once from its texts. ``options`` are the writer's.
    """
    spark = docs.sparkSession
    derived = list(derive([])) if derive else []

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        ids: list = []
        texts: list = []
        rest: list = []
        size = 0

        def out() -> pa.RecordBatch:
            arrays = [pa.array([task << 32 | n], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([texts], pa.list_(pa.string()))]
            if carry:
                arrays.append(pa.array([rest], pa.list_(row_type)))
            more = derive(texts) if derive else {}
            arrays += [pa.array([more[c]], pa.binary()) for c in derived]
            return pa.RecordBatch.from_arrays(arrays, names=["block", "doc_ids", "texts", *(["rows"] if carry else []), *derived])

        for batch in batches:
            others = batch.column(2).to_pylist() if carry else [None] * batch.num_rows
            for i, t, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), others, strict=True):
                if ids and size + len(t) > block_bytes:
                    yield out()
                    n, ids, texts, rest, size = n + 1, [], [], [], 0
                rest.append(r)
                ids.append(i)
                texts.append(t)
                size += len(t) + 16
        if ids:
            yield out()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = "block long, doc_ids array<long>, texts array<string>"
    if carry:
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), F.struct([c for c in docs.columns if c != text_col]).alias("row"))
        kind = rows.schema["row"].dataType
        row_type = to_arrow_type(kind)
        schema += f", rows array<{kind.simpleString()}>"
    schema += "".join(f", {c} binary" for c in derived)
    packed = map_arrow(rows, pack, schema).withColumn("home", home())
    table = f"{name}_blocks_{uuid.uuid4().hex}"
    packed.write.bucketBy(shuffle_parts(spark), "home").sortBy("block").options(**options).option("path", scratch_path(spark, table)).saveAsTable(table)
    return spark.table(table)


def each_block(frame: DataFrame, fn: Callable[[dict], Iterator[dict]], schema: str | StructType) -> DataFrame:
    """``fn`` of each block row (a dict of its columns) gives rows (dicts). One block is unpacked at a time, a batch of a few is in memory."""
    arrow = to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(j)[k].as_py() for j, n in enumerate(batch.schema.names)}
                rows = list(fn(row))
                for at in range(0, len(rows), 4096):
                    yield pa.RecordBatch.from_pylist(rows[at : at + 4096], schema=arrow)
        forget_powers()

    bound_batches(frame.sparkSession)
    return frame.mapInArrow(trimmed(run), schema)


def split_keys(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of 64-bit keys and the next 32 bits. Both follow the order of the keys."""
    high, low = keys >> U64(32), keys & U64(0xFFFFFFFF)
    scaled = high * U64(buckets) + (low * U64(buckets) >> U64(32))
    return scaled >> U64(32), scaled & U64(0xFFFFFFFF)


def squeeze(values: np.ndarray, size: int) -> bytes:
    """Sorted numbers of ``8 * (size + 1)`` bits: how many have each top byte, then ``size`` bytes of each."""
    top = (values >> U64(8 * size)).astype(np.int64)
    low = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]
    return np.bincount(top, minlength=256).astype("<u4").tobytes() + low.tobytes()


def unsqueeze(parts: list[bytes], size: int) -> np.ndarray:
    kind = np.dtype("<u4" if size < 4 else "<u8")
    counts = [np.frombuffer(p, "<u4", 256) for p in parts]
    sizes = [int(c.sum()) for c in counts]
    out = np.zeros(sum(sizes), kind)
    places = out.view(np.uint8).reshape(len(out), kind.itemsize)
    at = 0
    for p, c, n in zip(parts, counts, sizes, strict=True):
        places[at : at + n, :size] = np.frombuffer(p, np.uint8, offset=1024).reshape(n, size)
        places[at : at + n, size] = np.repeat(np.arange(256, dtype=np.uint8), c)
        at += n
    return out


#: bytes sent per key beside its top byte: enough for a filter; enough to decide (with the bucket, over 60 bits)
NARROW, WIDE = 3, 6


def question_rows(block: int, keys: np.ndarray, counts: np.ndarray, buckets: int, wide: np.ndarray | None = None, first_bucket: int = 0, own_flags: bool = False) -> Iterator[dict]:
    """Rows (bucket, block, keys, flags) of distinct keys; a flag says how often the block has the key (255: or more), or
    with ``own_flags`` whatever the numbers in ``counts`` mean to the judge.

    Narrow: ``keys`` are sorted; 32 bits beside the bucket are sent. With ``wide``: the rows are sorted by bucket of ``keys``, then by
    ``wide``, an independent fingerprint of 56 bits, which is sent.
    """
    where, low = split_keys(keys, buckets)
    edges = np.searchsorted(where, np.arange(buckets + 1, dtype=U64))
    flags = np.minimum(counts, 255).astype(np.uint8) if not own_flags else counts
    for b in np.flatnonzero(np.diff(edges)):
        part = slice(edges[b], edges[b + 1])
        payload = squeeze(low[part], NARROW) if wide is None else squeeze(wide[part], WIDE)
        yield {"bucket": first_bucket + int(b), "block": block, "keys": payload, "flags": flags[part].tobytes()}


QUESTION = "bucket int, block long, keys binary, flags binary"


def answer(questions: DataFrame, judge: Callable[[int, list[bytes], list[np.ndarray]], np.ndarray], flag_type: type = np.uint8) -> DataFrame:
    """Per block: ``answers``, a list of (bucket, one number per key in the order sent).

    ``judge`` gets a bucket's number, the key parts and the flags of its blocks, in the order of the blocks (so that a
    repeated task gives the same answers), and returns a number below 16 for each key of all parts.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        flags = [np.frombuffer(x, dtype=flag_type) for x in table.column("flags").to_pylist()]
        result = judge(key[0].as_py(), table.column("keys").to_pylist(), flags).astype(np.uint8)
        cuts = np.cumsum([len(f) for f in flags])[:-1]
        replies = [pack_answer(x) for x in np.split(result, cuts)]
        release_memory()
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "reply": pa.array(replies, pa.binary())})

    rows = questions.groupBy("bucket").applyInArrow(run, "block long, bucket int, reply binary").where("length(reply) > 0")
    return rows.groupBy("block").agg(F.collect_list(F.struct("bucket", "reply")).alias("answers"))


#: keys judged at once
RANGE_KEYS = 1 << 17


def judged(judge: Callable[[np.ndarray, np.ndarray], np.ndarray], parts: list[bytes], flags: list[np.ndarray], size: int) -> np.ndarray:
    """``judge`` (a number for each key, from the keys and their flags) of all parts together. A range of key values goes at a time, with every
    key in it, in the order of the parts, so that what the judge sorts and sums is small beside the keys of a large bucket."""
    keys, flag = unsqueeze(parts, size), np.concatenate(flags)
    ranges = min(256, len(keys) // RANGE_KEYS)
    if ranges < 2:
        return judge(keys, flag)
    which = ((keys >> keys.dtype.type(8 * size)).astype(np.uint16) * np.uint16(ranges) >> np.uint16(8)).astype(np.uint8)
    out = np.zeros(len(keys), np.uint8)
    for k in range(ranges):
        at = np.flatnonzero(which == k)
        if len(at):
            out[at] = judge(keys[at], flag[at])
    return out


def pack_answer(values: np.ndarray) -> bytes:
    """Nothing if all are 0, bits if none is above 1, else four bits each."""
    if not values.any():
        return b""
    if values.max() <= 1:
        return b"\1" + np.packbits(values).tobytes()
    even = np.minimum(np.append(values, np.zeros(len(values) % 2, np.uint8)), 15)
    return b"\4" + (even[::2] << 4 | even[1::2]).astype(np.uint8).tobytes()


def unpack_answer(reply: bytes, n: int) -> np.ndarray:
    if not reply:
        return np.zeros(n, np.uint8)
    raw = np.frombuffer(reply, dtype=np.uint8, offset=1)
    if reply[0] == 1:
        return np.unpackbits(raw)[:n]
    return np.stack([raw >> 4, raw & 15], axis=1).reshape(-1)[:n]


def answers_of(answers: list | None, keys: np.ndarray, buckets: int, first_bucket: int = 0) -> np.ndarray:
    """The answers in the order of ``keys``, which must be those that were sent, in the same order."""
    where, _ = split_keys(keys, buckets)
    edges = np.searchsorted(where, np.arange(buckets + 1, dtype=U64))
    out = np.zeros(len(keys), np.uint8)
    for a in answers or ():
        b = a["bucket"] - first_bucket
        if not 0 <= b < buckets:
            continue
        lo, hi = edges[b], edges[b + 1]
        out[lo:hi] = unpack_answer(a["reply"], hi - lo)
    return out


def with_answers(frame: DataFrame, answers: DataFrame, name: str = "answers") -> DataFrame:
    """The blocks with their answers (null where there is none). The blocks are not shuffled."""
    by_home = answers.groupBy(home().alias("home")).agg(F.collect_list(F.struct("block", "answers")).alias(name))
    own = F.filter(name, lambda a: a["block"] == F.col("block"))
    return frame.join(by_home, "home", "left").withColumn(name, F.get(own, F.lit(0))["answers"])


def repeated(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """1 where a key occurs in two blocks, or twice in one."""
    if not len(keys):
        return np.zeros(0, np.uint8)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    begins = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    total = np.add.reduceat(counts[order].astype(np.int64), begins)
    out = np.empty(len(keys), np.uint8)
    out[order] = np.repeat(total > 1, np.diff(np.append(begins, len(keys))))
    return out
