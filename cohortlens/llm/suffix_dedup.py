"""Suffix-array dedup: remove every byte of a passage of ``SPAN`` bytes that also starts anywhere else.

The suffixes of all texts, cut to ``SPAN`` bytes, are sorted blockwise, one bucket at a time, and equal neighbours
are repeated passages. A difference cover keeps almost all suffixes out of the sort:

1. Cover sample. The places whose offset modulo ``PERIOD`` lies in a difference cover (12 of 133 residues) are
   ranked by their next ``DEPTH = SPAN - PERIOD + 1`` bytes, a bucket at a time; a sample is tied if another one has the same bytes.
   For any two places there is a shift below ``PERIOD`` that takes both into the cover, so two equal passages have
   a pair of tied samples in their first ``PERIOD`` bytes, whose ``DEPTH`` bytes lie inside the passages.
2. Suffix buckets. A suffix without a tied sample in its first ``PERIOD`` bytes is thereby resolved: nothing equals it.
   The remaining ones are dealt to buckets, and each bucket is sorted alone.

Both sorts order strings by 64-bit fingerprints, not by letters: which strings are equal is all that is asked, and texts need not
travel. Memory is a block of texts or a bucket of keys, whatever the length of ties.

Exact copies are set aside first: one of them stands for all in the second sort; all are repeated as wholes.

Defined cases: a null text counts as empty; a text shorter than ``SPAN`` loses nothing; repeated rows are copies of each other;
a null identifier is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from cohortlens.session import materialise

from . import packed as P

SPAN, PERIOD, COVER = 200, 133, 12
DEPTH = SPAN - PERIOD + 1

U64 = np.uint64


def difference_cover(period: int = PERIOD, size: int = COVER) -> list[int]:
    """Residues such that every residue is a difference of two of them: unions of orbits under multiplication by ``size - 1``."""
    orbits, seen = [], set()
    for x in range(period):
        orbit, y = [], x
        while y not in orbit:
            orbit.append(y)
            y = y * (size - 1) % period
        if not seen & set(orbit):
            orbits.append(orbit)
        seen |= set(orbit)
    for n in range(1, size + 1):
        for some in itertools.combinations(orbits, n):
            cover = sorted(sum(some, []))
            if len(cover) == size and len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError(f"no cover of {size} residues modulo {period} among the orbits")


_STATE: dict = {}


def _tools() -> tuple[np.ndarray, P.Rolling, P.Rolling]:
    """Per Python worker: residues in the cover, two independent fingerprints."""
    if not _STATE:
        residues = np.zeros(PERIOD, bool)
        residues[difference_cover()] = True
        _STATE["tools"] = (residues, P.rolling(0), P.rolling(1))
    return _STATE["tools"]


class Block:
    """The texts of one block end to end, with places, samples and fingerprints."""

    def __init__(self, texts: list[str]):
        residues, first, second = _tools()
        self.raw = [t.encode("utf-8") for t in texts]
        self.lengths = np.array([len(r) for r in self.raw], dtype=np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(self.raw), dtype=np.uint8)
        offset = np.arange(len(self.bytes)) - np.repeat(self.begins, self.lengths)
        self.left = np.repeat(self.lengths, self.lengths) - offset
        self.samples = np.flatnonzero(residues[offset % PERIOD] & (self.left >= DEPTH))
        self.sums = first.sums(self.bytes), second.sums(self.bytes)
        self.first, self.second = first, second

    def sample_keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys, which of them each sample has, and how often each occurs."""
        return np.unique(self.first.of(self.sums[0], self.samples, self.samples + DEPTH), return_inverse=True, return_counts=True)

    def copy_keys(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of whole texts, in sending order: bucket keys, keys, counts; the first text with each; which of them each text has."""
        digests = [hashlib.blake2b(r, digest_size=16).digest() for r in self.raw]
        keys = np.array([int.from_bytes(d[:7], "big") for d in digests], dtype=U64)
        return _ordered(keys, np.array([int.from_bytes(d[8:], "big") for d in digests], dtype=U64), buckets)

    def candidates(self, tied: np.ndarray, set_aside: np.ndarray) -> np.ndarray:
        """Places of suffixes of ``SPAN`` bytes with a tied sample in their first ``PERIOD`` bytes, without those of texts set aside."""
        marks = np.zeros(len(self.bytes) + PERIOD, np.int32)
        marks[self.samples[tied]] = 1
        sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int32)])
        n = len(self.bytes)
        some = sums[PERIOD : PERIOD + n] > sums[:n]
        return np.flatnonzero(some & (self.left >= SPAN) & ~np.repeat(set_aside, self.lengths))

    def suffix_keys(self, places: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same of suffixes: 56 bits of one fingerprint as key, the other one for the bucket."""
        keys = self.second.of(self.sums[1], places, places + SPAN) >> U64(8)
        return _ordered(keys, self.first.of(self.sums[0], places, places + SPAN), buckets)


def _ordered(keys: np.ndarray, where: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys by bucket, then by value: (bucket keys, keys, counts, first place of each, which of them each place has)."""
    keys, at, which, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    where = where[at]
    order = np.argsort(P.split_keys(where, buckets)[0], kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return where[order], keys[order], counts[order], at[order], rank[which]


def _copies(keys: np.ndarray, count: np.ndarray) -> np.ndarray:
    """0: the text has no copy; 1: it has, and stands for the others; 2: it has, and is set aside."""
    result = P.repeated(keys, count)
    _, first = np.unique(keys, return_index=True)
    later = np.ones(len(keys), bool)
    later[first] = False
    return result + (later & (result > 0))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with ``keep_text`` also ``kept`` (binary) and ``spans`` (begin, end)."""
    buckets = P.shuffle_parts(docs.sparkSession)
    table = P.blocks(docs, "suffix", id_col, text_col)

    def ask_samples(row: dict) -> Iterator[dict]:
        block = Block(row["texts"])
        keys, _, counts = block.sample_keys()
        yield from P.question_rows(row["block"], keys, counts, buckets)
        where, keys, counts, _, _ = block.copy_keys(buckets)
        yield from P.question_rows(row["block"], where, counts, buckets, wide=keys, first_bucket=buckets)

    def judge_samples(bucket: int, parts: list[bytes], counts: list[np.ndarray]) -> np.ndarray:
        return P.judged(P.repeated, parts, counts, P.NARROW) if bucket < buckets else P.judged(_copies, parts, counts, P.WIDE)

    def resolved(row: dict) -> tuple[Block, np.ndarray, np.ndarray]:
        """The block, the places of suffixes to sort, and for each text whether it has a copy (2: and is set aside)."""
        block = Block(row["texts"])
        keys, which, _ = block.sample_keys()
        tied = P.answers_of(row["samples"], keys, buckets)[which] > 0
        where, _, _, at, which = block.copy_keys(buckets)
        copies = P.answers_of(row["samples"], where, buckets, buckets)[which]
        copies[(copies == 1) & (np.arange(len(copies)) != at[which])] = 2
        return block, block.candidates(tied, copies == 2), copies

    def ask_suffixes(row: dict) -> Iterator[dict]:
        block, places, _ = resolved(row)
        where, keys, counts, _, _ = block.suffix_keys(places, buckets)
        yield from P.question_rows(row["block"], where, counts, buckets, wide=keys)

    def judge_suffixes(bucket: int, parts: list[bytes], counts: list[np.ndarray]) -> np.ndarray:
        return P.judged(P.repeated, parts, counts, P.WIDE)

    def apply(row: dict) -> Iterator[dict]:
        block, places, copies = resolved(row)
        where, _, _, _, which = block.suffix_keys(places, buckets)
        hit = places[P.answers_of(row["suffixes"], where, buckets)[which] > 0]
        edges = np.zeros(len(block.bytes) + SPAN + 1, np.int32)
        np.add.at(edges, hit, 1)
        np.add.at(edges, hit + SPAN, -1)
        covered = np.cumsum(edges)[: len(block.bytes)] > 0
        covered |= np.repeat((copies > 0) & (block.lengths >= SPAN), block.lengths)
        for doc_id, raw, begin, n in zip(row["doc_ids"], block.raw, block.begins, block.lengths, strict=True):
            mask = covered[begin : begin + n]
            turns = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
            kept = block.bytes[begin : begin + n][~mask].tobytes() if len(turns) else raw
            out = {"doc_id": doc_id, "n_bytes": int(n), "n_removed": int(n) - len(kept), "n_spans": len(turns) // 2, "kept_sha256": hashlib.sha256(kept).hexdigest()}
            if keep_text:
                out |= {"kept": kept, "spans": [{"begin": int(a), "end": int(b)} for a, b in turns.reshape(-1, 2)]}
            yield out

    samples = materialise(P.answer(P.each_block(table, ask_samples, P.QUESTION), judge_samples), "suffix-samples")
    table = P.with_answers(table, samples, "samples")
    suffixes = P.answer(P.each_block(table, ask_suffixes, P.QUESTION), judge_suffixes)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if keep_text:
        schema += ", kept binary, spans array<struct<begin: long, end: long>>"
    return P.each_block(P.with_answers(table, suffixes, "suffixes"), apply, schema)
