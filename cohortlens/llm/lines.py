"""Line dedup: equal lines, and lines within ``EDITS`` edits, by a segment-partition join.

Lines that are not blank are compared, for equality at every length, for edits from ``NEAR_CHARS`` characters on, as far as no segment
is empty; blank lines only from ``BLANK_CHARS`` characters on, shorter ones always stay. Equal lines are found
first, by their fingerprints; the one in the smallest document (and there the first) stands for all.
Among those, a line is cut into ``EDITS`` + 1 segments, so of two lines within ``EDITS`` edits at least one
segment of the shorter line occurs unchanged in the longer one, and near its place: the longer line probes, for each length from its own
down to ``EDITS`` less, only the substrings that a multi-match-aware choice of places allows. Index keys (length, segment, content)
and probe keys first travel packed, as a filter; lines with a key that another line shares come together by key, and are
verified with a bit-parallel edit distance that follows the band of ``EDITS`` around the diagonal and gives up as soon as the band is above the limit.

Near lines form classes (links are transitive); of each class the line of the smallest document stays.

Defined cases: null and empty texts have one empty line, which stays; lines end at a newline only; an identifier that is null counts as the largest;
rows that repeat an identifier are documents of their own; an empty table gives no rows; other columns are ignored or, in ``deduped``, kept.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.session import materialise

from . import packed as P
from .components import components
from .pair_blocks import in_pairs_of_blocks

EDITS, BLANK_CHARS = 2, 20
NEAR_CHARS = EDITS + 1
#: entries of a key compared at once, and entries per task group
KEY_BLOCK, GROUP_ENTRIES = 256, 20_000
INDEX = 128

U64 = np.uint64
_LAST = (1 << 63) - 1


def prints(texts: list[str]) -> dict[str, bytes]:
    """Of a block's texts: how many lines each has, which of all lines are compared (bits), and two fingerprints of each of those.

    Stored with the block, so that only the steps that need characters read them, and none hashes whole lines again.
    """
    every = "\n".join(texts).split("\n") if texts else []
    # only short lines are looked at, so the cost does not follow the text
    compared = [len(x) >= BLANK_CHARS or x != "" and not x.isspace() for x in every]
    return {
        "n_lines": np.array([t.count("\n") + 1 for t in texts], "<i4").tobytes(),
        "compared": np.packbits(np.array(compared, bool)).tobytes(),
        "line_prints": b"".join([hashlib.blake2b(x.encode(), digest_size=16).digest() for x in itertools.compress(every, compared)]),
    }


class Lines:
    """What a block knows of its lines without their texts."""

    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        counts = np.frombuffer(row["n_lines"], "<i4")
        self.edges = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)  # of each document's lines
        self.doc = np.repeat(np.arange(len(counts)), counts)  # of each line
        self.compared = np.flatnonzero(np.unpackbits(np.frombuffer(row["compared"], np.uint8), count=len(self.doc)))
        # the first deals lines to buckets, the second tells lines of a bucket apart
        self.where, self.own = np.frombuffer(row["line_prints"], "<u8").reshape(-1, 2).T.copy()

    def equal_keys(self, buckets: int) -> tuple[np.ndarray, ...]:
        """Of compared lines, in sending order: bucket keys, keys, smallest document; the line that stands for each; which each line has."""
        owner = np.array([_LAST if i is None else i for i in self.doc_ids], dtype=np.int64)[self.doc[self.compared]]
        order = np.argsort(owner, kind="stable")  # then by place
        keys = self.own[order] >> U64(8)
        where = self.where[order]
        keys, at, which = np.unique(keys, return_index=True, return_inverse=True)  # at: of the smallest document
        rank = np.argsort(P.split_keys(where[at], buckets)[0], kind="stable")
        back = np.empty(len(rank), np.int64)
        back[rank] = np.arange(len(rank))
        own = np.empty(len(order), np.int64)
        own[order] = back[which]
        return where[at][rank], keys[rank], owner[order][at][rank], order[at][rank], own

    def standing(self, answers: list | None, buckets: int) -> np.ndarray:
        """Which of the compared lines stand for all equal ones."""
        where, _, _, at, _ = self.equal_keys(buckets)
        return np.sort(at[P.answers_of(answers, where, buckets) == 0])


class Segments:
    """The segments and substrings of some lines, as places in one array of code points."""

    def __init__(self, lines: list[str]):
        self.lines = lines
        self.sizes = np.array([len(x) for x in lines], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.sums = P.rolling().sums(np.frombuffer("".join(lines).encode("utf-32-le"), dtype=np.uint32))

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all lines: (key, line, whether it is a segment of the index)."""
        keys, lines, index = [], [], []
        start, size = self.starts, self.sizes
        for less in range(EDITS + 1):
            length = size - less  # of the lines that are looked for
            ok = length >= NEAR_CHARS
            at = 0
            base, extra = length // (EDITS + 1), length % (EDITS + 1)
            for j in range(EDITS + 1):
                width = base + (j >= EDITS + 1 - extra)
                # places allowed from the left and from the right
                low = np.maximum(-j, less - (EDITS - j))
                high = np.minimum(j, less + (EDITS - j))
                for shift in range(int(low), int(high) + 1):
                    begin = at + shift
                    fits = ok & (begin >= 0) & (begin + width <= size)
                    a = (start + begin)[fits]
                    content = P.rolling().of(self.sums, a, a + width[fits])
                    keys.append(P.mix(content + (length[fits] * (EDITS + 1) + j).astype(U64) * U64(0x9E3779B97F4A7C15)))
                    lines.append(np.flatnonzero(fits))
                    index.append(np.full(len(a), less == 0 and shift == 0))
                at = at + width
        return np.concatenate(keys), np.concatenate(lines), np.concatenate(index)

    def shared_keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same with distinct keys to send: keys, flags; and of each entry: which key, line, index or not."""
        keys, lines, index = self.keys()
        keys, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
        flags = np.minimum(counts, INDEX - 1).astype(np.uint8)
        flags[np.unique(which[index])] |= INDEX
        return keys, flags, which, lines, index


def _not_first(bucket: int, parts: list[bytes], owners: list[np.ndarray]) -> np.ndarray:
    """1 where another block has the line in a smaller document (or in an earlier block, if equal)."""
    return P.judged(_later, parts, owners, P.WIDE)


def _later(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    order = np.lexsort((np.arange(len(keys)), owner, keys))
    ranked = keys[order]
    out = np.zeros(len(keys), np.uint8)
    out[order[1:]] = ranked[1:] == ranked[:-1]
    return out


def _has_partner(bucket: int, parts: list[bytes], flags: list[np.ndarray]) -> np.ndarray:
    """1 where two lines have the key, one of them as a segment of the index."""
    return P.judged(_met, parts, flags, P.NARROW)


def _met(keys: np.ndarray, flag: np.ndarray) -> np.ndarray:
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    begins = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    total = np.add.reduceat((flag[order] & (INDEX - 1)).astype(np.int64), begins)
    index = np.bitwise_or.reduceat(flag[order] & INDEX, begins) > 0
    out = np.empty(len(keys), np.uint8)
    out[order] = np.repeat((total > 1) & index, np.diff(np.append(begins, len(keys))))
    return out


def within_edits(a: str, b: str, most: int = EDITS) -> bool:
    """Whether ``a`` and ``b`` are at most ``most`` edits apart.

    Equal ends are cut off. Then bit ``i`` of row ``k`` says whether a state ``i`` places off the diagonal is reached with ``k`` edits: a
    window of ``2 * most + 1`` bits per row moves down the band, one character of ``a`` at a time, all rows at once in one number each.
    """
    if abs(len(a) - len(b)) > most:
        return False
    n = min(len(a), len(b))
    i = 0
    while i < n and a[i] == b[i]:
        step = 1
        while i + 2 * step <= n and a[i : i + 2 * step] == b[i : i + 2 * step]:
            step *= 2
        i += step
    a, b = a[i:], b[i:]
    n = min(len(a), len(b))
    i = 0
    while i < n and a[-1 - i] == b[-1 - i]:
        i += 1
    if i:
        a, b = a[:-i], b[:-i]
    width, mask = 2 * most + 1, (1 << (2 * most + 1)) - 1
    #: rows[k]: bit d set if a[:p] and b[:p + d - most] are at most k edits apart
    rows = [((1 << (k + 1)) - 1) << most & mask for k in range(most + 1)]
    for p, c in enumerate(a):
        same = 0
        for d in range(width):
            q = p + d - most
            if 0 <= q < len(b) and b[q] == c:
                same |= 1 << d
        new = []
        for k in range(most + 1):
            reach = rows[k] & same  # equal characters
            if k:
                reach |= rows[k - 1] | rows[k - 1] >> 1 | new[k - 1] << 1 & mask  # change, drop from a, take from b
            new.append(reach)
        if not any(new):
            return False
        rows = new
    end = len(b) - len(a) + most
    return any(r >> end & 1 for r in rows)


def _verify(key: tuple, table: pa.Table) -> pa.Table:
    """Links (a, b) of one task group."""
    uid, index, mine, lo, hi = (table.column(c).to_numpy() for c in ("uid", "index", "mine", "lo", "hi"))
    keys = table.column("key").to_numpy()
    texts = table.column("text").to_pylist()
    order = np.lexsort((hi, lo, keys))
    turns = np.flatnonzero((np.diff(keys[order]) != 0) | (np.diff(lo[order]) != 0) | (np.diff(hi[order]) != 0)) + 1
    seen: set[tuple[int, int]] = set()
    links = []
    for part in np.split(order, turns):
        apart = len(part) and lo[part[0]] != hi[part[0]]
        for i in part[index[part]]:
            for j in part:
                a, b = int(uid[i]), int(uid[j])
                if a == b or apart and mine[i] == mine[j] or len(texts[j]) < len(texts[i]):
                    continue
                pair = (a, b) if a < b else (b, a)
                if pair in seen:
                    continue
                seen.add(pair)
                if within_edits(texts[i], texts[j]):
                    links.append(pair)
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _marked(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """Blocks with ``firsts`` (answers about equal lines) and ``near`` (fingerprints of near copies that go)."""
    buckets = P.shuffle_parts(docs.sparkSession)
    table = P.blocks(docs, "lines", id_col, text_col, carry=carry, derive=prints)
    known = ["home", "block", "doc_ids", "n_lines", "compared", "line_prints"]

    def ask_equal(row: dict) -> Iterator[dict]:
        where, keys, owner, _, _ = Lines(row).equal_keys(buckets)
        yield from P.question_rows(row["block"], where, owner, buckets, wide=keys, own_flags=True)

    firsts = materialise(P.answer(P.each_block(table.select(known), ask_equal, P.QUESTION), _not_first, np.int64), "lines-equal")
    slim = P.with_answers(table.select(*known, "texts"), firsts, "firsts")

    def standing(row: dict) -> tuple[Lines, np.ndarray, Segments]:
        """The block's lines that stand for all equal ones."""
        lines = Lines(row)
        some = lines.standing(row["firsts"], buckets)
        every = "\n".join(row["texts"]).split("\n")
        return lines, some, Segments([every[k] for k in lines.compared[some].tolist()])

    def ask_segments(row: dict) -> Iterator[dict]:
        keys, flags, _, _, _ = standing(row)[2].shared_keys()
        yield from P.question_rows(row["block"], keys, flags, buckets, own_flags=True)

    segments = materialise(P.answer(P.each_block(slim, ask_segments, P.QUESTION), _has_partner), "lines-segments")

    def entries(row: dict) -> Iterator[dict]:
        lines, some, cut = standing(row)
        keys, _, which, owner, index = cut.shared_keys()
        hit = np.flatnonzero(P.answers_of(row["segments"], keys, buckets)[which] > 0)
        if not len(hit):
            return
        which, owner, index = which[hit], owner[hit], index[hit]
        # each key of a line once, as the index's if it is both
        order = np.lexsort((~index, which, owner))
        order = order[np.concatenate([[True], (np.diff(owner[order]) != 0) | (np.diff(which[order]) != 0)])]
        order = order[np.lexsort((~index[order], owner[order]))]
        begins = np.flatnonzero(np.diff(owner[order], prepend=-1))
        probes = begins + np.add.reduceat(index[order].astype(np.int64), begins)
        values = keys.view(np.int64)[which[order]].tolist()
        mine = owner[order][begins]
        place = lines.compared[some[mine]]
        doc, uid = lines.doc[place], lines.own.view(np.int64)[some[mine]]
        ends = np.append(begins[1:], len(values))
        for k, line, d, u, a, b, c in zip(*(x.tolist() for x in (mine, place, doc, uid, begins, probes, ends)), strict=True):
            yield {
                "uid": u, "block": row["block"], "doc_id": row["doc_ids"][d], "line": line, "text": cut.lines[k],
                "index_keys": values[a:b], "probe_keys": values[b:c],
            }

    schema = "uid long, block long, doc_id long, line int, text string, index_keys array<long>, probe_keys array<long>"
    some = materialise(P.each_block(P.with_answers(slim, segments, "segments"), entries, schema), "lines-candidates")
    index = some.select("uid", F.explode("index_keys").alias("key")).withColumn("index", F.lit(True))
    probes = some.select("uid", F.explode("probe_keys").alias("key")).withColumn("index", F.lit(False))
    both = index.union(probes)
    full = both.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("index").alias("indexed")).where("n > 1 and indexed").select("key", "n")
    dealt = in_pairs_of_blocks(materialise(both.join(full, "key"), "lines-entries"), ["key"], KEY_BLOCK, GROUP_ENTRIES)
    links = dealt.join(some.select("uid", "text"), "uid").groupBy("group").applyInArrow(_verify, "a long, b long")
    named = components(materialise(links, "lines-links").distinct()).withColumnRenamed("node", "uid")
    members = materialise(some.select("uid", "block", "doc_id", "line").join(named, "uid"), "lines-classes")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "block", "line")
    kept = members.groupBy("component").agg(F.min_by("uid", first).alias("uid"))
    # a line stands for its equals in one block only, so the blocks of a home may see each other's
    gone = members.join(kept.select("uid"), "uid", "left_anti").groupBy(P.home().alias("home")).agg(F.collect_list("uid").alias("near"))
    table = P.with_answers(table, firsts, "firsts")
    return table.join(gone, "home", "left")


def _kept_lines(row: dict, buckets: int) -> tuple[Lines, np.ndarray, np.ndarray]:
    """The lines, which of them go as equal, which as near copies."""
    lines = Lines(row)
    first = np.zeros(len(lines.compared), bool)
    first[lines.standing(row["firsts"], buckets)] = True
    equal, near = np.zeros(len(lines.doc), bool), np.zeros(len(lines.doc), bool)
    equal[lines.compared[~first]] = True
    if row["near"]:
        near[lines.compared[np.isin(lines.own.view(np.int64), np.array(row["near"], np.int64)) & first]] = True
    return lines, equal, near


def _texts(row: dict, lines: Lines, gone: np.ndarray) -> Iterator[tuple[str, int]]:
    """Each document's text without the lines that go, and how many do."""
    stay = ~gone
    losses = np.bincount(lines.doc[gone], minlength=len(row["texts"])).tolist()
    for text, lost, a, b in zip(row["texts"], losses, lines.edges[:-1].tolist(), lines.edges[1:].tolist(), strict=True):
        if lost:
            text = "\n".join(itertools.compress(text.split("\n"), stay[a:b].tolist()))
        yield text, lost


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_lines, n_equal, n_near (lines that go), kept_sha256 (of the remaining text)."""
    buckets = P.shuffle_parts(docs.sparkSession)

    def rows(row: dict) -> Iterator[dict]:
        lines, equal, near = _kept_lines(row, buckets)
        n_lines, n_equal = np.diff(lines.edges).tolist(), np.bincount(lines.doc[equal], minlength=len(row["texts"])).tolist()
        for doc_id, n, same, (text, lost) in zip(row["doc_ids"], n_lines, n_equal, _texts(row, lines, equal | near), strict=True):
            yield {"doc_id": doc_id, "n_lines": n, "n_equal": same, "n_near": lost - same, "kept_sha256": hashlib.sha256(text.encode()).hexdigest()}

    return P.each_block(_marked(docs, id_col, text_col, False), rows, "doc_id long, n_lines long, n_equal long, n_near long, kept_sha256 string")


def deduped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, without the lines that go; documents that lose every line go too."""
    buckets = P.shuffle_parts(docs.sparkSession)

    def rows(row: dict) -> Iterator[dict]:
        lines, equal, near = _kept_lines(row, buckets)
        for old, (text, lost) in zip(row["rows"], _texts(row, lines, equal | near), strict=True):
            if lost and not text.strip():
                continue
            yield {c: v for c, v in old.items() if c != mark} | {text_col: None if old[mark] else text}

    mark = "was_null"  # whether the text was null, under a name that the documents do not have
    while mark in docs.columns:
        mark += "_"
    marked = docs.withColumn(mark, F.col(text_col).isNull())
    schema = docs.schema
    return P.each_block(_marked(marked, id_col, text_col, True), rows, schema)

