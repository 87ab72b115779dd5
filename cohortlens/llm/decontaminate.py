"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts are lower-cased (A-Z) and read as words, runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. A window is ``window`` consecutive
words of an item, or a whole item of fewer words. Documents stream through the automaton word by word: the state holds
the longest passage of any item that ends here, its length is tracked, and where it reaches a window the
words are hit. Every state knows the items of its window, so no candidate is verified afterwards.

The items are the query set: they are cut into pieces that overlap by ``window - 1`` words, pieces are dealt to shards of at most
``SHARD_WORDS`` words (checked, not assumed), each shard becomes one automaton, built in a task and broadcast as flat
arrays; memory in a worker follows that bound and not the benchmark. All documents pass every shard; nothing is shuffled. With more than
one shard the documents' rows are written between passes.

``matches`` reports, ``clean`` removes: hit words go from the text, and documents go whose share of hit words is above a limit.

Defined cases: a null text has no words and is not contaminated; an item without words is in no document; a null item
identifier takes part in hits, but is not listed; rows that repeat an identifier are all of that item, in any text; an empty
benchmark hits nothing; repeated documents are treated alike; a table without rows gives none; other columns of the documents
are kept by ``clean``, whatever they are called, and ignored by ``matches``.
"""

from __future__ import annotations

import functools
import pickle
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from cohortlens.session import materialise

from .common import map_arrow, text_or_empty

WINDOW = 10
#: Words of an automaton: it has at most twice as many states and three times as many steps.
SHARD_WORDS = 200_000
#: Words of a piece of an item.
PIECE_WORDS = 2_000

#: the words, over UTF-8 bytes in lower case: all bytes beyond ASCII belong to words
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
#: Bytes of a text whose words are in memory at once.
PART_BYTES = 1 << 20
#: Matches whose windows a task remembers.
CACHED = 100_000


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


class Builder:
    """Suffix automaton over several sequences of word numbers, online."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def extend(self, last: int, word: int) -> int:
        """The state of the sequence that ``last`` stands for, with ``word`` behind it."""
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._state(self.length[last] + 1, {})
        p = last
        while p != -1 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p == -1:
            self.link[new] = 0
        else:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def _state(self, length: int, steps: dict[int, int]) -> int:
        self.next.append(steps)
        self.link.append(-1)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """A state for the shorter passages of ``q``: those that end the longest passage of ``p`` and ``word``."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[clone], self.link[q] = self.link[q], clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone


def build(pieces: list[tuple[str | None, list[bytes], bool]], window: int) -> dict:
    """An automaton as flat arrays. ``pieces``: item, words, and whether the piece is a whole item shorter than a window.

    A mark is (state, length, item): the passage of that length in the state is a window of the item.
    """
    numbers: dict[bytes, int] = {}
    auto = Builder()
    for _, words, _ in pieces:
        state = 0
        for w in words:
            state = auto.extend(state, numbers.setdefault(w, len(numbers)))
    # states split while the automaton grows, so windows are placed when it is complete
    marks: set[tuple[int, int, str | None]] = set()
    for item, words, short in pieces:
        state = have = 0
        for w in words:
            state, have = auto.next[state][numbers[w]], min(have + 1, window)
            while auto.length[auto.link[state]] >= have:
                state = auto.link[state]
            if have == window:
                marks.add((state, window, item))
        if short:
            marks.add((state, len(words), item))
    order = sorted(marks, key=lambda m: (m[0], m[1], m[2] is None, m[2] or ""))
    return {
        "words": list(numbers),
        "from": np.repeat(np.arange(len(auto.next), dtype=np.int32), [len(x) for x in auto.next]),
        "word": np.array([w for x in auto.next for w in x], np.int32),
        "to": np.array([t for x in auto.next for t in x.values()], np.int32),
        "link": np.array(auto.link, np.int32),
        "length": np.array(auto.length, np.int32),
        "mark_state": np.array([m[0] for m in order], np.int32),
        "mark_length": np.array([m[1] for m in order], np.int32),
        "mark_item": [m[2] for m in order],
    }


class Automaton:
    """The flat arrays of ``build`` as a machine that reads words."""

    def __init__(self, flat: dict, window: int):
        self.window = window
        self.link, self.length = flat["link"].tolist(), flat["length"].tolist()
        self.next: list[dict[bytes, int]] = [{} for _ in self.link]
        for s, w, t in zip(flat["from"].tolist(), flat["word"].tolist(), flat["to"].tolist(), strict=True):
            self.next[s][flat["words"][w]] = t
        self.marks: dict[int, list[tuple[int, str | None]]] = {}
        for s, n, item in zip(flat["mark_state"].tolist(), flat["mark_length"].tolist(), flat["mark_item"], strict=True):
            self.marks.setdefault(s, []).append((n, item))
        #: the shortest window that a state or one of the states of its shorter endings holds
        self.least = [NONE] * len(self.link)
        for s in np.argsort(flat["length"], kind="stable").tolist():
            own = min((n for n, _ in self.marks.get(s, ())), default=NONE)
            self.least[s] = min(own, self.least[self.link[s]] if s else NONE)

    def read(self, words: list[bytes], at: int, state: int, have: int, hits: list[tuple[int, int, int]]) -> tuple[int, int, int]:
        """Go on with ``words``, the first of which is word ``at``; windows that end at a word are added to ``hits`` as (word, state,
        longest match). Returns state, length of the match, and longest match of these words."""
        step, link, length, least, longest = self.next, self.link, self.length, self.least, have
        for i, w in enumerate(words, at):
            to = step[state].get(w)
            while to is None and state:
                state = link[state]
                have = length[state]
                to = step[state].get(w)
            if to is None:
                have = 0
                continue
            state = to
            have += 1
            if have > longest:
                longest = have
            if have >= least[state]:
                hits.append((i, state, have))
        return state, have, longest

    def windows(self, state: int, have: int) -> tuple[int, frozenset]:
        """Of a match: the length of the longest window that ends it, and the items of all windows that do."""
        cover, items = 0, set()
        while state > 0 and self.least[state] <= have:
            for n, item in self.marks.get(state, ()):
                if n <= have:
                    cover = max(cover, n)
                    items.add(item)
            state = self.link[state]
        return cover, frozenset(items)


NONE = 1 << 30


def lists_of_words(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lower case, a part of the text at a time, so that memory for words stays bounded."""
    at = 0
    while at < len(raw):
        end = GAP.search(raw, at + PART_BYTES) if at + PART_BYTES < len(raw) else None
        stop = end.start() if end else len(raw)
        yield WORD.findall(raw, at, stop)
        at = stop


def _scanner(auto: Automaton) -> Callable[[bytes], tuple[int, list[tuple[int, int]], set, int]]:
    """Of one text in lower case: its words, runs of hit words (first, last), items, longest match."""
    windows = functools.lru_cache(CACHED)(auto.windows)

    def scan(raw: bytes) -> tuple[int, list[tuple[int, int]], set, int]:
        n = state = have = longest = 0
        runs: list[tuple[int, int]] = []
        items: set = set()
        for words in lists_of_words(raw):
            hits: list[tuple[int, int, int]] = []
            state, have, most = auto.read(words, n, state, have, hits)
            n, longest = n + len(words), max(longest, most)
            for last, at, length in hits:
                cover, found = windows(at, length)
                items |= found
                runs.append((last - cover + 1, last))
                while len(runs) > 1 and runs[-2][1] >= runs[-1][0] - 1:
                    (a, _), (b, z) = runs[-2:]
                    runs[-2:] = [(min(a, b), z)]
        return n, runs, items, longest

    return scan


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(runs):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], z))
        else:
            out.append((a, z))
    return out


def _without(raw: bytes, lower: bytes, runs: list[tuple[int, int]], least: int) -> bytes:
    """The text without its runs of at least ``least`` words."""
    gone = [r for r in runs if r[1] - r[0] + 1 >= least]
    if not gone:
        return raw
    keep, at, k, begin = [], 0, 0, 0
    for i, m in enumerate(WORD.finditer(lower)):
        if i == gone[k][0]:
            begin = m.start()
        if i == gone[k][1]:
            keep.append(raw[at:begin])
            at, k = m.end(), k + 1
            if k == len(gone):
                break
    return b"".join([*keep, raw[at:]])


def _pieces(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """item, words (joined by a space), n, short. Equal pieces of one item occur once."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), text_or_empty(text_col).alias("text"))
    schema = "item string, words string, n long, short boolean"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                step = PIECE_WORDS - window + 1
                cuts = [words[k : k + PIECE_WORDS] for k in range(0, max(len(words) - window + 1, 1), step)] if words else []
                out = [{"item": item, "words": b" ".join(c).decode(), "n": len(c), "short": len(words) < window} for c in cuts]
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return map_arrow(rows, run, schema).dropDuplicates(["item", "words", "short"])


def automata(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> list[Broadcast]:
    """One broadcast automaton for each ``SHARD_WORDS`` words of the items."""
    spark = items.sparkSession
    pieces = materialise(_pieces(items, window, id_col, text_col), "decontaminate-pieces")
    total = pieces.agg(F.sum("n")).first()[0]
    if not total:
        return []
    count = -(-total // SHARD_WORDS)
    while True:
        dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(count)))
        if dealt.groupBy("shard").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] <= SHARD_WORDS:
            break
        count += -(-count // 4)

    def machine(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["words"], r["item"] is None, r["item"] or ""))
        flat = build([(r["item"], r["words"].encode().split(b" "), r["short"]) for r in rows], window)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "flat": pa.array([pickle.dumps(flat)], pa.binary())})

    built = materialise(dealt.groupBy("shard").applyInArrow(machine, "shard long, flat binary"), "decontaminate-automata")
    shards = [r.shard for r in built.select("shard").orderBy("shard").collect()]
    return [spark.sparkContext.broadcast(bytes(built.where(F.col("shard") == s).first().flat)) for s in shards]


#: columns that a pass adds to ``kept`` and ``text``
_FOUND = "n_words long, runs array<struct<first: long, last: long>>, items array<string>, longest long"


def _scanned(rows: DataFrame, shards: Sequence[Broadcast], window: int, least: int | None) -> DataFrame:
    """Rows (kept, text) with what all shards find; with ``least``, ``text`` comes without its runs of so many words."""
    out = StructType([rows.schema["kept"], rows.schema["text"], *_parse_datatype_string(_FOUND).fields])
    arrow = to_arrow_schema(out)
    empty = {"n_words": F.lit(0).cast("long"), "runs": F.array(), "items": F.array(), "longest": F.lit(0).cast("long")}
    frame = rows.select("kept", "text", *[v.cast(out[k].dataType).alias(k) for k, v in empty.items()])
    for k, shard in enumerate(shards or [None]):
        final = k == max(len(shards), 1) - 1

        def run(batches: Iterator[pa.RecordBatch], shard: Broadcast | None = shard, final: bool = final) -> Iterator[pa.RecordBatch]:
            flat = pickle.loads(shard.value) if shard else build([], window)
            scan = _scanner(Automaton(flat, window))
            for batch in batches:
                found, texts = [], []
                olds = zip(batch.column("runs").to_pylist(), batch.column("items").to_pylist(), batch.column("longest").to_pylist(), strict=True)
                for text, (runs, items, longest) in zip(batch.column("text"), olds, strict=True):
                    raw = bytes(text.as_buffer())
                    lower = raw.lower()
                    n, new, more, most = scan(lower)
                    runs = _merged([(r["first"], r["last"]) for r in runs] + new) if runs else new
                    named = sorted({i for i in more if i is not None} | set(items)) if more or items else []
                    found.append((n, [{"first": a, "last": z} for a, z in runs], named, max(most, longest)))
                    if final:
                        texts.append(b"" if least is None else _without(raw, lower, runs, least))
                text_out = pa.array(texts, pa.binary()).view(pa.string()) if final else batch.column("text")
                columns = list(zip(*found, strict=True)) or [[]] * 4
                arrays = [batch.column("kept"), text_out]
                arrays += [pa.array(v, f.type) for v, f in zip(columns, list(arrow)[2:], strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=arrow.names)

        frame = map_arrow(frame, run, out)
        if not final:
            frame = materialise(frame, f"decontaminate-{k}")
    return frame


def _n_hit() -> Column:
    return F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, ``runs`` of hit words (first, last), ``items`` with windows in it (strings,
    sorted) and ``longest``, the length in words of the longest passage shared with an item (of ``PIECE_WORDS`` at most)."""
    rows = docs.select(F.struct(F.col(id_col).cast("long").alias("doc_id")).alias("kept"), text_or_empty(text_col).alias("text"))
    found = _scanned(rows, automata(items, window), window, None)
    return found.select("kept.doc_id", "n_words", _n_hit().alias("n_hit"), "runs", "items", "longest")


def clean(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    least: int = WINDOW,
    max_coverage: float = 0.5,
    text_col: str = "text",
) -> DataFrame:
    """``docs`` without runs of ``least`` or more hit words, and without documents whose hit words are more than ``max_coverage`` of all.

    The first word of a run to its last go; white space and marks around it stay. A null text stays null.
    """
    rows = docs.select(F.struct(F.lit(0), *[F.col(c) for c in docs.columns]).alias("kept"), text_or_empty(text_col).alias("text"))
    found = _scanned(rows, automata(items, window), window, least).where(_n_hit() <= F.col("n_words") * max_coverage)
    new = F.when(F.col("kept").getField(text_col).isNotNull(), F.col("text"))
    return found.select(*[new.alias(c) if c == text_col else F.col("kept").getField(c).alias(c) for c in docs.columns])


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (of the items joined by commas) and contaminated."""
    return matches(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
