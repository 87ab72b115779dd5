"""Fill-in-middle transformation with a sparse index of multibyte characters.

A text is cut between tokens (a run of non-space characters with the white space before it; white space at
the end is a token of its own) into prefix, middle and suffix, which are written in another order with sentinels.
Cuts are found on the UTF-8 bytes, which are never decoded. ``ByteIndex`` translates between
byte and code point offsets: it records only the characters of more than one byte, where they are and how many bytes
they have beyond one, so an offset is itself plus or minus a running sum found by ``searchsorted``, and in
a text of ASCII, or a span without such characters, it is plain arithmetic.

Which documents are transformed, how and where they are cut follows from a hash of the identifier: reruns, retries and
other partitionings give the same rows. ``restored`` rebuilds the text from output and form alone; it is a column expression.

Defined cases: a null text counts as empty; an empty text, and one that holds a sentinel, stays plain; a null
identifier is hashed as ``null``; rows that repeat an identifier are treated alike; an empty table gives no rows;
other columns are ignored, whatever they are called, unless ``keep`` names them. A text is held whole, one at a time, with eight bytes per
token and per multibyte character beside it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from .common import map_arrow, text_or_empty

SEED = 42
#: of 100 documents, how many are transformed; of 100 of those, how many with the suffix first
FIM_PERCENT, SPM_PERCENT = 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"


class ByteIndex:
    """Byte and code point offsets of one UTF-8 text.

    ``at`` has the byte offsets of the multibyte characters, ``excess`` the bytes beyond one of all such characters before
    each of them (and, last, of all).
    """

    def __init__(self, raw: np.ndarray):
        self.at = np.flatnonzero(raw >= 0xC0)
        lead = raw[self.at]
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(extra)])
        self.size = len(raw)

    def to_chars(self, places: np.ndarray) -> np.ndarray:
        """Code point offsets of byte offsets that lie between characters."""
        if not len(self.at):
            return places
        return places - self.excess[np.searchsorted(self.at, places, side="left")]

    def to_bytes(self, places: np.ndarray) -> np.ndarray:
        """Byte offsets of code point offsets."""
        if not len(self.at):
            return places
        return places + self.excess[np.searchsorted(self.at - self.excess[:-1], places, side="left")]


def token_ends(raw: np.ndarray) -> np.ndarray:
    """Byte offsets at which tokens end. White space is ASCII, so bytes tell what code points would."""
    if not len(raw):
        return np.zeros(0, np.int64)
    space = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    last_of_word = np.append(~space[:-1] & space[1:], True)  # the end of the text ends a token in any case
    return np.flatnonzero(last_of_word) + 1


def _cut(raw: memoryview, h: tuple[int, int, int, int], fim_percent: int, spm_percent: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text in UTF-8."""
    values = np.frombuffer(raw, np.uint8)
    ends = token_ends(values)
    n = len(ends)
    body = bytes(raw)
    if not n or h[2] % 100 >= fim_percent or any(s in body for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, body
    cuts = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    places = np.array([ends[c - 1] if c else 0 for c in cuts])
    prefix, middle, suffix = body[: places[0]], body[places[0] : places[1]], body[places[1] :]
    chars = ByteIndex(values).to_chars(places)
    if h[3] % 100 < spm_percent:
        form, output = "spm", b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    else:
        form, output = "psm", b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return n, form, int(chars[0]), int(chars[1] - chars[0]), output


def transform(
    docs: DataFrame,
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep``, doc_id, n (tokens), form (plain, psm or spm), prefix_chars,
    middle_chars (code points; null if plain) and the transformed text ``output``."""
    added = StructType(_parse_datatype_string("doc_id long, n long, form string, prefix_chars long, middle_chars long, output string").fields)
    if clash := set(keep) & set(added.names):
        raise ValueError(f"columns {sorted(clash)} cannot be kept beside results of that name")
    ident = F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("null"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), ident).cast("binary"), 256)
    rows = docs.select(
        F.struct(F.lit(0), *[F.col(c) for c in keep]).alias("kept"),
        F.col(id_col).cast("long").alias("doc_id"),
        *[F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)],
        text_or_empty(text_col).cast("binary").alias("raw"),
    )
    out = StructType([rows.schema["kept"], *added.fields])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = zip(*(batch.column(f"h{k}").to_pylist() for k in range(1, 5)), strict=True)
            raws = batch.column("raw")
            results = [_cut(memoryview(raws[i].as_buffer()), h, fim_percent, spm_percent) for i, h in enumerate(hashes)]
            columns = list(zip(*results, strict=True)) or [[]] * 5
            arrays = [batch.column("kept"), batch.column("doc_id")]
            arrays += [pa.array(v, t) for v, t in zip(columns[:4], (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)]
            arrays.append(pa.array(columns[4], pa.binary()).view(pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=arrow.names)

    return map_arrow(rows, run, out).select(*[F.col("kept").getField(c).alias(c) for c in keep], *added.names)


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text before the transformation. No sentinel is in it, so the first of each kind in ``output`` is the one written."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    p, s, m = (x.decode() for x in (PREFIX, SUFFIX, MIDDLE))

    def before(column: Column, sentinel: str) -> Column:
        return F.substring_index(column, sentinel, 1)

    def after(column: Column, sentinel: str) -> Column:
        return F.substring_index(column, sentinel, -1)

    outer = before(output, m)
    psm = F.concat(after(before(outer, s), p), after(output, m), after(outer, s))
    spm = F.concat(after(outer, p), after(output, m), after(before(outer, p), s))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and the SHA-256 of the output and of the text rebuilt from it."""
    return transform(docs).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored().cast("binary"), 256).alias("restored_sha256"),
    )
