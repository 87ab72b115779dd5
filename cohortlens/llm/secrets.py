"""Secret scan: keyword automaton, anchored patterns near its hits, checksums of the values found.

``scan`` reads every whole text once. An Aho-Corasick automaton over the keywords of all
kinds finds where a secret may begin; only there is the pattern of that kind tried, anchored. Base-58 keys have three
one-letter keywords, which count only where a run of letters and digits begins and is 51 or 52 long; hexadecimal runs have no keyword, their own pattern is the search. Values with an embedded checksum (``CHECKED``) count only if it agrees.

Defined cases: a null text counts as empty and gives zero counts and the digest of the empty string;
repeated rows give repeated results; other columns of the input are ignored. Letters match in
either case for A-Z only. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, per_row, text_or_empty

ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 8, 16, 32
KINDS = ("assign", "access", "hex")

# The keywords and the patterns of the formats, over lower-cased (assign) or plain bytes.
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
ASSIGN_TAIL = re.compile(rb"[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
ACCESS_RUN = re.compile(rb"AKIA[A-Z0-9]+")
HEX_RUN = re.compile(rb"[0-9a-f]{32,}")
GITHUB = re.compile(rb"gh[opusr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
NPM = re.compile(rb"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
WIF = re.compile(rb"[5KL][1-9A-HJ-NP-Za-km-z]{50,51}(?![0-9A-Za-z])")
# runs of letters and digits that are as long as a base-58 key: the only places where the keywords 5, K and L may begin one
WIF_RUN = re.compile(rb"(?<![0-9A-Za-z])[0-9A-Za-z]{51,52}(?![0-9A-Za-z])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
WIF_FIRST = b"5KL"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def crc_base62(body: bytes) -> bytes:
    """The CRC-32 of ``body`` as six base-62 digits, the way token issuers append it."""
    rest, digits = zlib.crc32(body), ""
    for _ in range(6):
        rest, d = divmod(rest, 62)
        digits = BASE62[d] + digits
    return digits.encode()


def wif_is_valid(value: bytes) -> bool:
    """A private key in base 58: version byte 0x80 and the first four bytes of the double SHA-256."""
    number = 0
    for c in value.decode():
        number = number * 58 + BASE58.index(c)
    raw = number.to_bytes(39, "big").lstrip(b"\0")
    body, check = raw[:-4], raw[-4:]
    return body[:1] == b"\x80" and len(body) in (33, 34) and hashlib.sha256(hashlib.sha256(body).digest()).digest()[:4] == check


def _crc_agrees(m: re.Match) -> bool:
    return crc_base62(m[1]) == m[2]


#: kind: (keywords that the automaton looks for, anchored pattern, check of the match)
CHECKED: dict[str, tuple[tuple[bytes, ...], re.Pattern, Callable[[re.Match], bool]]] = {
    "github": ((b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_"), GITHUB, _crc_agrees),
    "npm": ((b"npm_",), NPM, _crc_agrees),
}


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for w in ASSIGN_WORDS:
        a.add_word(w.decode(), ("assign", len(w)))
    a.add_word("akia", ("access", 4))
    for kind, (words, _, _) in CHECKED.items():
        for w in words:
            a.add_word(w.decode(), (kind, len(w)))
    a.make_automaton()
    return a


def find_spans(raw: bytes, hits: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Spans in bytes, in no order. Per kind they do not overlap and the leftmost comes first."""
    lower = raw.lower()
    found, free = [], {"assign": 0, "access": 0} | dict.fromkeys(CHECKED, 0)
    # bytes read as Latin-1: one character per byte, so the automaton's positions are byte positions
    for last, (kind, length) in hits.iter(lower.decode("latin-1")):
        start = last + 1 - length
        if start < free[kind]:
            continue
        if kind == "assign":
            if m := ASSIGN_TAIL.match(lower, last + 1):
                free[kind] = m.end()  # a match that is too short still takes its bytes
                if m.end(1) - m.start(1) >= ASSIGN_MIN:
                    found.append((kind, start, m.end()))
        elif kind == "access":
            if m := ACCESS_RUN.match(raw, start):
                free[kind] = m.end()
                if m.end() - start >= ACCESS_MIN:
                    found.append((kind, start, m.end()))
        else:
            _, pattern, agrees = CHECKED[kind]
            if (m := pattern.match(raw, start)) and agrees(m):
                free[kind] = m.end()
                found.append((kind, start, m.end()))
    found += [("hex", m.start(), m.end()) for m in HEX_RUN.finditer(raw)]
    for run in WIF_RUN.finditer(raw):
        if raw[run.start()] in WIF_FIRST and (m := WIF.match(raw, run.start())) and wif_is_valid(m[0]):
            found.append(("wif", m.start(), m.end()))
    return found


def in_code_points(raw: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of a UTF-8 text in code points. Characters are counted once, from one offset to the next."""
    place, at, chars = {}, 0, 0
    for offset in sorted({x for _, s, e in spans for x in (s, e)}):
        chars += len(raw[at:offset].decode())
        place[offset], at = chars, offset
    return [(k, place[s], place[e]) for k, s, e in spans]


def _scanner() -> Callable[[str], tuple]:
    hits = automaton()
    rank = {k: i for i, k in enumerate([*KINDS, *CHECKED, "wif"])}
    nothing = hashlib.sha256(b"").hexdigest()

    def one(text: str) -> tuple:
        raw = text.encode("utf-8")
        spans = find_spans(raw, hits)
        if not spans:
            return 0, 0, 0, nothing, ""
        if len(raw) != len(text):  # bytes to code points
            spans = in_code_points(raw, spans)
        spans.sort(key=lambda x: (x[1], rank[x[0]]))
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in spans if k in KINDS)
        counts = [sum(k == kind for k, _, _ in spans) for kind in KINDS]
        return (*counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{k}:{s}:{e}" for k, s, e in spans))

    return one


_FIELDS = [("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, counts by base kind, digest of the base spans, all spans."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_arrow(rows, per_row(_scanner, _FIELDS, ["doc_id"]), schema)
