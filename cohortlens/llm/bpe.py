"""Byte-pair encoding as a streaming transducer with bounded lookahead, and the way back.

Encoding reads a text word by word (the pattern of the tokenizer's file; no token crosses a word), each word
symbol by symbol. ``Transducer`` is the core: the encoding of any longer
prefix goes on from a token boundary at most ``lookahead`` symbols back, where ``lookahead`` is computed
from the merge list (the longest token, in symbols). It keeps the token that each prefix's encoding ends
with, back to the last stable boundary; a token is emitted as soon as the encodings of all prefixes in reach
share it, that is, once nothing that follows can change it. So memory does not grow with the word.
Which token ends a prefix follows from a local rule: two tokens may stand side by side exactly if merging
their concatenation gives the two back, so the encoding of a prefix is the encoding of a shorter one plus
the one token that may stand there. Words seen lately come from a cache of bounded size.

Decoding feeds ids to a state machine (``Decoder``) that turns token strings into text piece by piece,
keeping an unfinished UTF-8 sequence until its last byte comes; for vocabularies without a decoder
the text is the token strings joined by one space, as the public tokenizers library does.

Defined cases: a null text counts as empty; an empty text has no tokens and decodes to the empty text;
strings of added tokens in a text become those tokens; repeated rows give repeated results; other columns of the input are ignored.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, per_row, text_or_empty

#: Pairs of tokens whose fit is remembered in a task.
FIT_ENTRIES = 200_000
#: Symbols of a word after which the transducer's state is shared between words.
SHARED = 6
#: Entries of a half of the cache of words; longer words are not kept. The cache stays with the Python
#: worker, so that a worker's next task finds the words of the one before.
WORD_ENTRIES, CACHE_CHARS = 150_000, 64

# Fixed values of the format: white space of its patterns, and the bytes that stand for themselves.
SPACE = r"[\t-\r \x85\xa0  -     　]"
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: The pattern that texts are split by, and an equal one for the faster standard module, which holds for texts
#: without the characters of ``_HARD``: numbers that are not digits, separators, letters beyond Latin.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_EASY_WORDS = re.compile(r"[^\W\d_]+|'s|'t|'re|'ve|'m|'ll|'d|\d|(?:[^\w\s]|_)+")
_HARD = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe\u0250-\U0010ffff]")


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte: itself, or the next free one from 256 on."""
    symbols, free = [""] * 256, 256
    for b in range(256):
        if b in PLAIN_BYTES:
            symbols[b] = chr(b)
        else:
            symbols[b] = chr(free)
            free += 1
    return symbols


class Vocabulary:
    """Merges, ids and patterns of one tokenizer file (JSON of the public tokenizers library)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank: dict[tuple[str, str], int] = {p: i for i, p in enumerate(pairs)}
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.added: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.added.items()}
        self.symbols = byte_symbols()
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.easy = split["pattern"]["Regex"] == SPLIT
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", SPACE[1:-1]))
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        #: symbols: tokens of the merge list; single symbols count as tokens too
        self.longest = max(map(self.length, self.ids))

    def length(self, token: str) -> int:
        """Symbols of a token, its end mark not counted."""
        return len(token.removesuffix(self.suffix)) if self.suffix and token != self.suffix else len(token)

    def normalise(self, text: str) -> str:
        """NFC, then lower case character by character (no rule for a sigma at a word's end)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def symbols_of(self, word: str) -> list[int]:
        codes = list(word.encode())
        if self.suffix and codes:
            codes[-1] += 256
        return codes


def merge_word(parts: list[str], rank: dict[tuple[str, str], int]) -> list[str]:
    """Merge the pair of lowest rank, leftmost first, until none is left. Changes ``parts``."""
    none = len(rank)
    ranks = [rank.get(p, none) for p in zip(parts, parts[1:], strict=False)]
    while ranks:
        best = min(ranks)
        if best == none:
            break
        at = ranks.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del ranks[at]
        if at:
            ranks[at - 1] = rank.get((parts[at - 1], parts[at]), none)
        if at < len(ranks):
            ranks[at] = rank.get((parts[at], parts[at + 1]), none)
    return parts


class Recent(dict):
    """A cache of bounded size: when full, it becomes the old half, and what is asked for again moves over."""

    def __init__(self, make: Callable, entries: int, longest: int):
        super().__init__()
        self.make, self.entries, self.longest, self.old = make, entries, longest, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Transducer:
    """Reads the symbols of one word, gives the ids of its tokens as soon as they are stable.

    Symbols are bytes, plus 256 for a word's last byte where the vocabulary marks ends of words.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        #: no token is longer, so what follows can only join the encoding of one of so many last prefixes
        self.lookahead = vocabulary.longest
        self.parts: dict[int, list[str]] = {}
        #: backward trie: node and symbol before it -> node; token of a node that is a whole token
        self.before: dict[int, int] = {}
        self.token: list[int] = [-1]
        byte_of = {s: b for b, s in enumerate(vocabulary.symbols)}
        suffix = vocabulary.suffix
        for text, token_id in vocabulary.ids.items():
            marked = bool(suffix) and text.endswith(suffix) and text != suffix
            body = text[: -len(suffix)] if marked else text
            if not all(c in byte_of for c in body):
                continue
            codes, self.parts[token_id] = [byte_of[c] for c in body], list(body)
            if marked:
                codes[-1] += 256
                self.parts[token_id][-1] += suffix
            node = 0
            for c in reversed(codes):
                key = node << 9 | c
                if key not in self.before:
                    self.before[key] = len(self.token)
                    self.token.append(-1)
                node = self.before[key]
            self.token[node] = token_id
        self._fits: dict[int, bool] = {}
        self._begun: dict[bytes, tuple[list[int], list[int]]] = {}

    def fits(self, left: int, right: int) -> bool:
        """Whether the token ``right`` may follow ``left`` in an encoding (-1: the word's begin)."""
        whole = (self.parts[left] if left >= 0 else []) + self.parts[right]
        known = merge_word(whole, self.vocabulary.rank)
        ids = self.vocabulary.ids
        result = [ids[t] for t in known] == ([left, right] if left >= 0 else [right])
        if len(self._fits) >= FIT_ENTRIES:
            self._fits.clear()
        self._fits[(left + 1) << 20 | right] = result
        return result

    def encode(self, symbols: Sequence[int] | Iterable[int]) -> Iterator[int]:
        """Ids of one word. Keeps what follows the last stable boundary only."""
        #: since the last stable boundary: symbols, and for each prefix its last token and where that begins
        seen, last, begin = [], [-1], [0]
        for symbol in symbols:
            seen.append(symbol)
            self._step(seen, last, begin)
            if len(seen) >= 2 * self.lookahead and (stable := self._agreed(begin, len(seen))):
                yield from self._path(last, begin, stable)
                del seen[:stable], last[:stable], begin[:stable]
                begin[:] = [b - stable for b in begin]
        yield from self._path(last, begin, len(seen))

    def encode_short(self, symbols: list[int]) -> list[int]:
        """The same for a word within the lookahead. Words share beginnings: the state after ``SHARED`` symbols is kept."""
        n = len(symbols)
        if n <= SHARED:
            return list(self.encode(symbols))
        key = bytes(symbols[:SHARED])
        state = self._begun.get(key)
        if state is None:
            last, begin = [-1], [0]
            for k in range(1, SHARED + 1):
                self._step(symbols[:k], last, begin)
            if len(self._begun) >= FIT_ENTRIES // 4:
                self._begun.clear()
            state = self._begun[key] = (last, begin)
        last, begin = state[0][:], state[1][:]
        seen = symbols[:SHARED]
        for k in range(SHARED, n):
            seen.append(symbols[k])
            self._step(seen, last, begin)
        return self._path(last, begin, n)

    def _step(self, seen: list[int], last: list[int], begin: list[int]) -> None:
        """Find the token that the encoding of all of ``seen`` ends with."""
        before, token, fits = self.before, self.token, self._fits
        node, n = 0, len(seen)
        for i in range(n - 1, max(-1, n - self.lookahead - 1), -1):
            node = before.get(node << 9 | seen[i])
            if node is None:
                break
            t = token[node]
            if t >= 0:
                fit = fits.get((last[i] + 1) << 20 | t)
                if fit is None:
                    fit = self.fits(last[i], t)
                if fit:
                    last.append(t)
                    begin.append(i)
                    return
        raise ValueError("a byte has no token of its own")

    def _agreed(self, begin: list[int], n: int) -> int:
        """The last boundary that the encodings of all prefixes in reach share."""
        reach = set(range(n - self.lookahead + 1, n + 1))
        while len(reach) > 1:
            furthest = max(reach)
            reach.discard(furthest)
            reach.add(begin[furthest])
        return reach.pop()

    @staticmethod
    def _path(last: list[int], begin: list[int], at: int) -> list[int]:
        out = []
        while at > 0:
            out.append(last[at])
            at = begin[at]
        return out[::-1]


class Encoder:
    """Text to words, words to ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.transducer = Transducer(vocabulary)

    def words(self, text: str) -> list[str]:
        """The words of a text, added tokens among them as they are."""
        v = self.vocabulary
        if v.specials is None or not v.specials.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in v.specials.finditer(text):
            out += self._plain(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        v = self.vocabulary
        text = v.normalise(text)
        return _EASY_WORDS.findall(text) if v.easy and not _HARD.search(text) else v.words.findall(text)

    def word_ids(self, word: str) -> list[int]:
        v = self.vocabulary
        if word in v.added:
            return [v.added[word]]
        symbols = v.symbols_of(word)
        return self.transducer.encode_short(symbols) if len(symbols) <= self.transducer.lookahead else list(self.transducer.encode(symbols))

    def encode(self, text: str) -> list[int]:
        return [i for w in self.words(text) for i in self.word_ids(w)]


class Decoder:
    """Ids to text, piece by piece. ``joined`` puts one space between token strings, as a vocabulary
    without a decoder asks for; otherwise symbols become bytes and bytes become text as soon as a sequence is whole."""

    def __init__(self, vocabulary: Vocabulary, joined: bool = True):
        self.vocabulary, self.joined = vocabulary, joined
        self.first = True
        self.byte_of = {s: b for b, s in enumerate(vocabulary.symbols)}
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token_id: int) -> str:
        token = self.vocabulary.tokens[token_id]
        if self.joined:
            out = token if self.first else " " + token
            self.first = False
            return out
        suffix = self.vocabulary.suffix
        if token_id in self.vocabulary.added.values():
            return self.utf8.decode(b"", final=True) + token
        ends = bool(suffix) and token.endswith(suffix)
        body = token[: -len(suffix)] if ends else token
        return self.utf8.decode(bytes(self.byte_of[s] for s in body)) + (" " if ends else "")

    def finish(self) -> str:
        self.first = True
        return "" if self.joined else self.utf8.decode(b"", final=True)


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    return Encoder(Vocabulary(path))


@functools.lru_cache(maxsize=1)
def _digested_words(path: str) -> Recent:
    """By word: number of ids, ids and decoded text, with one space before each."""
    encoder = encoder_of(path)
    decoder = Decoder(encoder.vocabulary)

    def result(word: str) -> tuple[int, str, str]:
        ids = encoder.word_ids(word)
        decoder.first = False
        return len(ids), " " + " ".join(map(str, ids)), "".join(map(decoder.feed, ids))

    return Recent(result, WORD_ENTRIES, CACHE_CHARS)


def _digester(path: str) -> Callable[[], Callable[[str], tuple]]:
    def make() -> Callable[[str], tuple]:
        encoder, cache = encoder_of(path), _digested_words(path)

        def one(text: str) -> tuple:
            parts = [cache[w] for w in encoder.words(text)]
            n = sum([p[0] for p in parts])
            ids = "".join([p[1] for p in parts])[1:]
            decoded = "".join([p[2] for p in parts])[1:]
            return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

        return one

    return make


def digests(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, number of tokens, digests of the ids and of the decoded text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_arrow(rows, per_row(_digester(vocabulary_path), fields, ["doc_id"]), schema)


def tokenise(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: id, the columns ``keep``, ``token_ids``, ``n_tokens`` and the text ``decoded`` from them."""

    def make() -> Callable[[str], tuple]:
        encoder = encoder_of(vocabulary_path)
        decoder = Decoder(encoder.vocabulary)

        def result(word: str) -> tuple[list[int], str]:
            ids = encoder.word_ids(word)
            decoder.first = False
            return ids, "".join(map(decoder.feed, ids))

        cache = Recent(result, WORD_ENTRIES, CACHE_CHARS)

        def one(text: str) -> tuple:
            parts = [cache[w] for w in encoder.words(text)]
            ids = [i for p in parts for i in p[0]]
            return ids, len(ids), "".join([p[1] for p in parts])[1:]

        return one

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *keep, text_or_empty(text_col).alias("text"))
    kept = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in keep)
    fields = [("token_ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("decoded", pa.string())]
    return map_arrow(rows, per_row(make, fields, ["doc_id", *keep]), f"doc_id long, {kept}token_ids array<int>, n_tokens long, decoded string")
