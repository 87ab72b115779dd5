"""Fill-in-middle, the Merkle manifest and decontamination against plain versions, on awkward rows."""

from __future__ import annotations

import random
import re
import zlib

import brute
import numpy as np
import pytest
from brute import sha
from pyspark.sql import functions as F

from cohortlens.llm import decontaminate, fim, manifest

LOWER = {c: c + 32 for c in range(65, 91)}


def awkward_docs(spark):
    """Awkward texts with null and repeated identifiers, and columns that carry the operators' own names."""
    texts = [*brute.awkward_texts(), "a <P> b", "x <S", "é <", "<M", " lead", "trail ", "a b c", "日本 語テキスト です", "😀 a 😀b", "\x0b\x0c"]
    rows = [(None if k in (4, 9) else 3 * (k // 2 if k > 30 else k), t) for k, t in enumerate(texts)] + [(7, "tie"), (7, "tie"), (7, "Other")]
    names = "doc_id long, text string, kept string, grp int, n long, output string, items int, runs string, row int, h1 int, path string, raw string"
    return rows, spark.createDataFrame([(*r, "k", 1, 2, "o", 3, "r", 4, 5, "p", "w") for r in rows], names).repartition(5)


def plain_fim(i, t):
    t = t or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", t)
    n, g = len(tokens), sha(f"42:{'null' if i is None else i}")
    h = [int(g[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return i, n, "plain", None, None, sha(t), sha(t)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return i, n, form, len(p), len(m), sha(out), sha(t)


def test_fim(spark):
    rows, df = awkward_docs(spark)
    more = [(1000 + k, t) for k, (_, t) in enumerate(rows)] + [(2000 + k, t) for k, (_, t) in enumerate(rows)]
    both = df.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = [tuple(r) for r in fim.digests(both).collect()]
    assert brute.ordered(got) == brute.ordered([plain_fim(i, t) for i, t in rows + more])
    assert {r[2] for r in got} == {"plain", "spm", "psm"}


def test_fim_keeps_columns_and_takes_rates(spark):
    _, df = awkward_docs(spark)
    out = fim.transform(df, seed=1, fim_percent=100, spm_percent=0, keep=["kept", "text", "grp"])
    got = out.withColumn("back", fim.restored()).collect()
    assert {r.form for r in got} == {"plain", "psm"} and all(r.back == (r.text or "") and r.kept == "k" for r in got)
    assert all(r.output.startswith("<P>") for r in got if r.form == "psm")
    with pytest.raises(ValueError, match="output"):
        fim.transform(df, keep=["output"])


def test_fim_empty(spark):
    assert fim.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_byte_index():
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice("ab é日😀") for _ in range(rng.randint(0, 40)))
        raw = text.encode()
        index = fim.ByteIndex(np.frombuffer(raw, np.uint8))
        chars = np.arange(len(text) + 1)
        places = np.array([len(text[:k].encode()) for k in chars])
        assert index.to_bytes(chars).tolist() == places.tolist() and index.to_chars(places).tolist() == chars.tolist()
        assert len(index.at) == sum(ord(c) > 127 for c in text)


def plain_manifest(rows, arity=8):
    """rows: (doc_id, source, lang, n_chars, text). Rows of the audit."""

    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(nodes):
        """The root, and for each leaf its siblings."""
        ways, at, spots = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
        while len(at) > 1:
            runs = [at[k : k + arity] for k in range(0, len(at), arity)]
            for leaf, p in enumerate(spots):
                run = runs[p // arity]
                ways[leaf].append((p % arity, run[: p % arity], run[p % arity + 1 :]))
            at, spots = [sha("".join(r)) for r in runs], [p // arity for p in spots]
        return at[0], ways

    def fold(node, way):
        for _, left, right in way:
            node = sha("".join([*left, node, *right]))
        return node

    leaves = [(r, sha("".join(part(v) for v in r))) for r in rows]
    groups = {}
    for r, h in leaves:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, h, r))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    roots, found = [], []
    for lang in langs:
        members = sorted(groups[lang], key=lambda m: m[:3])
        subroot, ways = tree([m[2] for m in members])
        roots.append(subroot)
        found.append((members, ways))
    root, tops = tree(roots)
    out = []
    for (members, ways), subroot, top in zip(found, roots, tops, strict=True):
        for (_, _, h, r), way in zip(members, ways, strict=True):
            way = way + top
            changed = h
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                changed = sha("".join(part(v) for v in (*r[:4], r[4].translate(LOWER) if r[4] is not None else None)))
            back = fold(changed, way)
            out.append((r[0], h, subroot, root, sha("".join(x for _, left, right in way for x in left + right)), back, back == root))
    return out


LEAF = "doc_id long, source string, lang string, n_chars long, text string, grp int, digest string, row string, place int, salt int"


def manifest_rows(n):
    rng = random.Random(n)
    langs = [None, "", "de", "en", "en", "en", "é", "z"]
    rows = [(rng.randint(-50, 3 * n), rng.choice(["a", None, "Ü"]), rng.choice(langs), rng.choice([1, None]), rng.choice(["Tie", "tie", "É x", "", None, "W" * 300])) for _ in range(n)]
    return rows + rows[:5] + [(None, "a", "en", 1, "No id"), (None, None, None, None, None), (5, "one", "alone", 1, "A")]


@pytest.mark.parametrize("n", [0, 60, 1400])
def test_manifest(spark, n):
    rows = manifest_rows(n) if n else [(1, "a", "en", 1, "T")]
    df = spark.createDataFrame([(*r, 1, "d", "r", 2, 3) for r in rows], LEAF).repartition(6)
    got = [tuple(r) for r in manifest.audit(df).collect()]
    assert brute.ordered(got) == brute.ordered(plain_manifest(rows))
    assert n == 0 or {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("shape", [(2, 2), (3, 1)])
def test_manifest_of_other_shapes(spark, shape):
    """Deep trees: every stored level, groups that end at each of them, one hot group and many small ones."""
    rows = [(k, "s", "hot" if k % 3 else f"g{k % 47}", k, f"T{k}") for k in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    built = manifest.build(df, shape=shape)
    assert len(built.levels) > 2 and len(built.top) > 1
    # stored levels only: a level between them has more nodes than all levels above the leaves hold
    assert sum(x.selectExpr("sum(size(nodes))").first()[0] for x in built.levels[1:]) < 150
    proofs = manifest.proofs(built)
    got = proofs.select("row.key", "digest", "subroot", "root", manifest.siblings_digest().alias("p"), manifest.folded("digest").alias("f")).collect()
    want = [(i, h, s, r, p, r) for i, h, s, r, p, *_ in plain_manifest(rows, shape[0])]
    assert brute.ordered([tuple(r) for r in got]) == brute.ordered(want)
    assert proofs.where(manifest.folded(F.sha2(F.lit(b"x"), 256)) == F.col("root")).count() == 0


def test_manifest_empty(spark):
    assert manifest.audit(spark.createDataFrame([], LEAF)).count() == 0


def plain_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def plain_leaks(docs, items, window=10):
    windows = {}
    for i, t in items:
        w = plain_words(t)
        for k in range(max(len(w) - window, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = plain_words(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[tuple(w[k : k + size])] - {None}
        names = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), sha(names), bool(hit)))
    return out


def leak_tables(spark, seed=3):
    """Few words, so that windows overlap, repeat and meet half way; items of all sizes from nothing to longer than a piece."""
    rng = random.Random(seed)
    words = ["a", "b", "Ab", "né", "日", "x1", "0"]

    def passage(n):
        return "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))

    items = [(k, passage(n)) for k, n in enumerate([0, 1, 3, 5, 9, 10, 11, 12, 30, 80, 80, 9])]
    items[1] = (1, "lonely")
    items += [(20, None), (21, items[9][1]), (21, "another text of the item"), (None, passage(14)), (9, items[9][1])]
    _, df = awkward_docs(spark)
    docs = [(r.doc_id, r.text) for r in df.collect()]
    for k in range(60):
        i, t = rng.choice(items)
        cut = rng.randint(0, len(t or ""))
        docs.append((5000 + k, passage(rng.randint(0, 30)) + (t or "")[: rng.choice([cut, 10**6])] + "," + passage(rng.randint(0, 30))))
    docs.append((6000, (items[9][1] + " ") * 400))
    return docs, items


@pytest.mark.parametrize("sizes", [(200_000, 2_000), (45, 15)])
def test_decontaminate(spark, monkeypatch, sizes):
    """Also with many automata and items in pieces."""
    for name, size in zip(("SHARD_WORDS", "PIECE_WORDS"), sizes, strict=True):
        monkeypatch.setattr(decontaminate, name, size)
    docs, items = leak_tables(spark)
    bench = spark.createDataFrame([(*r, "k") for r in items], "item_id long, text string, shard string")
    assert (len(decontaminate.automata(bench)) > 1) == (sizes[0] < 100)
    df = spark.createDataFrame([(*r, "k", 1) for r in docs], "doc_id long, text string, kept string, runs int").repartition(3)
    got = [tuple(r) for r in decontaminate.report(df, bench).collect()]
    assert brute.ordered(got) == brute.ordered(plain_leaks(docs, items))


def test_longest_match(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p")], "item_id long, text string")
    df = spark.createDataFrame([(1, "q c d e f g h i"), (2, "b c d e f g h i j k l m z a b"), (3, "")], "doc_id long, text string")
    got = {r.doc_id: (r.longest, r.n_hit, [tuple(x) for x in r.runs]) for r in decontaminate.matches(df, bench).collect()}
    assert got == {1: (7, 0, []), 2: (12, 12, [(0, 11)]), 3: (0, 0, [])}


def test_clean(spark):
    leak = "One two three four five, six seven eight NINE ten eleven"
    bench = spark.createDataFrame([(1, leak), (2, "short item")], "item_id long, text string")
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(1, f"É {long} {leak.upper()}. End {long}"), (2, leak), (3, f"a short item {long}"), (4, None), (5, long), (6, "")]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, kept string, items int")
    out = decontaminate.clean(df, bench)
    got = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == df.columns
    assert got == {1: f"É {long} . End {long}", 3: f"a short item {long}", 4: None, 5: long, 6: ""}
    assert {r.doc_id: r.text for r in decontaminate.clean(df, bench, least=1).collect()}[3] == f"a  {long}"


def test_nothing_to_find(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.report(df, none).collect()] == [(1, 2, 0, 0, sha(""), False)]
    assert decontaminate.report(df.limit(0), none).count() == 0


def test_texts_in_parts(spark, monkeypatch):
    """Words are read a part of the text at a time; a word may be longer than a part, a window may span several."""
    docs, items = leak_tables(spark)
    pieces = [(str(i), decontaminate.words_of(t), len(plain_words(t)) < 10) for i, t in items]
    auto = decontaminate.Automaton(decontaminate.build(pieces, 10), 10)
    raws = [(t or "").encode().lower() for _, t in docs] + [b"a" * 50 + b" b," + b"c" * 30]
    whole = [decontaminate._scanner(auto)(r) for r in raws]
    monkeypatch.setattr(decontaminate, "PART_BYTES", 20)
    assert [decontaminate._scanner(auto)(r) for r in raws] == whole
    assert len(list(decontaminate.lists_of_words(raws[-1]))) == 2
