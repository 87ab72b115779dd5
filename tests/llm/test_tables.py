"""Exact dedup, pages and embeddings: brute force, awkward rows, empty tables."""

from __future__ import annotations

import re

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import exact_dedup, html_text, lattice
from cohortlens.llm.components import components


def written(df, folder, name):
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return path


def test_exact_dedup(spark, tmp_path):
    texts = [(None if k in (5, 8) else 100 - k, t) for k, t in enumerate(brute.awkward_texts())] + [(7, "tie"), (7, "tie"), (3, "tie")]
    df = spark.createDataFrame([(i, t, "f", 1) for i, t in texts], "doc_id long, text string, file string, row int")
    got = exact_dedup.dedup(spark, written(df.repartition(4), tmp_path, "docs")).collect()
    groups: dict[str, list] = {}
    for i, t in texts:
        groups.setdefault(re.sub(brute.SPACES, " ", t or ""), []).append(i)
    want = []
    for i, t in texts:
        n = re.sub(brute.SPACES, " ", t or "")
        keep = min((x for x in groups[n] if x is not None), default=None)
        want.append((i, keep, len(groups[n]), i == keep, brute.sha(n)))
    assert brute.ordered([tuple(r) for r in got]) == brute.ordered(want)


def test_exact_dedup_empty(spark, tmp_path):
    path = written(spark.createDataFrame([], "doc_id long, text string"), tmp_path, "none")
    assert exact_dedup.dedup(spark, path).count() == 0


def test_exact_dedup_state_goes_on(spark, tmp_path):
    """A second run with the same checkpoint reads new files only and finds old texts in the state."""
    path, state = written(spark.createDataFrame([(5, "a b"), (6, "c")], "doc_id long, text string"), tmp_path, "docs"), str(tmp_path / "state")
    exact_dedup.keyed_state(spark, path, state)
    spark.createDataFrame([(2, "a  b"), (9, "c"), (1, "new")], "doc_id long, text string").write.mode("append").parquet(path)
    after = {r.keep_id: r.group_size for r in exact_dedup.keyed_state(spark, path, state).collect()}
    assert after == {2: 2, 6: 2, 1: 1}


def test_exact_dedup_of_a_second_folder(spark, tmp_path):
    """Texts kept from another folder are found through their locators, and no row of the second folder is lost."""
    one = written(spark.createDataFrame([(1, "a b"), (2, "c"), (12, "late")], "doc_id long, text string"), tmp_path, "one")
    two = written(spark.createDataFrame([(8, "a  b"), (9, "new"), (10, "late"), (11, "new")], "doc_id long, text string").repartition(2), tmp_path, "two")
    state = str(tmp_path / "state")
    first = exact_dedup.dedup(spark, one, state).collect()
    assert sorted(tuple(r)[:4] for r in first) == [(1, 1, 1, True), (2, 2, 1, True), (12, 12, 1, True)]
    second = exact_dedup.dedup(spark, two, state).collect()
    assert sorted(tuple(r)[:4] for r in second) == [(8, 1, 2, False), (9, 9, 2, True), (10, 10, 2, True), (11, 9, 2, False)]
    again = exact_dedup.dedup(spark, one, state).collect()
    assert sorted(tuple(r)[:4] for r in again) == [(1, 1, 2, True), (2, 2, 1, True), (12, 10, 2, False)]


def test_texts_that_only_share_a_digest(spark, tmp_path, monkeypatch):
    """The bytes decide, not the digest."""
    monkeypatch.setattr(exact_dedup, "digest", lambda normal: F.substring(normal, 1, 1))
    rows = [(5, "ab"), (6, "ac"), (7, "ab"), (8, "ac"), (9, "b"), (3, "ad")]
    path = written(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), tmp_path, "same")
    got = sorted(tuple(r)[:4] for r in exact_dedup.dedup(spark, path).collect())
    assert got == [(3, 3, 1, True), (5, 5, 2, True), (6, 6, 2, True), (7, 5, 2, False), (8, 6, 2, False), (9, 9, 1, True)]


def vectors(spark, count=400):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((count // 8, 32))
    data = np.repeat(base, 8, axis=0) + rng.standard_normal((count, 32)) * 0.12
    rows = [(k, data[k].tolist(), k // 8 % 3) for k in range(count)]
    rows += [(count, None, 1), (count + 1, [], 1), (count + 2, [0.0] * 32, 1), (count + 3, [None] * 32, 1), (count + 4, [float("nan")] * 32, 1), (count + 5, [float("inf")] + [0.0] * 31, 1)]
    rows += [(count + 6, data[0].tolist(), None), (None, data[0].tolist(), 0), (count + 7, data[0].tolist(), 0), (count + 8, (data[0] * 1e200).tolist(), 0), (count + 9, data[0][:31].tolist(), 0)]
    return rows


def plain_links(rows):
    good = [(i, np.array(v, float), lab) for i, v, lab in rows if v and None not in v and i is not None and lab is not None and np.all(np.isfinite(np.array(v, float))) and any(v)]
    unit = [v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for _, v, _ in good]
    return [
        (good[a][0], good[b][0])
        for a in range(len(good))
        for b in range(a + 1, len(good))
        if good[a][2] == good[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98
    ]


def test_cells_keep_near_pairs_and_part_unrelated_ones():
    """At cosine 0.98 nearly all pairs share a cell with one's home; of random pairs hardly any."""
    rng = np.random.default_rng(1)
    a, r = rng.standard_normal((2, 2000, 48))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    r -= (r * a).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * r / np.linalg.norm(r, axis=1, keepdims=True)

    def share(x, y):
        return ((x[:, :, :1] == y).any(axis=2) | (y[:, :, :1] == x).any(axis=2)).any(axis=1).mean()

    cells = lattice.cells_of(a)
    assert share(cells, lattice.cells_of(b)) >= 0.999
    assert np.mean([share(cells, np.roll(cells, k, axis=0)) for k in range(1, 20)]) < 0.0005


def test_lattice_dedup(spark, monkeypatch):
    monkeypatch.setattr(lattice, "CELL_BLOCK", 4)  # so that cells are split
    rows = vectors(spark)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, cell string, uid int").repartition(3)
    got = lattice.dedup(df).collect()
    links = plain_links(rows)
    named = brute.component_of([r[0] for r in rows if r[0] is not None], links)
    degree = {i: sum(i in x for x in links) for i in named}
    assert sum(r.n_links for r in got) >= 0.99 * 2 * len(links)
    want = [(i, degree.get(i, 0), named.get(i), i is not None and named[i] == i or i is None) for i, _, _ in rows]
    assert brute.ordered([tuple(r) for r in got]) == brute.ordered(want)


def test_lattice_empty(spark):
    assert lattice.dedup(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_lattice_points_are_nearest():
    """The first point is the nearest of E8 among all lattice points around it."""
    import itertools

    rng = np.random.default_rng(0)
    for x in rng.uniform(-2, 2, (40, 8)):
        best = min(
            sum((x - p) ** 2)
            for shift in (0.0, 0.5)
            for p in (np.floor(x - shift) + np.array(d) + shift for d in itertools.product((0, 1), repeat=8))
            if (p - shift).sum() % 2 == 0
        )
        assert abs(((lattice.e8_points(x[None], 1)[0][0, 0] / 2 - x) ** 2).sum() - best) < 1e-9


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 180)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: c for n, c in brute.component_of(sorted({x for e in links for x in e}), links).items()}


PAGES = {
    "<div class=ad>unclosed <article class='post'><header><h1>Head &amp; Co</h1></header><p>one<br>two<p>three <b>bold</b>er<aside>no</aside><section class=comments><article class=comment>bad</article></section></article> after": "Head & Co\none two\nthree bolder",
    "<nav>menu</nav><main><p>a<!-- x > y --><script>if(a<b){'</p>'}</script>b<p title='x>y'>c\n\t d</main><footer>f</footer>": "ab\nc d",
    "": "",
    "plain &lt;text&gt; 1 < 2": "plain <text> 1 < 2",
    "<p>&nbsp;</p><form>f</form><style>p{}</style>": "",
}


def test_pages(spark):
    rows = [(k, f"http://h{k}.example/x", h, "extra") for k, h in enumerate(PAGES)] + [(90, None, None, None), (None, "http://h", "<article>x</article>", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(df).collect()}
    assert got == {k: (t, len(t)) for k, t in enumerate(PAGES.values())} | {90: ("", 0), None: ("x", 1)}
    assert html_text.extract(df.limit(0)).count() == 0


def test_pages_without_a_marked_article(spark):
    """What repeats on the host goes, unique runs stay, also within one block; other hosts do not count."""
    frame = "<div>Welcome to the site of things you may want {}</div><p>{}</p><div>all rights reserved by nobody in particular ever since</div>"
    texts = ["first story about one thing only", "second tale of something else here", "a third one that nobody has seen"]
    rows = [(k, "http://a.example/" + str(k), frame.format(k, t)) for k, t in enumerate(texts)] + [(9, "http://b.example/", frame.format(9, texts[0]))]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in range(3)] == [f"{k}\n{t}" for k, t in enumerate(texts)]
    assert got[9].startswith("Welcome to the site") and got[9].endswith("ever since")


def plain_runs(pages, run=8, copy_share=0.9):
    """Texts of unmarked pages (id, host, blocks) by the definition: every run of tokens is looked up on every other page."""
    tokens = {i: (h, " ".join(b).split(" ") if b else []) for i, h, b in pages}

    def grams(i):
        h, t = tokens[i]
        return [(h, *t[k : k + run]) for k in range(len(t) - run + 1)]

    def covered(i, wanted):
        gone = set()
        for k, g in enumerate(grams(i)):
            if wanted(i, g):
                gone |= set(range(k, k + run))
        return gone

    on = {}
    for i in tokens:
        for g in grams(i):
            on.setdefault(g, set()).add(i)
    copies = {i for i in tokens if len(tokens[i][1]) >= run and len(covered(i, lambda _, g: len(on[g]) > 1)) >= copy_share * len(tokens[i][1])}
    out = {}
    for i, _, blocks in pages:
        gone, at, text = covered(i, lambda _, g: len(on[g]) > 1 and on[g] - copies), 0, []
        for b in blocks:
            words = b.split(" ")
            kept = [w for k, w in enumerate(words) if at + k not in gone]
            at += len(words)
            text += [" ".join(kept)] if kept else []
        out[i] = "\n".join(text)
    return out


def test_host_runs_against_the_definition(spark):
    """Menus go, stories stay, on mirrored pages too; near copies, short pages and other hosts."""
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(400)]

    def prose(n):
        return " ".join(rng.choice(words, n))

    menu, foot, story = prose(14), prose(9), prose(80)
    pages = [(k, "a.example", [menu, prose(60), prose(30), foot]) for k in range(4)]
    pages += [(10, "a.example", [menu, story, foot]), (11, "a.example", [menu, story, foot]), (12, "a.example", [menu, story + " changed", foot])]
    pages += [(20, "b.example", [story]), (21, "b.example", [story]), (22, "c.example", [menu, story]), (23, "a.example", ["short"]), (24, "a.example", [])]
    pages += [(30, "d.example", [prose(40) + " " + foot + " " + prose(40)]), (31, "d.example", [prose(50), foot + " " + prose(5)])]
    rows = [(i, f"http://{h}/{i}", "".join(f"<p>{b}</p>" for b in blocks)) for i, h, blocks in pages]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == plain_runs(pages)
    assert got[10] == got[11] == story and got[20] == got[21] == story and menu not in "".join(got[k] for k in range(4))


@pytest.mark.parametrize("page", ["<article>" + "<p>x" * 20_000, "<" * 5_000, "<div>" * 5_000, "<!--" * 2_000, "&amp" * 3_000])
def test_odd_pages_end(page):
    html_text.parse(page)


def test_host_runs_decide_in_marked_articles(spark):
    """A site's block goes from articles too; mirrored texts, teasers, headlines and quoted lines stay, and so do other hosts."""
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(400)]

    def prose(n):
        return " ".join(rng.choice(words, n))

    def page(head, blocks, aside, foot):
        return f"<nav>{prose(9)}</nav><article><h1>{head}</h1>" + "".join(f"<p>{b}</p>" for b in blocks) + f"</article><aside>{aside}</aside><footer>{foot}</footer>"

    offer, teaser, quoted, story, headline = prose(12), prose(15), prose(15), [prose(40), prose(30)], prose(10)
    texts = {k: [prose(50), quoted, prose(20)] for k in range(4)} | {4: [teaser, prose(60)], 5: story, 6: story, 7: story, 8: [prose(10) + " " + offer, prose(30)]}
    pages = {k: page(f"head {k}", [*t[:1], offer, *t[1:]] if k < 5 else t, teaser, offer) for k, t in texts.items()}
    want = {k: "\n".join([f"head {k}", *t]) for k, t in texts.items()}
    pages |= {k: page(headline, [text], headline, offer) for k, text in ((20, prose(40)), (21, prose(40)), (22, prose(40)))}
    pages |= {k: page(f"head {k}", [text], quoted, offer) for k, text in ((23, prose(40)), (24, prose(40)))}
    want |= {k: "\n".join([headline, *re.findall("<p>(.*?)</p>", pages[k])]) for k in (20, 21, 22)}
    want |= {k: "\n".join([f"head {k}", *re.findall("<p>(.*?)</p>", pages[k])]) for k in (23, 24)}
    rows = [(k, f"http://a.example/{k}", h) for k, h in pages.items()] + [(30, "http://b.example/", page("other", [offer, prose(20)], "", offer))]
    want[30] = "\n".join(["other", *re.findall("<p>(.*?)</p>", rows[-1][2])])
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == want


def test_article_that_is_furniture_alone_keeps_it(spark):
    notice = "this page has moved to another place for good and stays there"
    rows = [(k, f"http://a.example/{k}", f"<article><p>{notice}</p></article><footer>{notice}</footer>") for k in range(5)]
    assert {r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()} == {notice}
