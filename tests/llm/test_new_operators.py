"""Extraction, whitening and resampling against plain versions, on edge tables and on skew."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrid.llm import boosting, html_extraction, html_layouts, importance_resampling, queries, whitening
from lossgrid.llm.html_dom import Page, joined

# --- extraction -------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sentences(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    return [x for r in rows for _, _, t in Page(r.html).pieces for x in t.split(". ") if x.strip()][:5000]


@pytest.fixture(scope="module")
def extractor(spark):
    return html_extraction.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_reader_follows_the_rules_of_html():
    page = Page(
        '<body><p>a <b>b<i>c</b>d<p>e<ul><li>f<li>g&amp;h &am</ul><td><script>if (a < b) "</p>"</script>'
        "<!-- <p>no --><p title='it>s'>i<br>j<textarea>k</textarea><select><option>l</select>&lt;p&gt;"
    )
    assert joined(page.pieces, [True] * len(page.pieces)) == "a bcd e f g&h &am i j<p>"
    assert page.tag == ["#page", "body", "p", "p", "ul", "li", "li", "td", "p"]


@pytest.mark.parametrize("piece", ["<", '<a "', "<b>", "<div>", "<!--", "</", "<p a='", "&", "<x a= ", "<p><i>", "</b></i>"])
def test_reader_takes_any_text(piece):
    page = Page(piece * 20_000)
    assert len(page.tag) == len(page.parent) and all(p < i for i, p in enumerate(page.parent))


def test_decoding_is_the_best_consistent_labelling():
    rng = np.random.default_rng(1)
    for trial in range(30):
        n = int(rng.integers(1, 7))
        page = Page("")
        page.tag, page.parent = ["div"] * n, [-1, *[int(rng.integers(0, i)) for i in range(1, n)]]
        page.parts, page.marks = [()] * n, [""] * n
        page.inline = page.controls = page.images = [0] * n
        page.pieces, page.linked = [(i, i, "x") for i in range(n)], [False] * n
        forest = html_extraction.Forest.of([page])
        log_p = rng.normal(size=(n, 3))
        best = max(
            (sum(log_p[i, x] for i, x in enumerate(labels)), labels)
            for labels in np.ndindex(*[3] * n)
            if all(p < 0 or labels[p] == 0 or (labels[p] == 1 and labels[i] != 0) or labels[i] == 2 for i, p in enumerate(page.parent))
        )
        assert tuple(html_extraction.decode(forest, log_p)) == best[1], trial


def test_held_out_layouts(extractor, sentences):
    """Other seeds and other sentences than those of the fit; marks taken away."""
    exact, found, wanted, common = 0, 0, 0, 0
    for seed in range(50_000, 50_200):
        source = html_layouts.labelled_page(seed, sentences)
        page = Page(source, marked=True)
        label = html_extraction.labels_of(page)
        want = joined(page.pieces, [label[n] == html_extraction.CONTENT for n, _, _ in page.pieces])
        got = html_extraction.main_texts([re.sub(r' data-mark="."', "", source)], extractor)[0]
        exact += got == want
        a, b = Counter(want.split()), Counter(got.split())
        wanted, found, common = wanted + a.total(), found + b.total(), common + (a & b).total()
    assert exact >= 170 and common / wanted > 0.93 and common / found > 0.93


def test_extraction_edges(spark, extractor):
    rows = [
        (1, "u", None, "x"), (2, "u", "", "x"), (3, None, "<html><body></body></html>", "x"), (3, None, "<html><body></body></html>", "x"),
        (None, "u", "<body><nav><a href='/'>Home</a></nav><article><p>One &amp; two.</p>\n<p>Three&nbsp;four.</article><footer>c</footer>", "x"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extraction.extract(df, extractor)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in got.collect()), key=str)
    assert found == sorted([(1, "u", "", 0), (2, "u", "", 0), (3, None, "", 0), (3, None, "", 0), (None, "u", "One & two. Three four.", 22)], key=str)
    assert html_extraction.extract(df.limit(0)).collect() == []


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.uniform(size=(3000, 4))
    y = np.where(x[:, 0] > 0.5, (x[:, 1] > 0.3).astype(int), 2)
    trees = boosting.boost(x[:2000], y[:2000], 3)
    assert (trees.log_odds(x[2000:]).argmax(axis=1) == y[2000:]).mean() > 0.97
    assert np.allclose(np.exp(trees.log_probabilities(x)).sum(axis=1), 1)


# --- whitening --------------------------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int")


def test_characteristic_polynomial(spark):
    rng = random.Random(4)
    for d in (1, 2, 3, 6):
        a = np.array([[rng.randrange(-9, 10) for _ in range(d)] for _ in range(d + 2)], object)
        m = a.T.dot(a)
        sums = whitening.symmetric_sums(spark, m)
        for x in range(-3, 4):  # det(x I - m) by cofactors
            shifted = [[(x if i == j else 0) - m[i][j] for j in range(d)] for i in range(d)]
            assert sum((-e if k % 2 else e) * x ** (d - k) for k, e in enumerate(sums)) == determinant(shifted)


def determinant(m):
    if not m:
        return 1
    return sum((-1) ** j * m[0][j] * determinant([row[:j] + row[j + 1 :] for row in m[1:]]) for j in range(len(m)))


@pytest.mark.parametrize("roots", [[5], [3, 3, 3], [9, 4, 4, 1, 0, 0], [1000001, 1000000, 1], [0, 0]])
def test_roots_with_multiplicity(roots):
    sums = [1] + [0] * len(roots)
    for r in roots:
        for k in range(len(roots), 0, -1):
            sums[k] += r * sums[k - 1]
    found, bits = whitening.largest_roots(sums, 8)
    assert [round(n / (1 << bits), 9) for n, _ in found] == sorted((r for r in roots if r), reverse=True)
    assert len({which for _, which in found}) == len({r for r in roots if r})


def test_whitening_against_numpy(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = whitening.whiten(df).toPandas().sort_values(["vec_id", "component"])
    rows = df.orderBy("vec_id").collect()
    x = np.floor(np.array([r.embedding for r in rows]) * 1024) + 100000
    values, axes = np.linalg.eigh(np.cov(x.T, bias=True))
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    want = (x - x.mean(axis=0)) @ axes[:, ::-1][:, :8] / np.sqrt(values[::-1][:8])
    white = got.whitened.to_numpy().reshape(n, 8)
    assert np.abs(np.abs(white) - np.abs(want)).max() < 1e-9
    assert np.abs(got.explained.to_numpy()[:8] / (values[::-1][:8] / values.sum()) - 1).max() < 1e-9
    assert [int(v) for v in got.deviation[::8]] == [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9 and set(got.n) == {n}


def test_whitening_edges(spark):
    """Missing and unusable entries, other lengths, repeated rows, constant and equal dimensions, NULL ids, clashing names."""
    good = [[1.0, 2.0, 5.0, 1.0], [2.0, -1.0, 5.0, 2.0], [0.5, 0.25, 5.0, 0.5], [0.5, 0.25, 5.0, 0.5], [-3.0, 4.0, 5.0, -3.0]]
    bad = [None, [], [1.0, None, 1.0, 1.0], [1.0, float("nan"), 1.0, 1.0], [1.0, float("inf"), 1.0, 1.0], [1e300, 1.0, 1.0, 1.0], [1.0, 2.0]]
    rows = [(None if i == 0 else i, v, 7) for i, v in enumerate(good)] + [(100 + i, v, 7) for i, v in enumerate(bad)]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert {r.vec_id for r in got} == {None, 1, 2, 3, 4} and {r.n for r in got} == {5}
    assert {r.component for r in got} == {1, 2}  # of four dimensions one is constant and one a copy
    assert got[0].identity_error < 1e-12
    x = np.floor(np.array(good) * 1024)
    assert {int(r.deviation) for r in got} == {int(v) for v in ((5 * x - x.sum(axis=0)) ** 2).sum(axis=1)}
    for some in ([], rows[:1], [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], [(1, None, 1)]):
        empty = whitening.whiten(vectors(spark, some))
        assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_with_a_repeated_variance(spark):
    units = [[float(s * (i == k)) for i in range(3)] for k in range(3) for s in (1, -1)]
    got = whitening.whiten(vectors(spark, [(i, v, 0) for i, v in enumerate(units)]))
    assert got.agg(F.max("identity_error")).first()[0] < 1e-12
    assert got.select("component").distinct().count() == 3 and {round(r.explained, 12) for r in got.collect()} == {round(1 / 3, 12)}


def test_large_entries_stay_exact(spark):
    values = [[1e15, -3.0], [1e15 + 1, 4.0], [-1e15, 0.5]]
    got = whitening.project(df := vectors(spark, [(i, v, 0) for i, v in enumerate(values)]), whitening.fit(df)).collect()
    x = [[int(c) * 1024 if abs(c) > 1e9 else math.floor(c * 1024) for c in v] for v in values]
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert {r.vec_id: int(r.deviation) for r in got} == {i: sum((3 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}


# --- resampling -------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text):
    w = WORD.findall((text or "").translate(SMALL))
    return len(w), [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def plain_resampling(docs, target, pct=25):
    """{position in docs: (n_features, weight, score, rank)}."""
    each = [plain_features(t) for _, t in docs]
    s, t = Counter(x for _, f in each for x in f), Counter(x for y in target for x in plain_features(y)[1])
    s_all, t_all = s.total() + 10000, t.total() + 10000
    gain = [math.floor(1000 * math.log((t[i] + 1) * s_all / ((s[i] + 1) * t_all))) for i in range(10000)]
    out = []
    for (doc_id, _), (_, f) in zip(docs, each, strict=True):
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[i] for i in f) // len(f) if f else 0
        out.append((len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((i for i in range(len(docs)) if each[i][0] >= 20), key=lambda i: (-out[i][2], docs[i][0] is None, docs[i][0] or 0))
    rank = {i: k + 1 for k, i in enumerate(able[: len(able) * pct // 100])}
    return [(*out[i], rank.get(i)) for i in range(len(docs))]


def resampled(spark, docs, target):
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, rank int").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    return [(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in importance_resampling.resample(df, goal).collect()]


def test_resampling_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in queries.documents(spark, sf).collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = plain_resampling(docs, target)
    assert sorted(resampled(spark, docs, target)) == sorted((d, *w) for (d, _), w in zip(docs, want, strict=True))


def test_resampling_edges(spark):
    """NULLs, blank lines, words across lines, one long word, a third of all rows alike, ties by id."""
    hot = "\n".join(["the same line of Words"] * 5) + "\n\n \n" + "ÄÖ ärger x1 " * 5
    docs = [(i, hot) for i in range(40)] + [(100 + i, f"line {i}\nanother\r\nline, {i}-{i % 3}\n" * 8) for i in range(60)]
    docs += [(None, hot), (None, hot), (200, None), (201, ""), (202, "\n \n--"), (203, "w" * 100_000 + " " + "z" * 50), (204, "☃ \U0001f600\tA1b2\x00c"), (100, "again " * 30)]
    target = ["the same line", None, "", "another line"]
    got, want = resampled(spark, docs, target), plain_resampling(docs, target)
    assert sorted(got, key=str) == sorted(((d, *w) for (d, _), w in zip(docs, want, strict=True)), key=str)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, sum(1 for _, t in docs if plain_features(t)[0] >= 20) // 4 + 1))
    assert sorted(resampled(spark, docs[:8], [])) == sorted((d, *w) for (d, _), w in zip(docs[:8], plain_resampling(docs[:8], []), strict=True))
    assert resampled(spark, [], target) == []


def test_resampling_equal_scores(spark):
    """A third of the rows share one id and text, and so one score, at the border of the draw."""
    docs = [(5, "a b " * 15)] * 30 + [(i, "a b " * 15) for i in range(10, 70)]
    got = resampled(spark, docs, ["a"])
    want = plain_resampling(docs, ["a"])
    assert Counter(got) == Counter((d, *w) for (d, _), w in zip(docs, want, strict=True))


def test_lines_are_counted_before_their_features():
    """Equal lines once, times their number; joins between lines apart."""
    lines = importance_resampling.Lines.of([b"a b c", b"", b"d"])
    counts = lines.counts(np.array([3, 1, 2]), 10000)
    want = Counter()
    for text, n in (("a b c", 3), ("d", 2)):
        for f in plain_features(text)[1]:
            want[f] += n
    assert {i: int(n) for i, n in enumerate(counts) if n} == want
    keys, owner = importance_resampling.Segments.of([b"a\nb\n\nA\nB", b"x", b""]).across()
    assert [int(k) for k in keys] == [zlib.crc32(x) for x in (b"a b", b"b a", b"a b")] and list(owner) == [0, 0, 0]
