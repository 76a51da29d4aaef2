"""The field: its gradient, forms of secrets it was not trained on, clean texts, reruns."""

from __future__ import annotations

import random
import string

import numpy as np
import pytest

from lossgrid.llm import secret_scan

ALNUM = string.ascii_letters + string.digits


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def field(docs):
    return secret_scan.train(secret_scan.id_and_text(docs))


def held_out(n: int) -> list[tuple[str, str]]:
    """Secrets in forms that neither the patterns nor the training forms have."""
    r = random.Random(n)

    def some(size: int, letters: str = ALNUM) -> str:
        return "".join(r.choices(letters, k=size))

    forms = (
        lambda: ("", "glpat-" + some(20)),
        lambda: ("", "npm_" + some(36)),
        lambda: ("auth=", some(30)),
        lambda: ("deploy key ", some(40, ALNUM + "+/")),
        lambda: ("", "hf_" + some(34)),
        lambda: ("login with ", some(32)),
        lambda: ("pwd := ", some(14)),
        lambda: ("api credential: ", "glpat-" + some(20)),
        lambda: ("PGPASS ", some(24)),
        lambda: ("bearer ", some(50, ALNUM + "-_")),
        lambda: ("", "SG." + some(22) + "." + some(43)),
        lambda: ("cookie ", "s%3A" + some(32)),
        lambda: ("dop ", "dop_v1_" + some(40)),
    )
    return [forms[k % len(forms)]() for k in range(n)]


def test_held_out_forms_are_tagged_and_clean_texts_are_not(spark, docs, field):
    texts = [r.text for r in docs.filter("length(text) > 400").orderBy("doc_id").limit(140).collect()]
    rows, places = [], {}
    for i, (text, (ahead, secret)) in enumerate(zip(texts, held_out(len(texts)))):
        head = text[:200] + " " + ahead
        rows.append((i, head + secret + " " + text[200:400]))
        places[i] = (len(head), len(head) + len(secret))
    found = secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), field).collect()
    hit = 0
    for r in found:
        spans = [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("crf")]
        low, high = places[r.doc_id]
        hit += any(min(b, high) - max(a, low) >= 0.8 * (high - low) for a, b in spans)
    print("held-out secrets tagged:", hit, "of", len(rows))
    assert hit >= 0.85 * len(rows)
    clean = secret_scan.scan(docs, field).filter("n_assign + n_access + n_hex = 0").collect()
    assert len(clean) > 900 and sum(r.n_crf > 0 for r in clean) <= 0.01 * len(clean)


def test_harmless_lines_are_left_alone(spark, field):
    rows = [(i, f"We met on Monday. {line} and then went home.") for i, line in enumerate(secret_scan.HARMLESS)]
    found = secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), field).collect()
    assert sum(r.n_crf for r in found) <= 1


def test_rerun_trains_the_same_field(docs, field):
    again = secret_scan.train(secret_scan.id_and_text(docs.repartition(7)))
    assert np.array_equal(again.weights, field.weights) and np.array_equal(again.transitions, field.transitions)


def test_written_line_is_where_it_says():
    for k in range(200):
        r = random.Random(k)
        text, place, start, end = secret_scan.write_into("one two  three " * (k % 5), r)
        assert place <= start <= end <= len(text) and (k % 5 == 0 or text.replace("\n", " ").startswith("one") or place < 5)
        if end > start:
            assert " " not in text[start:end] and "\n" not in text[start:end]


def test_fit_climbs_the_exact_likelihood():
    """The fitted field against the likelihood summed over all labellings of short sequences."""
    r = np.random.default_rng(4)
    features = r.integers(0, 3, (40, 4, len(secret_scan.TEMPLATES))) + secret_scan.OFFSETS[:-1]
    labels = np.array([[0, 1, 2, 0] if f[1, 0] % 3 == 1 else [0, 0, 0, 0] for f in features])

    def likelihood(field: secret_scan.Field) -> float:
        total = 0.0
        for f, y in zip(features, labels):
            e = field.emissions(f)

            def score(path):
                full = [0, *path, 0]
                return sum(e[i, p] for i, p in enumerate(path)) + sum(field.transitions[a, b] for a, b in zip(full, full[1:]))

            paths = [tuple(p) for p in np.ndindex(3, 3, 3, 3)]
            every = np.array([score(p) for p in paths])
            total += score(tuple(y)) - np.log(np.exp(every - every.max()).sum()) - every.max()
        return total / len(features)

    fitted = secret_scan.fit(features, labels)
    start = secret_scan.Field(np.zeros_like(fitted.weights), np.where(np.eye(3, k=2) > 0, -1e9, np.zeros((3, 3))))
    best = likelihood(fitted)
    assert best > likelihood(start) + 1.0 and best > -0.3
    for _ in range(5):
        moved = secret_scan.Field(fitted.weights + r.normal(0, 0.5, fitted.weights.shape), fitted.transitions)
        assert likelihood(moved) < best
