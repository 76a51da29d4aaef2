"""NULL ids and ids repeated with different texts: rows are decided one by one."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from lossgrid.llm import exact_dedup, near_dedup, source_mix, substring_dedup
from tests.llm import reference


def test_pipeline_stages_decide_per_row(spark, sf_dir):
    r = random.Random(9)
    text = lambda n: " ".join(f"v{r.randrange(10**6)}" for _ in range(n))
    own, shared, near = [text(60 + i) for i in range(8)], text(50), text(300)
    rows = [(None, t, "a") for t in own[:5]] + [(7, t, "b") for t in own[5:]]
    rows += [(None, shared, "a"), (7, shared, "a"), (50, shared, "b")]
    rows += [(None, near, "a"), (None, near + " more", "a"), (3, near + " less", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    unique = exact_dedup.drop_exact_duplicates(docs)
    assert sorted(map(str, unique.collect())) == sorted(map(str, (spark.createDataFrame([x for x in rows if x[1] != shared or x[0] == 50], docs.schema).collect())))
    apart = near_dedup.drop_near_duplicates(unique)
    left = [tuple(x) for x in apart.collect()]
    assert sorted(left, key=str) == sorted([x for x in rows if x[1] in own or x[0] in (3, 50)], key=str)
    mixed = source_mix.draw(apart)
    taken, words = Counter(), {t: reference.words(t) for _, t, _ in left}
    for x in mixed.collect():
        full = next(t for i, t, _ in left if i == x.doc_id and words[t][: len(reference.words(x.text))] == reference.words(x.text))
        taken[full] += len(reference.words(x.text))
    assert all(taken[t] <= 3 * len(w) for t, w in words.items())
    assert abs(sum(taken.values()) - sum(map(len, words.values()))) <= 2
    final = corpus_pipeline.token_ids(spark, mixed, sf_dir).collect()
    assert len(final) == mixed.count() and all(x.round_trip for x in final)


def test_repeats_of_rows_without_an_id(spark):
    r = random.Random(10)
    a, b, c = ([f"v{r.randrange(10**6)}" for _ in range(n)] for n in (80, 90, 70))
    rows = [(None, a), (None, b), (None, a), (5, c[:20] + a[30:60] + c[20:]), (5, b[::-1]), (6, a)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string").repartition(3)
    found = Counter((x.doc_id, x.n_words, x.n_removed, x.kept_text) for x in substring_dedup.remove_repeats(docs).collect())
    assert found == Counter([
        (None, 80, 0, " ".join(a)), (None, 80, 80, ""), (None, 90, 0, " ".join(b)),
        (5, 100, 30, " ".join(c)), (5, 90, 0, " ".join(b[::-1])), (6, 80, 80, ""),
    ])
