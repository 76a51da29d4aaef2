"""NULLs, empty and long texts, ties, repeated rows, empty tables and clashing names; large groups of copies."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lossgrid.llm import (
    bpe_codec,
    exact_dedup,
    license_scan,
    near_dedup,
    quality_classifier,
    quality_rules,
    queries,
    routing,
    secret_scan,
    source_mix,
    substring_dedup,
    token_counts,
    words,
)
from lossgrid.llm.components import connected_components
from tests.llm import reference

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp int, _gone string, row int, kept int, rep int, h int, size int"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
TEXTS = [
    (1, "one two three four five six", "en", "a"),
    (2, None, "en", None),
    (3, "", None, "b"),
    (4, " \t\n ", "en", "a"),
    (5, LONG, "en", "a"),
    (6, LONG, "de", "b"),
    (7, "ONE Two three four five six", "en", "b"),
    (8, "é😀 \x1c ıſK▁ naïve", "fr", "c"),
    (9, "x" * 70_000, "en", "c"),
    (9, "x" * 70_000, "en", "c"),
    (None, "one two three four five six", None, "a"),
    (11, "Released under the MIT License.\n\ntoken = abcdefgh12345678", "en", "b"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(*r, 0, 1, "x", 2, 3, 4, 5, 6) for r in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 0), (5, None, 1), (77, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")


BPE = public_tokenizers.path(queries.BYTE_BPE)
PIECES = public_tokenizers.path(queries.PIECE_BPE)
OPERATORS = {
    "grade": lambda d, l: quality_classifier.grade(d, quality_classifier.train(d, l)),
    "remove_repeats": lambda d, l: substring_dedup.remove_repeats(d),
    "mix": lambda d, l: source_mix.mix(d),
    "near_duplicates": lambda d, l: near_dedup.near_duplicates(d),
    "judge": lambda d, l: quality_rules.judge(d),
    "licenses": lambda d, l: license_scan.scan(d),
    "secrets": lambda d, l: secret_scan.scan(d),
    "codec": lambda d, l: bpe_codec.decode(bpe_codec.encode(d, BPE, public_tokenizers.PATTERN), BPE, public_tokenizers.PATTERN),
    "count_tokens": lambda d, l: token_counts.count_tokens(d, PIECES),
    "duplicate_groups": lambda d, l: exact_dedup.duplicate_groups(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_every_row_is_answered(edge, empty, labels, name):
    assert OPERATORS[name](empty, labels).count() == 0
    rows = OPERATORS[name](edge, labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in TEXTS)
    by_id = {r.doc_id: r for r in rows}
    text = {r[0]: r[1] or "" for r in TEXTS}
    if name == "duplicate_groups":
        assert (by_id[2].keep_id, by_id[3].kept, by_id[2].group_size) == (3, True, 2)
        assert (by_id[5].keep_id, by_id[9].group_size, by_id[None].keep_id) == (6, 2, 1)
        assert all(r.text_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() for r in rows)
    elif name == "near_duplicates":
        assert [(by_id[d].n_shingles, by_id[d].component_id) for d in (2, 3, 4)] == [(0, 2), (0, 3), (0, 4)]
        assert by_id[7].component_id == 1 and by_id[6].component_id == 5 and by_id[None].kept
    elif name == "remove_repeats":
        known = reference.without_repeats([(r[0] or -(2**63), r[1]) for r in TEXTS if r[0] != 9])
        assert all((r.n_words, r.n_removed, r.kept_text) == known[r.doc_id or -(2**63)] for r in rows if r.doc_id != 9)
    elif name == "judge":
        assert by_id[2].base_failed and by_id[4].n_words == 0
        assert all((r.n_words, r.word_chars) == reference.base_rules(text[r.doc_id])[:2] for r in rows)
    elif name == "mix":
        assert all(0 <= r.taken <= 3 * r.size for r in rows)
        taken = {r.source: sum(x.taken for x in rows if x.source == r.source) for r in rows}
        assert all(abs(taken[r.source] - r.target) < 1 for r in rows)
    elif name == "codec":
        assert all(bytes(r.decoded) == text[r.doc_id].encode() for r in rows)
    elif name == "secrets":
        assert by_id[11].n_assign == 1 and by_id[2].spans == ""
    elif name == "licenses":
        assert by_id[11].licenses == "MIT" and by_id[3].best_license is None


def test_filters_keep_columns_and_one_of_each(edge, empty, labels):
    for stage in (exact_dedup.drop_exact_duplicates, near_dedup.drop_near_duplicates, source_mix.draw):
        assert stage(empty).count() == 0
        assert stage(edge).columns == edge.columns
    left = exact_dedup.drop_exact_duplicates(edge).collect()
    assert len(left) == len({r[1] or "" for r in TEXTS})
    assert quality_classifier.drop_poor(edge, labels).columns == edge.columns


def _near_group(n: int, seed: int) -> list[tuple[int, str]]:
    """A text with n variants, each with some words changed, and unrelated texts."""
    r = random.Random(seed)
    base = [f"b{i}" for i in range(220)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(r.randint(0, 7)):
            w[r.randrange(len(w))] = f"c{r.randrange(30)}"
        rows.append((i * 3, " ".join(w)))
    rows += [(i * 3 + 1, " ".join(r.choices(base, k=60))) for i in range(40)]
    return rows


def test_large_group_of_near_copies(spark):
    """Chains over members that are no neighbours of the smallest one are found too."""
    rows = _near_group(150, 5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = near_dedup.near_duplicates(docs, threshold_pct=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == reference.near_components(rows, 85)


def test_repeats_among_near_copies(spark):
    rows = _near_group(60, 6)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = substring_dedup.remove_repeats(docs).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in found} == reference.without_repeats(rows)


def test_short_line_in_a_third_of_all_rows(spark, monkeypatch):
    """A line of 12 words with other words around it in each row: its variants do not meet in one task."""
    r = random.Random(7)
    line = [f"footer{i}" for i in range(12)]
    fresh = lambda n: [f"u{r.randrange(10**9)}" for _ in range(n)]
    around = [(fresh(15), fresh(15)) for _ in range(20)]
    rows = []
    for i in range(900):
        a, b = around[i % 20] if i % 15 == 0 else (fresh(15), fresh(15))
        rows.append((i, " ".join(fresh(10) + a + (line if i % 3 == 0 else fresh(12)) + b)))
    monkeypatch.setattr(substring_dedup, "HEAVY_PLACES", 50, raising=False)
    seen, covers = [], substring_dedup._covers
    monkeypatch.setattr(substring_dedup, "_covers", lambda found, window: seen.append(found) or covers(found, window))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = substring_dedup.remove_repeats(docs).collect()
    assert {x.doc_id: (x.n_words, x.n_removed, x.kept_text) for x in found} == reference.without_repeats(rows)
    assert sum(x.n_removed for x in found) > 0
    largest = seen[0].filter("NOT settled").groupBy("anchor").count().agg(F.max("count")).first()[0]
    assert largest <= 50


def test_small_languages_have_references_of_their_own(spark):
    """Languages under a hundredth of all words: judged by their own words, or not by divergence if they have few."""
    r = random.Random(8)
    latin, thai = [f"w{i}" for i in range(300)], ["".join(chr(0x0E01 + r.randrange(40)) for _ in range(6)) for _ in range(300)]
    rows = [(i, " ".join(r.choices(latin, k=3000)), "en") for i in range(400)]
    rows += [(1000 + i, " ".join(r.choices(thai, k=550)), "th") for i in range(20)]
    rows += [(2000, " ".join(r.choices(thai, k=200)), "lo"), (2001, " ".join(r.choices(latin, k=200)), "th"), (2002, "", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string").repartition(3)
    found = {x.doc_id: x for x in quality_rules.judge(docs).collect()}
    assert len(found) == len(rows) and all(found[i].kept for i in [*range(400), *range(1000, 1020)])
    assert found[2000].kept and found[2000].class_distance is None and found[2000].word_distance is None
    assert not found[2001].kept and found[2001].class_distance > 0.3


def test_a_language_is_judged_alike_in_any_corpus(spark):
    """5,200 words of a language are too few for a reference, whatever share of all words they are."""
    r = random.Random(11)
    words_of = [[f"{p}{i}" for i in range(300)] for p in "wv"]
    odd = " ".join(f"#{i}?" for i in range(200))
    verdicts = []
    for n in (40, 200):
        rows = [(i, " ".join(r.choices(words_of[0], k=2600)), "en") for i in range(n)]
        rows += [(900 + i, " ".join(r.choices(words_of[1], k=1000)), "xx") for i in range(5)] + [(990, odd, "xx")]
        docs = spark.createDataFrame(rows, "doc_id int, text string, lang string").repartition(3)
        verdicts.append([(x.doc_id, x.kept, x.class_distance) for x in quality_rules.judge(docs).filter("doc_id >= 900").orderBy("doc_id").collect()])
    assert verdicts[0] == verdicts[1] == [(i, True, None) for i in [*range(900, 905), 990]]


@pytest.mark.parametrize(("rows", "slots"), [(0, 1 << 18), (1 << 40, 1 << 18), (2, 8)])
def test_copies_by_every_way(spark, monkeypatch, rows, slots):
    """Verdicts by broadcast alone, by shuffle alone and by both agree with a plain window over the texts."""
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", rows)
    monkeypatch.setattr(exact_dedup, "HOT_SLOTS", slots)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.filter("doc_id % 5 = 0").select((F.col("doc_id") + 5000).alias("doc_id"), "text"))
    same = Window.partitionBy(F.coalesce("text", F.lit("")))
    want = docs.select(
        "doc_id", F.max("doc_id").over(same).alias("keep_id"), F.count(F.lit(1)).over(same).alias("group_size"),
        (F.col("doc_id") == F.max("doc_id").over(same)).alias("kept"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )
    assert sorted(exact_dedup.duplicate_groups(docs).collect()) == sorted(want.collect())
    left = exact_dedup.drop_exact_duplicates(docs)
    assert sorted(r.doc_id for r in left.collect()) == sorted(r.doc_id for r in want.filter("kept").collect())


def test_texts_of_unique_rows_do_not_move(spark):
    """The bit table leaves unique rows in place: only marked ones reach the exchange."""
    values = spark.range(0, 2000).select(F.xxhash64("id").alias("h"), "id")
    table = routing.membership(values.filter("id % 10 = 0").select("h"), "h", "test-bits")
    tested = routing.with_maybe(values, "h", table)
    assert tested.filter("maybe").count() < 320 and tested.filter("maybe AND id % 10 = 0").count() == 200
    plan = exact_dedup.drop_exact_duplicates(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    branch = plan._jdf.queryExecution().executedPlan().toString().split("SortAggregate")[0]
    assert "Exchange hashpartitioning" not in branch and "SortMergeJoin" not in branch


def test_rows_without_an_id_spread_over_the_mix(spark):
    docs = spark.createDataFrame([(None if i % 2 else 3, f"w{i} " * (1 + i % 4), "a") for i in range(300)], "doc_id int, text string, source string")
    sized = source_mix._sized(docs, 42, "doc_id", "text", "source")
    assert sized.select("slice").distinct().count() > 250
    found = source_mix.mix(docs.unionByName(docs.limit(40))).collect()
    assert sum(x.taken for x in found) == int(found[0].target) and all(x.taken <= 3 * x.size for x in found)


def test_no_python_in_the_mix(edge):
    plan = source_mix.mix(edge)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}


def test_word_hashes_depend_on_words_alone():
    a = next(words.blocks([b"alpha beta", b"", b"gamma"]))
    b = next(words.blocks([b"  beta\tgamma\nalpha "]))
    assert sorted(a.hashes().tolist()) == sorted(b.hashes().tolist()) and list(a.first) == [0, 2, 2, 3]
    text = b"word " * 300_000
    hashes = next(words.blocks([text])).hashes()
    assert len(hashes) == 300_000 and len(np.unique(hashes)) == 1


def test_filters_merge_without_loss():
    r = np.random.default_rng(3)
    parts = [np.unique(r.integers(0, 2**40, 500, dtype=np.uint64), return_counts=True) for _ in range(4)]
    parts.append((parts[0][0][:50], np.full(50, 7)))
    decoded = [exact_dedup.decode_filter(exact_dedup.encode_filter(k, c, 40), 40) for k, c in parts]
    keys, counts = exact_dedup.merge_filters(decoded)
    expected: dict[int, int] = {}
    for k, c in parts:
        for key, n in zip(k.tolist(), c.tolist()):
            expected[key] = expected.get(key, 0) + n
    assert dict(zip(keys.tolist(), counts.tolist())) == expected


def test_codec_and_counts_on_odd_texts():
    import tiktoken, base64, sentencepiece  # noqa: E401

    with open(BPE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    codec, counter = bpe_codec.ByteBpe(BPE, public_tokenizers.PATTERN), token_counts.PieceCounter(PIECES)
    r = random.Random(2)
    letters = list("abcehot  \n\t's▁é€😀的ßİ\x1c\x85\xa0") + ["the", "  ", "<|endoftext|>", "<s>", "<0x0A>"]
    texts = ["".join(r.choices(letters, k=r.randint(0, 40))) for _ in range(3000)] + ["a" * 5000, "ab" * 3000, "thein" * 400]
    ids, offsets = codec.encode(texts)
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == library.encode_ordinary(text)
        assert counter.count(text) == len(pieces.encode(text))


def test_viterbi_with_the_bound_is_viterbi(monkeypatch):
    """The pruned decoding equals the decoding of every token."""
    r = np.random.default_rng(4)
    field = secret_scan.Field(r.normal(0, 1.5, (int(secret_scan.OFFSETS[-1]) + 1, 3)), np.where(np.eye(3, k=2) > 0, -1e9, r.normal(0, 1, (3, 3))))
    field.weights[:, 0] += 0.6
    features = r.integers(0, secret_scan.TEMPLATES, (400, len(secret_scan.TEMPLATES))) + secret_scan.OFFSETS[:-1]
    first = np.array([0, 150, 150, 400])
    scores = field.emissions(features)
    whole = np.concatenate([field._viterbi(scores[a:b]) for a, b in ((0, 150), (150, 400))])

    def total(labels):
        out = 0.0
        for a, b in ((0, 150), (150, 400)):
            y = [0, *labels[a:b], 0]
            out += sum(field.transitions[p, q] for p, q in zip(y, y[1:])) + scores[np.arange(a, b), labels[a:b]].sum()
        return out

    assert total(field.decode(features, first)) == pytest.approx(total(whole))
