"""Licences between other words, against a plain Dice coefficient over every window."""

from __future__ import annotations

import random
import re

import pytest

from lossgrid.llm import license_scan

APACHE = license_scan.TEMPLATES["Apache-2.0"][0]


def plain_words(text: str) -> list[str]:
    return re.sub("[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", " ", re.sub("[A-Z]+", lambda m: m[0].lower(), text)).split()


def pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


def any_window(text: str) -> set[str]:
    """Licences with a window of the template's length (or a unit of any length) that reaches the threshold."""
    found = set()
    own = plain_words(text)
    for name, templates in license_scan.TEMPLATES.items():
        for t in map(plain_words, templates):
            b = pairs(t)
            for i in range(len(own) - 1):
                a = pairs(own[i : i + len(t)])
                if 200 * len(a & b) >= license_scan.THRESHOLD_PCT * (len(a) + len(b)):
                    found.add(name)
    return found


def scanned(spark, texts: list[str]) -> list:
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return license_scan.scan(rows).orderBy("doc_id").collect()


@pytest.mark.parametrize(
    "text, expected",
    [
        (APACHE + " Copyright 2020 The Project Authors here", "Apache-2.0"),
        ("Some words ahead of it. " + APACHE + " and many more behind it, in one line of prose.", "Apache-2.0"),
        ("// SPDX-License-Identifier: MIT\nint main() { return 0; }", "MIT"),
        ("# SPDX-License-Identifier: GPL-2.0-only\nimport os", "GPL-2.0"),
        ("int x;\n" + license_scan.TEMPLATES["GPL-2.0"][1] + " int y; return x + y;", "GPL-2.0"),
        ("/* " + license_scan.TEMPLATES["BSD-2-Clause"][1] + " */ class A {}", "BSD-2-Clause"),
        ("/* " + license_scan.TEMPLATES["BSD-3-Clause"][2] + " */ class A {}", "BSD-3-Clause"),
        ("We talked about the license of the driver and the public library.", ""),
        ("Released under the name of another author; the MIT campus is near.", ""),
    ],
)
def test_between_other_words(spark, text, expected):
    (row,) = scanned(spark, [text])
    assert row.licenses == expected
    for span in filter(None, row.spans.split(",")):
        name, start, end = span.rsplit(":", 2)
        inside = plain_words(text[int(start) : int(end)])
        assert max(
            2 * len(pairs(inside) & pairs(t)) / (len(pairs(inside)) + len(pairs(t)))
            for t in map(plain_words, license_scan.TEMPLATES[name])
            if len(t) > 1
        ) >= license_scan.THRESHOLD_PCT / 100


def test_against_every_window(spark):
    r = random.Random(3)
    common = "the of this software work copy license and use terms public version general under is a to".split()
    texts = []
    for k in range(150):
        words = [r.choice(common) for _ in range(r.randrange(0, 60))]
        for _ in range(r.randrange(0, 3)):
            name = r.choice(sorted(license_scan.TEMPLATES))
            t = r.choice(license_scan.TEMPLATES[name]).split()
            for _ in range(r.randrange(0, 3)):
                t[r.randrange(len(t))] = r.choice(common)
            at = r.randrange(len(words) + 1)
            words[at:at] = t
        texts.append(r.choice((" ", "  ", " * ")).join(words))
    for text, row in zip(texts, scanned(spark, texts)):
        known = any_window(text)
        assert (row.n_matches > 0) >= bool(known)
        best = set(row.licenses.split(",")) - {""}
        assert not known or best & known
        spans = [tuple(map(int, s.rsplit(":", 2)[1:])) for s in filter(None, row.spans.split(","))]
        assert all(0 <= a < b <= len(text) for a, b in spans)


def test_repeated_statement_is_listed_each_time(spark):
    (row,) = scanned(spark, [APACHE + "".join(f" part{k} of{k} book{k} by{k} {APACHE}" for k in range(4))])
    assert row.n_matches == 5 and row.licenses == "Apache-2.0"
