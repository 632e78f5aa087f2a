"""Every license rule on an example of its own, and texts with very many matches."""

import random
import re
import time

import pytest

pytest.importorskip("public_tokenizers")

from millrace.llm import licenses  # noqa: E402
from tests.llm.test_operators import documents, scan_brute  # noqa: E402


def example(pattern, keyword):
    """Texts that a pattern names: with all optional parts left out, and with all of them, each with the first of alternatives."""
    from re import _constants as c
    from re import _parser

    def spell(tree, most):
        out = ""
        for op, value in tree:
            if op is c.LITERAL:
                out += chr(value)
            elif op is c.IN:
                kind, first = value[0]
                out += chr(first if kind is c.LITERAL else first[0])
            elif op is c.ANY:
                out += "x"
            elif op is c.BRANCH:
                out += spell(value[1][0], most)
            elif op is c.SUBPATTERN:
                out += spell(value[3], most)
            elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
                low, high, inner = value
                out += spell(inner, most) * (min(high, max(low, 1)) if most else low)
        return out

    tree = _parser.parse(pattern)
    every = [spell(tree, most) for most in (False, True)]
    return next((x for x in every if f" {keyword}" in f" {x}"), None)


def test_every_rule_fires_on_its_own_words(spark):
    rules = licenses.rules()
    assert len(rules) >= 400 and len({r.label for r in rules}) >= 180
    rows = [(r.priority, f"Some words before, {example(r.pattern, r.keyword)} and after.") for r in rules if example(r.pattern, r.keyword)]
    assert len(rows) >= 0.97 * len(rules)
    got = {r.doc_id: r for r in licenses.scan(documents(spark, rows)).collect()}
    for i, text in rows:
        want = scan_brute(text)
        assert [tuple(d) for d in got[i].detections] == want[2] and want[2], text
        r = rules[i]
        m = re.search(f" (?:{r.pattern})(?= )", f" {' '.join(re.findall('[a-z0-9]+', text.lower()))} ")
        assert f" {r.keyword}" in f" {m[0]}", r  # the keyword is part of every match, or the rule would never run


def test_notices(spark):
    want = {
        "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License": {"gpl-notice", "gpl"},
        "you may not use this file except in compliance with the License.": {"apache-notice"},
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": {"mpl-2.0"},
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License": {"lgpl-notice", "gpl"},
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.": {"bsd-condition"},
        "The software shall be used for Good, not Evil.": {"json"},
        "http://creativecommons.org/licenses/by-sa/4.0/": {"cc-by-sa-4.0"},
    }
    got = {r.doc_id: set(r.labels) for r in licenses.scan(documents(spark, list(enumerate(want)))).collect()}
    assert got == dict(enumerate(want.values()))


def test_very_many_matches(spark):
    """Time grows in proportion: a hundred thousand matches in one text take seconds."""
    rng = random.Random(3)
    parts = ["MIT License, ", "all rights reserved. ", "GPLv3 ", "word ", "Apache License 2.0; "]
    small = "".join(rng.choice(parts) for _ in range(3000))
    large = "".join(rng.choice(parts) for _ in range(125_000))
    r = licenses.scan(documents(spark, [(1, small)])).first()
    want = scan_brute(small)
    assert [tuple(d) for d in r.detections] == want[2] and [(b.start, b.label) for b in r.base] == want[1] and abs(r.score - want[4]) < 1e-12
    start = time.perf_counter()
    r = licenses.scan(documents(spark, [(1, large)])).first()
    took = time.perf_counter() - start
    assert len(r.detections) >= 99_000 and took < 60, (len(r.detections), took)
