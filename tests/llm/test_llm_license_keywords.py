"""Keywords and gates of the license scan may only save time: whatever a rule's
expression matches holds its keyword and passes the gate."""

from __future__ import annotations

import itertools
from re import _parser

import pytest
from brute import frame

from shelfmark.llm.license_rules import rules
from shelfmark.llm.licenses import GATES, scan_licenses


def matches(parsed):
    """Texts that an expression matches: every branch, optional parts with and without."""
    parts = []
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            parts.append([chr(arg)])
        elif name == "IN":
            parts.append([chr(v[0] if isinstance(v, tuple) else v) for _, v in arg])
        elif name == "MAX_REPEAT":
            low, high, inner = arg
            parts.append([x * n for n in {low, max(low, 1)} for x in matches(inner)])
        elif name == "SUBPATTERN":
            parts.append(matches(arg[3]))
        elif name == "BRANCH":
            parts.append([x for b in arg[1] for x in matches(b)])
        elif name != "ASSERT":
            raise ValueError(name)
    return ["".join(p) for p in itertools.product(*parts)]


def test_every_match_holds_the_keyword_and_passes_the_gate():
    bare = [r for r in rules() if r.rank in (0, 3)]  # names, notices and base phrases as such
    assert len({r.keyword for r in bare}) > 40
    for r in bare:
        for text in matches(_parser.parse(r.pattern)):
            assert r.keyword in text, (r, text)
            assert any(all(p in text for p in g.split("+")) for g in GATES), (r, text)
    # the other forms put words around the same names
    names = {(r.keyword, r.label) for r in bare}
    assert {(r.keyword, r.label) for r in rules()} <= names


@pytest.fixture(scope="module")
def found(spark):
    texts = [
        "Released under MPL 2.0", "licensed under MS-PL", "licensed under MS-RL",
        "Creative Commons Attribution-Share Alike 3.0", "LGPL v2.1", "the Expat License",
        "PSF License", "GNU Library General Public License",
    ]
    got = scan_licenses(frame(spark, list(enumerate(texts)))).collect()
    return {texts[r.doc_id]: (r.labels, r.score) for r in got}


def test_names_without_an_unrelated_word(found):
    assert found == {
        "Released under MPL 2.0": ("mpl-2", 0.95),
        "licensed under MS-PL": ("ms-pl", 0.95),
        "licensed under MS-RL": ("ms-rl", 0.95),
        "Creative Commons Attribution-Share Alike 3.0": ("cc-by-sa", 0.8),
        "LGPL v2.1": ("lgpl-2.1", 0.8),
        "the Expat License": ("mit", 0.8),
        "PSF License": ("python", 0.8),
        "GNU Library General Public License": ("lgpl", 0.8),
    }
