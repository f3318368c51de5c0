"""Every passage of every template is found however it is wrapped."""

import re
import textwrap

import pytest

from martline.llm import licenses

MATCHER, TRIGGER = licenses.Matcher(), re.compile(licenses.TRIGGER)
PASSAGES = [(k, p) for k, v in licenses.TEMPLATES.items() for p in v]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_wrapped_passages(mark):
    for name, passage in PASSAGES:
        lines = [mark + x for x in textwrap.wrap(passage, 72)]
        text = "\n".join(["def before(): pass", "", *lines, "", "int after = 0;"])
        got = licenses.scan_text(text, MATCHER, TRIGGER)
        assert [(x["license"], x["differing_words"]) for x in got] == [(name, 0)], passage
        assert text[got[0]["start"] : got[0]["end"]] == "\n".join(lines), passage


def test_passage_over_paragraphs():
    passage = licenses.TEMPLATES["BSD-2-Clause"][2].replace(" 1. ", "\n\n1. ").replace(" 2. ", "\n\n2. ")
    text = "\n".join(["Copyright (c) 2020, A. Name", "", *(textwrap.fill(p, 72, initial_indent="# ", subsequent_indent="# ") + "\n#" for p in passage.split("\n\n"))])
    assert [(x["license"], x["differing_words"]) for x in licenses.scan_text(text, MATCHER, TRIGGER)] == [("BSD-2-Clause", 0)]


def test_repeated_notices():
    for name, passage in PASSAGES:
        got = licenses.scan_text("\n".join([passage] * 3), MATCHER, TRIGGER)
        assert [(x["license"], x["differing_words"]) for x in got] == [(name, 0)] * 3, passage
