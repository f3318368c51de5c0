"""A notice is found among other words of its line, and whatever its rank among the templates."""

import re

import pytest

from martline.llm import licenses

MATCHER, TRIGGER = licenses.Matcher(), re.compile(licenses.TRIGGER)
PASSAGES = [(k, p) for k, v in licenses.TEMPLATES.items() for p in v]


@pytest.mark.parametrize("others", [8, 20, 40, 2000])
def test_notice_in_a_long_line(others):
    around = " ".join(f"word{i}" for i in range(others // 2))
    for name, passage in PASSAGES:
        got = licenses.scan_text(f"{around} {passage} {around}", MATCHER, TRIGGER)
        assert [(x["license"], x["differing_words"], x["start"]) for x in got] == [(name, 0, len(around) + 1 if around else 0)], passage


def test_all_notices_of_one_line():
    text = " and then some other words ".join(p for _, p in PASSAGES)
    got = licenses.scan_text(text, MATCHER, TRIGGER)
    assert [(x["license"], x["differing_words"]) for x in got] == [(k, 0) for k, _ in PASSAGES]
