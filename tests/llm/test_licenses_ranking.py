"""Compression ranks the templates and keeps most of them from being compared; wording confirms."""

import re

import pytest

from martline.llm import licenses
from martline.llm.licenses import Matcher, scan_text

TRIGGER = re.compile(licenses.TRIGGER)
LONG = "incomprehensibilities"


def test_ranking_decides_not_the_count_of_words():
    """The text differs from A in one long word and from B in two short ones (a changed word is one missing and one more); B's
    dictionary saves more of it."""
    text = f"this work comes to you with a license x y of the kind {LONG} so to say in full and no more than just that"
    a = text.replace(LONG, "antidisestablishmentarian")
    b = text.replace(" x y ", " p q ")
    got = scan_text(text, Matcher({"A": [a], "B": [b]}), TRIGGER)
    assert [(r["license"], r["differing_words"]) for r in got] == [("B", 4)]
    assert [(r["license"], r["differing_words"]) for r in scan_text(text, Matcher({"A": [a]}), TRIGGER)] == [("A", 2)]


def test_only_passages_over_the_threshold_are_compared(monkeypatch):
    matcher, compared = Matcher(), []
    inner = matcher.confirmed
    monkeypatch.setattr(matcher, "confirmed", lambda own, t, p: compared.append(p) or inner(own, t, p))
    words = " ".join(f"word{i}" for i in range(300))
    text = f"{words} this license of ours is nobody's template {words}"
    assert scan_text(text, matcher, TRIGGER) == [] and not compared
    text = f"{words} {licenses.TEMPLATES['MIT'][3]} {words}"
    assert [r["license"] for r in scan_text(text, matcher, TRIGGER)] == ["MIT"]
    assert len(set(compared)) < len(matcher.passages) / 2


@pytest.mark.parametrize("text", [
    "The license plate of the car was unreadable and the driver had no license to drive.",
    "Copyright (c) 2020 by somebody. All rights reserved. No permission is hereby granted to anybody at all.",
    "Released under pressure, the MIT graduate had no License.",
    "public domain " * 50,
])
def test_what_is_no_notice_is_not_found(text):
    assert scan_text(text, Matcher(), TRIGGER) == []


@pytest.mark.parametrize("share", [0.05, 0.08])
def test_changed_wording_is_found(share):
    matcher = Matcher()
    for name, passage in ((k, p) for k, v in licenses.TEMPLATES.items() for p in v if len(p.split()) > 20):
        words = passage.split()
        step = int(1 / share)
        changed = " ".join("zzq" if k % step == step - 1 and not TRIGGER.search(w) else w for k, w in enumerate(words))
        got = scan_text(f"some words before\n{changed}\nand some after", matcher, TRIGGER)
        assert [r["license"] for r in got] == [name] and 0 < got[0]["differing_words"] <= 0.2 * len(words)
