"""Ranked lexical search against a plain version, and the sharing of sums among items."""

import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from martline.llm import lexical_search
from martline.llm.lexical_search import Plan, lexical_search as search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bag(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def plain(docs, items, k=10):
    bags = [(d, bag(t)) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, words = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for doc, b in bags:
            length = sum(b.values())
            m = 25 + 75 * length * n // words
            s = sum(q * floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t, q in bag(text).items() if t in b)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def tables(spark):
    base = "alpha beta gamma delta Epsilon zeta"
    texts = [None, "", " ", base, base, base + " tail", "ALPHA alpha 9x9 Straße", "straße ÉTÉ été", "beta " * 30, "gamma, delta; alpha-beta", "word " * 20000 + "zeta", "no such thing"]
    docs = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(4, base, "clash", 1), (None, base, None, None), (None, "zeta only", None, None)]
    items = [(1, base, 0), (2, "alpha alpha beta", 0), (2, "alpha alpha beta", 0), (3, None, 0), (4, "", 0), (5, "unseen", 0), (None, "gamma delta straße", 0), (6, base + " été 9x9 word", 0), (7, "beta gamma delta zeta", 0)]
    return (spark.createDataFrame(docs, "doc_id long, text string, row string, rank int"), docs), (spark.createDataFrame(items, "item_id long, text string, score int"), items)


@pytest.mark.parametrize("item_bytes", [1, 60, 1 << 18])
def test_defined_cases(tables, item_bytes):
    (docs, d), (items, q) = tables
    assert rows(search(docs, items, 3, item_bytes)) == plain([r[:2] for r in d], [r[:2] for r in q], 3)


def test_empty_tables(tables):
    (docs, _), (items, _) = tables
    assert search(docs.limit(0), items).count() == 0
    assert search(docs, items.limit(0)).count() == 0
    assert search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_small_blocks(tables, monkeypatch):
    (docs, d), (items, q) = tables
    monkeypatch.setattr(lexical_search, "TEXTS", 2)
    monkeypatch.setattr(lexical_search, "BLOCK", 64)
    assert rows(search(docs.repartition(5), items)) == plain([r[:2] for r in d], [r[:2] for r in q])


@pytest.mark.parametrize("mined", [0, 4, 96])
def test_shared_sums_are_the_items_sums(monkeypatch, mined):
    """Any amount of sharing gives each item's own sum; sharing saves additions."""
    monkeypatch.setattr(lexical_search, "MINED_SYMBOLS", mined)
    draw = np.random.default_rng(3)
    common = draw.choice(1000, 30, replace=False)
    bags = [{int(t): int(draw.integers(1, 3)) for t in np.concatenate([draw.choice(common, 12, replace=False), draw.integers(1000, 2000, 5)])} for _ in range(40)]
    bags += [dict(bags[0]), {}, {5: 1}]
    plan = Plan([dict(b) for b in bags])
    value = draw.integers(0, 1 << 40, (len(plan.vocabulary), 7))
    got = plan.scores(value[plan.term] * plan.times[:, None])
    at = {int(t): i for i, t in enumerate(plan.vocabulary)}
    want = [sum((n * value[at[t]] for t, n in b.items()), np.zeros(7, np.int64)) for b in bags]
    assert np.array_equal(got, np.array(want))
    assert plan.additions < plan.additions_alone if mined else plan.additions <= plan.additions_alone
