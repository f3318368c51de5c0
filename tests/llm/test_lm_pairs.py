"""Pairs that occur once in training are evidence too."""

import numpy as np
import pyarrow as pa

from martline.llm import lm_scoring
from martline.llm.chunks import SCHEMA


def test_filter_holds_pairs_seen_once():
    ids = [i for i in range(20) if not lm_scoring.held_out(i)][:2]
    texts = ["alpha beta gamma alpha beta", "delta epsilon"]
    chunk = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": texts, "chunk": pa.array([0, 0], pa.int32())})
    merged = lm_scoring._merge(1)(lm_scoring._count(1)(chunk)).to_pylist()
    assert set(merged[0]) == set(SCHEMA.names)
    data = next(r["data"] for r in merged if r["kind"] == "filter")
    lookup = lm_scoring.LogFrequencyFilter([len(data)], data)
    token, before, _ = lm_scoring.tokens(chunk.column("text"))
    two = lm_scoring.pairs(before, token)
    levels = lookup.levels(lm_scoring.pair_keys(two >> np.uint64(24), np.zeros(len(two), np.int64), 1))
    assert (levels >= 1).all() and levels[1] == levels[4] > 1  # "alpha beta" twice, the others once


def test_messages_stay_large_and_segments_answer_in_one_trip():
    """Chunks send counts once; the partition answers with the levels of its segment, held-out pairs included."""
    train = [i for i in range(20) if not lm_scoring.held_out(i)][0]
    held = [i for i in range(20) if lm_scoring.held_out(i)][0]
    chunk = pa.table({"doc_id": pa.array([train, held], pa.int64()), "text": ["alpha beta alpha beta", "beta gamma"], "chunk": pa.array([0, 0], pa.int32())})
    merged = lm_scoring._merge(1, True)(lm_scoring._count(1, True)(chunk)).to_pylist()
    assert sorted(r["kind"] for r in merged) == ["count", "pair level", "stats", "word level"]
    token, before, _ = lm_scoring.tokens(chunk.column("text"))
    plain = lm_scoring._merge(1)(lm_scoring._count(1)(chunk)).to_pylist()
    data = next(r["data"] for r in plain if r["kind"] == "filter")
    lookup, by = lm_scoring.LogFrequencyFilter([len(data)], data), {r["kind"]: r["data"] for r in merged}
    assert by["word level"] == lookup.levels(np.unique(token)).tobytes()
    two = np.unique(lm_scoring.pairs(before, token))
    assert by["pair level"] == lookup.levels(lm_scoring.pair_keys(two >> np.uint64(24), np.zeros(len(two), np.int64), 1)).tobytes()
    assert [r for r in merged if r["kind"] == "stats"] == [r for r in plain if r["kind"] == "stats"]
