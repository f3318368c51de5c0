"""Best-fit packing: ids against the tokenizer itself, whole documents back, and a search that empties bins."""

from itertools import combinations
from random import Random
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from martline.llm import packing
from martline.llm.hashing import text_blocks

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
ODD = ["  a  b", "\n\n x \n y", "a  b 　 c  ", "", " ", "<|endoftext|> x <|endoftext|>", "tab\t x\t\ty", "a \x1c b", "é\n\nè  \n", "don't we'll  I'm", "x" * 5000, " " * 300 + "z", " a b", "日本 語  ok", "¿ ¿que” “foo – bar", " \u0085 x", "z  a", "ªº ²³ ½x"]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def ids_of(texts):
    out = []
    for _, buf, offsets in text_blocks(pa.array(texts), 1 << 16):
        ids, n = packing.known_ids(PATH).of(buf, offsets)
        out += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    return out


def test_ids_are_the_tokenizers(spark, tokenizer):
    draw = Random(1)
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + ODD
    texts += ["".join(draw.choice("ab  \n\t'sé  日.1　") for _ in range(draw.randint(0, 30))) for _ in range(5000)]
    assert ids_of(texts) == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def check(rows, docs, tokenizer, capacity):
    """Every document comes back from its pieces, and every sequence is full without gaps up to its length."""
    want = sorted((str(d), t or "") for d, t in docs)
    ids = {t: tokenizer.encode(t, add_special_tokens=False).ids + [2] for _, t in want}
    pieces = []
    for d, t in want:
        n = len(ids[t])
        first = n if n <= capacity else n % capacity or capacity
        for k, at in enumerate([0, *range(first, n, capacity)]):
            part = ids[t][at : first if k == 0 else at + capacity]
            pieces.append((d, k, at, len(part), crc32(np.array(part, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(pieces)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_whole_table(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack_documents(docs, PATH).collect()
    n = check(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, 1024)
    assert n <= sum(r.length for r in rows) / 1024 * 1.02 + 1


def test_defined_cases(spark, tokenizer):
    texts = [None, "", " ", "word " * 700, "a b c", "a b c", *ODD]
    rows = [(i, t, "clash", 7) for i, t in enumerate(texts)] + [(4, "a b c", "clash", 7), (None, "no id", None, None), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place string, shard int")
    for shard_pieces in (3, 1000):
        got = packing.pack_documents(docs, PATH, capacity=64, shard_pieces=shard_pieces).collect()
        check(got, [r[:2] for r in rows], tokenizer, 64)
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("sizes", [[9, 8, 8, 6, 4, 4], [10, 9, 6, 5, 5, 3, 2], [10, 9, 9, 8, 7, 6, 6, 4]])
def test_search_empties_bins(sizes):
    """Best fit, longest first, takes one bin of 20 more than needed; exchanges empty it."""
    sizes = np.array(sizes)
    bins = packing.best_fit(sizes, 20)
    fewest = -(-sizes.sum() // 20)
    assert len(bins) == fewest + 1
    assert len(packing.local_search(sizes, bins, 20)) == fewest


@pytest.mark.parametrize("seed", range(6))
def test_search_keeps_pieces_and_never_adds_bins(seed):
    sizes = np.random.default_rng(seed).integers(1 if seed % 2 else 20, 60, 300)
    before = packing.best_fit(sizes, 100)
    squares = lambda bins: sum(int(sizes[b].sum()) ** 2 for b in bins)
    start = squares(before)
    after = packing.local_search(sizes, [list(b) for b in before], 100)
    assert sorted(i for b in after for i in b) == list(range(300))
    assert max(sizes[b].sum() for b in after) <= 100
    assert len(after) <= len(before) and squares(after) >= start
    # nothing of the named kinds is left: no piece fits into another bin that is at least as full
    for a, b in combinations(sorted(after, key=lambda x: sizes[x].sum()), 2):
        assert all(sizes[b].sum() + sizes[i] > 100 for i in a)
