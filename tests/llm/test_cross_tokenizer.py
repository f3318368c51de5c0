"""Cross-tokenizer alignment against a plain version that encodes whole texts."""

import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from martline.llm import cross_tokenizer
from martline.llm.subwords import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["  a  b", "\n\n x \n y", "a  b 　 c  ", " ", "<|endoftext|> <s> </s>", "tab\t x\t\ty", "é\n\nè  \n", "don't we'll", "x" * 3000, " " * 70 + "z", "日本 語  ok", "¿ ¿que” “foo – bar", "a ▁ b", "▁", "z  a", "nul \x00 byte", "👩‍👩‍👧 ok 𝔘", "ﬁ ㌀ Å"]


@pytest.fixture(scope="module")
def tools():
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = byte_letters()
    bytes_a = lambda i: bytes(letters[c] for c in a.id_to_token(i))
    hexed = re.compile("<0x(..)>").fullmatch

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(hexed(piece)[1], 16)]) if hexed(piece) else piece.replace("▁", " ").encode()

    return a, bytes_a, b, bytes_b


def aligned(text, tools):
    """(A ids, B ids, groups as text, links) of one text, or None."""
    a, bytes_a, b, bytes_b = tools
    whole = (" " + (text or "")).encode()
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    if b"".join(map(bytes_a, ids_a)) != whole or b"".join(map(bytes_b, ids_b)) != whole:
        return None
    spans = []
    for ids, of in ((ids_a, bytes_a), (ids_b, bytes_b)):
        at, own = 0, []
        for i in ids:
            own.append((at, at := at + len(of(i)), i))
        spans.append(own)
    common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
    groups, start = [], 0
    for end in common:
        groups.append("|".join(",".join(str(i) for s, e, i in own if start <= s and e <= end) for own in spans))
        start = end
    links, j = [], 0
    for s, e, i in spans[0]:
        while spans[1][j][1] <= s:
            j += 1
        k = j
        while k < len(spans[1]) and spans[1][k][0] < e:
            links.append((i, spans[1][k][2]))
            k += 1
    return ids_a, ids_b, groups, links


def plain(docs, tools):
    of = {t: aligned(t, tools) for t in {t for _, t in docs}}
    count = Counter(pair for _, t in docs if of[t] for pair in set(of[t][3]))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for d, t in docs:
        if of[t] is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        ids_a, ids_b, groups, links = of[t]
        good = sum(count[p] == best[p[0]] for p in links)
        out.append((d, len(ids_a), len(ids_b), len(groups), len(links), good, sum(count[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_whole_table(spark, tools):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert rows(cross_tokenizer.cross_tokenizer(docs, A, B)) == plain([tuple(r) for r in docs.collect()], tools)


@pytest.mark.parametrize("block,part_bytes,known", [(200, 64, 10), (8 << 20, 32 << 20, 400_000)])
def test_defined_cases(spark, tools, monkeypatch, block, part_bytes, known):
    for name, value in (("BLOCK", block), ("PART_BYTES", part_bytes), ("KNOWN_PARTS", known)):
        monkeypatch.setattr(cross_tokenizer, name, value)
    texts = [None, "", "the same words", "the same words", "the other words here", *ODD]
    docs = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(2, "the same words", "clash", 1), (None, "no id", None, None), (None, None, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, digest string, copies int").repartition(3)
    assert rows(cross_tokenizer.cross_tokenizer(df, A, B)) == plain([r[:2] for r in docs], tools)
    assert cross_tokenizer.cross_tokenizer(df.limit(0), A, B).count() == 0
