"""Public tokenizers inside tasks, and their work on words that recur.

Texts are cut into parts where no token of the tokenizers can cross, so a part's tokens are the same wherever it
stands. A worker keeps what it knows of the parts it has met (``Known``), within a bound. Parts are told apart by
64-bit hashes and their lengths.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np

from martline.llm.hashing import mix, prefix_hash

#: Fixed value: how a byte-level BPE of this kind cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words encoded as one text on a miss.
TOGETHER = 256
SPACE = 0x20
#: Letters, digits and signs whose Unicode classes never changed.
_LATIN = re.compile(" ?[!-~¡-ɏ]+").fullmatch
_ASCII_WHITE = np.isin(np.arange(256), [*range(9, 14), *range(0x1C, 0x21)])
_loaded: dict[tuple, object] = {}


def white_follows(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For places ``at`` of ``buf`` (UTF-8, padded by three bytes): is the next character white space?"""
    a, b, c = (buf[at + k] for k in (1, 2, 3))
    general = (b == 0x80) & ((c >= 0x80) & (c <= 0x8A) | np.isin(c, [0xA8, 0xA9, 0xAF])) | (b == 0x81) & (c == 0x9F)
    return _ASCII_WHITE[a] | (a == 0xC2) & np.isin(b, [0x85, 0xA0]) | (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE2) & general | (a == 0xE3) & (b == 0x80) & (c == 0x80)


def cut_parts(buf: np.ndarray, offsets: np.ndarray, runs_whole: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of the parts of the texts buf[offsets[i]:offsets[i + 1]] in order.

    A part starts at each text's start and at every space that a character other than white space follows: a byte-level
    BPE takes that space into the next word. With ``runs_whole`` a space after a space starts no part, which a
    tokenizer needs that knows runs of spaces, but no token with a space inside or at its end.
    """
    padded = np.concatenate([buf, np.full(3, SPACE, np.uint8)])
    space = np.flatnonzero(buf == SPACE)
    good = ~white_follows(padded, space)
    if runs_whole:
        good &= (space == 0) | (buf[space - 1] != SPACE)
    last = np.zeros(len(buf) + 1, np.bool_)
    last[offsets[1:]] = True
    good &= ~last[space + 1]  # a space that ends its text
    begins = np.zeros(len(buf), np.bool_)
    begins[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    begins[space[good]] = True
    starts = np.flatnonzero(begins)
    return starts, np.append(starts[1:], len(buf)), np.searchsorted(offsets, starts, "right") - 1


def part_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums, down = prefix_hash(buf)
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places start[i], start[i] + 1, ... of every run in order."""
    before = np.cumsum(length) - length
    return np.arange(int(length.sum())) + np.repeat(start - before, length)


class Known:
    """Slots of the parts met so far by their hashes; ``learn(parts)`` is told of new ones, in the order of their slots."""

    def __init__(self, bound: int):
        self.bound, self.n = bound, 0
        self.hashes, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def full(self) -> bool:
        return self.n > self.bound

    def slots(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, learn) -> np.ndarray:
        """The slot of each part buf[start:end]."""
        distinct, example, which = np.unique(part_hashes(buf, start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        found = np.zeros(len(distinct), np.bool_)
        inside = at < len(self.hashes)
        found[inside] = self.hashes[at[inside]] == distinct[inside]
        new = np.flatnonzero(~found)
        if len(new):
            data = buf.tobytes()
            learn([data[a:b] for a, b in zip(start[example[new]].tolist(), end[example[new]].tolist())])
            self.hashes = np.insert(self.hashes, at[new], distinct[new])
            self.slot = np.insert(self.slot, at[new], self.n + np.arange(len(new)))
            self.n += len(new)
            at = np.searchsorted(self.hashes, distinct)
        return self.slot[at[which]]


class ByteBpe:
    """A byte-level BPE file of ``tokenizers``; strings of special tokens inside texts are plain text.

    Words of Latin letters, digits and signs are merged by ``tiktoken`` with the same file's vocabulary, which gives
    the same ids several times as fast (tested); everything else is encoded by ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte_of = byte_letters()
        special = self.tokenizer.get_added_tokens_decoder()
        names = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size())]
        self.token_bytes = [b"" if n is None or i in special else bytes(byte_of[c] for c in n) for i, n in enumerate(names)]
        self.spaced = np.array([t.startswith(b" ") for t in self.token_bytes])
        ranks = {t: i for i, t in enumerate(self.token_bytes) if t}
        self.words = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all parts in order, number of ids of each)."""
        texts = [p.decode("utf-8", "replace") for p in parts]
        plain = [_LATIN(t) is not None for t in texts]
        spaced = [i for i, ok in enumerate(plain) if ok and texts[i][0] == " "]
        ids, n = [np.zeros(0, np.uint32)], np.zeros(len(texts), np.int64)
        for at in range(0, len(spaced), TOGETHER):
            group = spaced[at : at + TOGETHER]
            ids.append(np.array(self.words.encode_ordinary("".join([texts[i] for i in group])), np.uint32))
            first = np.flatnonzero(self.spaced[ids[-1]])
            if len(first) != len(group):
                raise AssertionError("a token crosses the start of a word")
            n[group] = np.diff(first, append=len(ids[-1]))
        heads = [i for i, ok in enumerate(plain) if ok and texts[i][0] != " "]
        others = [i for i, ok in enumerate(plain) if not ok]
        rest = [self.words.encode_ordinary(texts[i]) for i in heads] + self.encode([texts[i] for i in others])
        n[heads + others] = list(map(len, rest))
        ids.append(np.fromiter(chain.from_iterable(rest), np.uint32, sum(map(len, rest))))
        order = np.array(spaced + heads + others, np.int64)
        start = np.empty_like(n)
        start[order] = np.cumsum(n[order]) - n[order]
        return np.concatenate(ids)[ragged(start, n)], n


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 bytes are written as
    themselves, the others as the letters from U+0100 on, in order."""
    own = [i for i in range(256) if 0x21 <= i <= 0x7E or 0xA1 <= i <= 0xAC or i >= 0xAE]
    other = [i for i in range(256) if i not in own]
    return {chr(i): i for i in own} | {chr(0x100 + k): i for k, i in enumerate(other)}


def byte_bpe(path: str) -> ByteBpe:
    """The tokenizer stored at ``path``, loaded once a Python worker."""
    if ("bytes", path) not in _loaded:
        _loaded["bytes", path] = ByteBpe(path)
    return _loaded["bytes", path]
