"""Token ids of whole texts by the tokenizers library, with a memo of parts that recur.

A byte-level BPE vocabulary with the usual split pattern never merges across a space that stands between two other
characters: a token may begin with such a space but not span it. So a text is cut before every single space, each
distinct part is encoded once by the library, and the ids of the parts are put together again. Texts where white
space touches white space, or stands at an end, are cut only at the spaces for which this holds.

The split pattern also ends a word at a stop (.,;:!?) behind an ASCII letter, so a part is cut there too: a word before a stop
is not a part of its own.

Parts are found on the UTF-8 bytes of all texts that are encoded together and counted there once each, so that only the
distinct ones become Python objects and are looked up in the memo.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

#: Parts kept by a worker before it starts afresh: bounds the memo's memory (about 250 MB).
MEMO_PARTS = 1_000_000
#: New parts that are encoded as one text.
JOINED_PARTS = 256
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
LETTERS, STOPS = np.zeros(256, bool), np.zeros(256, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
STOPS[[*b".,;:!?"]] = True


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Memo(dict):
    """Numbers of parts, by their UTF-8 bytes; a new part gets the next number and waits to be encoded."""

    def __init__(self):
        super().__init__()
        self.waiting: list[str] = []

    def __missing__(self, key):
        self[key] = number = len(self)
        self.waiting.append(key.decode())
        return number


def is_uneven(part: str) -> bool:
    """Whether white space may touch white space where this part was cut off."""
    return part[-1:].isspace() or part[:1] != " " and not part[:1].strip() or part[:1] == " " and part[1:2].isspace()


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, … for each start, as many as its length says."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class Encoder:
    """encode(texts) gives the ids of every text, equal to those of the library's own encode."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if len(feed) == 1 else -1
        self.reset()

    def reset(self) -> None:
        self.memo = Memo()
        self.uneven = np.empty(0, bool)
        self.flat = np.empty(1 << 16, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def learn(self) -> None:
        """Encode the parts that wait."""
        parts, self.memo.waiting = self.memo.waiting, []
        if not parts:
            return
        uneven = np.fromiter(map(is_uneven, parts), bool, len(parts))
        joinable = [not odd and "\n" not in part and "<|" not in part for part, odd in zip(parts, uneven.tolist())]
        ids, lengths = self.joined([part for part, good in zip(parts, joinable) if good])
        if not all(joinable):  # put the others in their places
            joinable = np.array(joinable)
            others, other_lengths = self.one_by_one([part for part, good in zip(parts, joinable) if not good])
            both, of_part = np.concatenate([ids, others]), np.empty(len(parts), np.int64)
            of_part[joinable], of_part[~joinable] = lengths, other_lengths
            where = np.empty(len(parts), np.int64)
            where[joinable], where[~joinable] = np.cumsum(lengths) - lengths, len(ids) + np.cumsum(other_lengths) - other_lengths
            ids, lengths = both[expand(where, of_part)], of_part
        ends = self.ends[-1] + np.cumsum(lengths)
        if ends[-1] > len(self.flat):
            self.flat = np.resize(self.flat, max(int(ends[-1]), 2 * len(self.flat)))
        self.flat[self.ends[-1] : ends[-1]] = ids
        self.ends = np.concatenate([self.ends, ends])
        self.uneven = np.concatenate([self.uneven, uneven])

    def one_by_one(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts behind each other, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    def joined(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts without line feeds, white space at an end or special tokens: many to a text, a line feed between
        two. It is a token of its own there; a text in which it is not goes part by part."""
        blocks = [parts[at : at + JOINED_PARTS] for at in range(0, len(parts), JOINED_PARTS)]
        ids, lengths = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        encoded = self.tokenizer.encode_batch_fast(["\n".join(block) for block in blocks], add_special_tokens=False)
        for block, found in zip(blocks, encoded):
            row = np.array(found.ids, np.uint32)
            feeds = np.flatnonzero(row == self.feed)
            if len(feeds) == len(block) - 1:
                ids.append(np.delete(row, feeds))
                lengths.append(np.diff(np.concatenate([[-1], feeds, [len(row)]])) - 1)
            else:
                for values, kept in zip(self.one_by_one(block), (ids, lengths)):
                    kept.append(values)
        return np.concatenate(ids), np.concatenate(lengths)

    def numbers(self, parts: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.memo.__getitem__, parts), np.int64, len(parts))

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the parts of all texts cut before every space and stop, and where each text starts in them (one more at the end)."""
        column = pa.array(texts, pa.large_string())
        ends = np.frombuffer(column.buffers()[1], np.int64)[: len(texts) + 1]
        body = column.buffers()[2] or pa.py_buffer(b"")
        data = np.frombuffer(body, np.uint8)[: ends[-1]]
        cut = data == 0x20
        cut[1:] |= STOPS[data[1:]] & LETTERS[data[:-1]]
        cuts = np.flatnonzero(cut)
        # a text's first part begins where it does and is empty if a cut stands there
        borders = np.sort(np.concatenate([ends, cuts]), kind="stable")
        buffers = [None, pa.py_buffer(borders), body]
        parts = pa.Array.from_buffers(pa.large_binary(), len(borders) - 1, buffers).dictionary_encode()
        starts = np.arange(len(ends)) + np.searchsorted(cuts, ends)
        return self.numbers(parts.dictionary.to_pylist())[parts.indices.to_numpy(zero_copy_only=False)], starts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.memo) > MEMO_PARTS:
            self.reset()
        codes, starts = self.codes(texts)
        self.learn()
        ids, lengths = self.gather(codes)
        ends = np.concatenate([[0], np.cumsum(lengths)])[starts]
        found = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        owners = np.searchsorted(starts, np.flatnonzero(self.uneven[codes]), side="right") - 1
        recut = {}
        for k in np.unique(owners).tolist():  # white space meets white space: cut at fewer places
            first, *others = SAFE_CUT.split(texts[k])
            recut[k] = self.numbers([first.encode(), *[f" {part}".encode() for part in others]])
        self.learn()
        for k, numbers in recut.items():
            found[k] = self.gather(numbers)[0]
        return found

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts behind each other, and how many each has."""
        starts = self.ends[codes]
        lengths = self.ends[codes + 1] - starts
        return self.flat[expand(starts, lengths)], lengths


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """This worker's encoder: loaded once, its memo lives as long as the worker."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def slices(texts: list[str | None], characters: int = 2_000_000):
    """Ranges of rows that hold about so many characters, so that a task's memory follows its longest text only."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= characters:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)
