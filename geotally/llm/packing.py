"""Sum-of-squares online packing of token ids into fixed-length sequences.

The level array counts the partially filled sequences of each fill level. A document goes, as it comes, to the level
where the sum of the squared counts becomes least. Each input partition is packed by itself while it is
tokenised, so nothing is shuffled; its sequences are complete when its last document has come.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from geotally.llm.common import ids_and_texts, with_ids

LENGTH = 2048
#: Id that ends each document.
END_ID = 1
#: Sequences a partition holds open at most (8 KB of ids each); beyond, all of them are completed.
MOST_OPEN = 4096
#: Sequence ids of partition k begin at k times this.
PER_PARTITION = 1 << 36


#: Fixed value: how byte-level BPE cuts a text into pieces.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of a piece beyond which texts are left to the slower library, whose time does not grow with the square.
LONG_PIECE = 1000
_LONG_BLANKS = re.compile(rf"\s{{{LONG_PIECE}}}")


def byte_ranks(path: str) -> dict[bytes, int]:
    """Ids by bytes out of a byte-level BPE file, whose tokens spell each byte as one printable character."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {t["content"] for t in model["added_tokens"]}
    return {bytes(byte_of[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}


class Encoder:
    """Ids of texts by the vocabulary of a tokenizer file; strings of special tokens are ordinary text.

    Two libraries give the same ids: one is three times as fast, the other takes pieces of any length.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.fast = tiktoken.Encoding("file", pat_str=PIECES, mergeable_ranks=byte_ranks(path), special_tokens={})

    def ids(self, text: str) -> list[int]:
        if len(text) > LONG_PIECE and (max(map(len, text.split()), default=0) > LONG_PIECE or _LONG_BLANKS.search(text)):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(path)


@dataclass
class Piece:
    """Ids of one document (its row number here) from ``start`` on."""

    row: int
    start: int
    ids: np.ndarray


@dataclass
class Packer:
    """Places pieces as they come; ``done`` takes finished sequences, each a list of pieces."""

    length: int = LENGTH
    most_open: int = MOST_OPEN
    done: list[list[Piece]] = field(default_factory=list)

    def __post_init__(self):
        self.levels = np.zeros(self.length + 1, np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(self.length)]
        self.n_open = 0

    def add(self, row: int, ids: np.ndarray) -> None:
        """A document: whole sequences are cut off its front, the rest goes to the best level."""
        whole = len(ids) - len(ids) % self.length
        for at in range(0, whole, self.length):
            self.done.append([Piece(row, at, ids[at : at + self.length])])
        if whole < len(ids):
            self.place(Piece(row, whole, ids[whole:]))

    def best_level(self, size: int) -> int:
        """The fill level, 0 for a new sequence, at which the piece makes the sum of squares least; the fullest of equals."""
        last = self.length - size
        grows = 2 * self.levels[size : size + last + 1] + 1
        grows[last] = 0  # a full sequence is no longer counted
        change = grows - np.maximum(2 * self.levels[: last + 1] - 1, 0)
        change[1:][self.levels[1 : last + 1] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def place(self, piece: Piece) -> None:
        level = self.best_level(len(piece.ids))
        held = self.open[level].pop() if level else []
        held.append(piece)
        if level:
            self.levels[level] -= 1
            self.n_open -= 1
        level += len(piece.ids)
        if level == self.length:
            self.done.append(held)
            return
        self.open[level].append(held)
        self.levels[level] += 1
        self.n_open += 1
        if self.n_open > self.most_open:
            self.complete()

    def complete(self) -> None:
        """Fill the fullest open sequences with what the emptiest hold; the last one is cut at powers of two."""
        left = [held for level in range(self.length) for held in self.open[level]]
        fills = [level for level in range(self.length) for _ in self.open[level]]
        self.__post_init__()
        i = len(left) - 1
        j = 0
        while j < i:
            gap = self.length - fills[i]
            if not gap:
                self.done.append(left[i])
                i -= 1
                continue
            piece = left[j].pop()
            if len(piece.ids) > gap:
                left[j].append(Piece(piece.row, piece.start + gap, piece.ids[gap:]))
                piece = Piece(piece.row, piece.start, piece.ids[:gap])
            left[i].append(piece)
            fills[i] += len(piece.ids)
            fills[j] -= len(piece.ids)
            if not fills[j]:
                j += 1
        if left and fills[i]:
            self._cut(left[i], fills[i])

    def _cut(self, held: list[Piece], fill: int) -> None:
        pieces = held[::-1]
        while fill:
            size = 1 << (fill.bit_length() - 1)
            fill -= size
            out = []
            while size:
                piece = pieces.pop()
                if len(piece.ids) > size:
                    pieces.append(Piece(piece.row, piece.start + size, piece.ids[size:]))
                    piece = Piece(piece.row, piece.start, piece.ids[:size])
                out.append(piece)
                size -= len(piece.ids)
            self.done.append(out)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, length, ids, doc_tokens, sequence_id, offset), one row per piece of a document.

    ``tokenizer`` is the path of a tokenizer file that every executor has. ids are little-endian unsigned 32-bit ids. A
    document is the ids of its text and the end id; null and empty texts are the end id alone. Every id lies in one piece.
    Sequences have ``length`` ids (a power of two), and at most one group of sequences at the end of a partition has
    smaller powers of two, so nothing is padded. Repeated rows are packed like others. Sequence ids are made of the partition's
    number, so read ``docs`` from a table: a task that is run again then packs the same rows in the same order.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer).ids
        packer = Packer(length)
        sequence = TaskContext.get().partitionId() * PER_PARTITION
        rows: dict[int, list] = {}  # of documents with ids not given out yet: id, all ids, ids left
        n = 0

        def finished() -> Iterator[pd.DataFrame]:
            nonlocal sequence
            done, packer.done = packer.done, []
            for at in range(0, len(done), 512):
                out = []
                for held in done[at : at + 512]:
                    offset = 0
                    for p in held:
                        row = rows[p.row]
                        out.append((row[0], p.start, len(p.ids), p.ids.tobytes(), row[1], sequence, offset))
                        offset += len(p.ids)
                        row[2] -= len(p.ids)
                        if not row[2]:
                            del rows[p.row]
                    sequence += 1
                yield pd.DataFrame(out, columns=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for b in batches:
            for doc_id, text in zip(b["id"], b["text"], strict=True):
                ids = np.array([*encode(text or ""), END_ID], "<u4")
                rows[n] = [doc_id, len(ids), len(ids)]
                packer.add(n, ids)
                n += 1
                if len(packer.done) >= 512:
                    yield from finished()
        packer.complete()
        yield from finished()

    packed = ids_and_texts(docs, id_col, text_col).mapInPandas(
        each, "id string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    return with_ids(packed, docs, id_col, id_col)
