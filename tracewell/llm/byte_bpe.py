"""Byte-level BPE by merge replay: all new words of a block of documents go through the merges together.

Words stand side by side in flat arrays of tokens, linked to their neighbours. An inverted index leads from
every token pair that a merge joins, under the rank of what it gives, to the positions where it stands.
Ranks are taken in order from a heap; a rank is applied at all its positions at once, from left to right,
and only the pairs on both sides of a merge are looked up again. A word never sees another, so what each
becomes is what it would become alone.

A block is a bounded number of characters of a partition, not the whole corpus: words joined back to their
documents would move every word of the corpus. What a word became is remembered for later blocks (two
generations of a bounded number of words), so frequent words are replayed once per worker.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame

from .common import doc_texts, map_rows
from .tokens import Remembered, vocabulary_path

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters whose words are replayed together, and beyond which a text is encoded in parts.
BLOCK = 1 << 20
#: Unicode white space, as the vocabulary's pattern means it.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Where the pattern always cuts: in front of white space, but for one space before other characters.
CHUNKS = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
#: A space between other characters begins a word.
CUT = re.compile(f"(?<=[^{SPACES}]) (?=[^{SPACES}])")

#: Below this, what is a letter has not changed for many versions of Unicode.
OLD = "\u0530"
LETTERS_END = (".", ",")


class Ranks:
    """The vocabulary of a rank file: each token's rank is its id, and the order in which merges are applied."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.tokens = {i: token for token, i in self.ids.items()}
        self.size = max(self.tokens, default=0) + 1
        self.letters = [self.ids[bytes([b])] for b in range(256)]
        # Every way to put two tokens together to one, not only the way it was learned.
        self.merges = {}
        for token, i in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    self.merges[left * self.size + right] = i
        self.of_bytes = np.array([[self.ids.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)], np.int32)

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word; of none, for an empty one."""
        ids, merges, size = self.ids, self.merges, self.size
        found = [[ids[w]] if w in ids else None for w in words]
        parted = [w for w, whole in zip(words, found, strict=True) if whole is None]
        data = np.frombuffer(b"".join(parted), np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in parted], dtype=np.int64)])
        last = bounds[1:][np.diff(bounds) > 0] - 1

        # Of each position: its token, its neighbours, and the rank of what it and the next one make.
        before, after = np.arange(-1, len(data) - 1), np.arange(1, len(data) + 1)
        after[last] = -1
        before[(last + 1)[:-1]] = -1
        pair = np.full(len(data), -1, np.int32)
        pair[:-1] = self.of_bytes[data[:-1], data[1:]]
        pair[last] = -1
        pairs = np.flatnonzero(pair >= 0)
        order = pairs[np.argsort(pair[pairs], kind="stable")]
        ranks, starts = np.unique(pair[order], return_index=True)
        index = dict(zip(ranks.tolist(), (p.tolist() for p in np.split(order, starts[1:])), strict=False)) if len(ranks) else {}
        tokens = np.array(self.letters, np.int64)[data].tolist()
        before, after, pair, joins = before.tolist(), after.tolist(), pair.tolist(), merges.get
        waiting = list(index)
        heapq.heapify(waiting)
        while waiting:
            rank = heapq.heappop(waiting)
            positions = index.pop(rank)
            positions.sort()
            for done, at in enumerate(positions, 1):
                if pair[at] != rank:
                    continue  # merged away meanwhile
                follower, left = after[at], before[at]
                right = after[at] = after[follower]
                tokens[at], tokens[follower], pair[follower] = rank, -1, -1
                lowest = rank
                new = None
                if right >= 0:
                    before[right] = at
                    new = joins(rank * size + tokens[right])
                if new is None:
                    pair[at] = -1
                else:
                    pair[at] = new
                    if (others := index.get(new)) is None:
                        index[new] = [at]
                        heapq.heappush(waiting, new)
                    else:
                        others.append(at)
                    lowest = new if new < lowest else lowest
                if left >= 0:
                    new = joins(tokens[left] * size + rank)
                    if new is None:
                        pair[left] = -1
                    else:
                        pair[left] = new
                        if (others := index.get(new)) is None:
                            index[new] = [left]
                            heapq.heappush(waiting, new)
                        else:
                            others.append(left)
                        lowest = new if new < lowest else lowest
                if lowest < rank:  # a pair of lower rank has come up and goes first
                    index[rank] = positions[done:]
                    heapq.heappush(waiting, rank)
                    break
        ends = pairwise(bounds.tolist())
        return [whole if whole is not None else [t for t in tokens[slice(*next(ends))] if t >= 0] for whole in found]


class Coder(Remembered):
    """From a word, or several that white space does not part, to its decimal ids joined by commas and the bytes they decode to."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        super().__init__()
        self.ranks = Ranks(path)
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall

    def cut(self, chunk: str) -> list[str]:
        """The pattern's matches in a chunk; letters of old alphabets, also before a full stop or comma, need no search."""
        letters = chunk[1:] if chunk[0] == " " else chunk
        if letters[-1:] in LETTERS_END and letters[:-1].isalpha() and max(letters) < OLD:
            return [chunk[:-1], chunk[-1]]
        return [chunk] if letters.isalpha() and max(letters) < OLD else self.pieces(chunk)

    def learn(self, chunks: Iterable[str]) -> None:
        """Replay what is not known yet, all of it together."""
        new = {c: self.cut(c) for c in set(chunks) if c not in self and c not in self.older}
        words = list({w: None for pieces in new.values() for w in pieces if w not in self and w not in self.older})
        tokens = self.ranks.tokens
        for word, ids in zip(words, self.ranks.replay([w.encode() for w in words]), strict=True):
            self[word] = ",".join(map(str, ids)), b"".join(map(tokens.__getitem__, ids))
        for chunk, pieces in new.items():
            if len(pieces) != 1:
                parts = [self[p] for p in pieces]
                self[chunk] = ",".join([p[0] for p in parts]), b"".join([p[1] for p in parts])

    def known(self, chunks: list[str]) -> tuple[str, bytes]:
        parts = list(map(self.__getitem__, chunks))
        return ",".join([p[0] for p in parts]), b"".join([p[1] for p in parts])

    def block(self, texts: list[str]) -> list[tuple[str, bytes]]:
        """Ids and decoded bytes of each text."""
        self.age()
        cut = [CHUNKS.findall(t) for t in texts]
        self.learn(c for chunks in cut for c in chunks)
        return [self.known(chunks) for chunks in cut]


def parts(text: str, size: int) -> Iterator[str]:
    """A text in parts of about `size` characters, cut where a word begins in any case."""
    begin = 0
    while len(text) - begin > size:
        cut = CUT.search(text, begin + size)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


@lru_cache(1)
def coder(path: str) -> Coder:
    return Coder(path)


def blocks(rows: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    """Rows (key, text) in lists of about `size` characters; a longer text is in several, as (key, part, whether it goes on)."""
    held, chars = [], 0
    for key, text in rows:
        pieces = list(parts(text or "", size))
        for n, piece in enumerate(pieces, 1):
            held.append((key, piece, n < len(pieces)))
            chars += len(piece) + 64
            if chars >= size:
                yield held
                held, chars = [], 0
    if held:
        yield held


def encoded(docs: DataFrame, path: str | None = None, block: int = BLOCK) -> DataFrame:
    """Each document's doc_id, ids and the bytes they decode to, a row for each of its parts (`part`, from 0; one unless it is very long).

    A null or empty text has one part without ids. Rows that repeat a doc_id, or have none, are documents
    of their own, each with parts from 0. Other columns are ignored. Nothing is shuffled.
    """
    path = path or vocabulary_path(RANKS)

    def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        part = 0
        for held in blocks(rows, block):
            for (doc_id, _, more), (ids, back) in zip(held, coder(path).block([h[1] for h in held]), strict=True):
                yield doc_id, part, [int(i) for i in ids.split(",")] if ids else [], back
                part = part + 1 if more else 0

    return map_rows(doc_texts(docs), rows, "doc_id long, part int, ids array<int>, decoded binary", 64)


def decoded(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the bytes that each row's ids (an array of integers) stand for; of null, none."""
    path = path or vocabulary_path(RANKS)

    def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        known = coder(path).ranks.tokens
        for doc_id, ids in rows:
            yield doc_id, b"".join([known[i] for i in ids or []])

    return map_rows(tokens.selectExpr("cast(doc_id as long) doc_id", "cast(ids as array<int>) ids"), rows, "doc_id long, decoded binary", 256)


def digest(docs: DataFrame, path: str | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the decimal ids joined by commas and of the decoded bytes, for each row of docs."""
    path = path or vocabulary_path(RANKS)

    def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        n, written, back = 0, hashlib.sha256(), hashlib.sha256()
        for held in blocks(rows, block):
            for (doc_id, _, more), (ids, bytes_) in zip(held, coder(path).block([h[1] for h in held]), strict=True):
                if ids:
                    written.update((f",{ids}" if n else ids).encode())
                    n += ids.count(",") + 1
                back.update(bytes_)
                if not more:
                    yield doc_id, n, written.hexdigest(), back.hexdigest()
                    n, written, back = 0, hashlib.sha256(), hashlib.sha256()

    return map_rows(doc_texts(docs), rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
