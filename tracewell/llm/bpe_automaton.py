"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens. It starts as one state with an arc to itself for every base symbol and takes
in the merges in order of rank, each by a merge gadget: for (u, v) -> uv, wherever an arc u leads to a
state that has an arc v, the arc u is led to a copy of that state without the arc v, and an arc uv is added
that leads where u, v led. What it accepts in the end are the outputs of BPE, one for each word, so the
path that spells a word, or a beginning of one, is unique. It is found from left to right, longest arcs
first; a place from which no arc leads on is given up once for all.

All arcs of one label lead to one state, so a state is named by the arc into it and the rank of the last
gadget that counts, and a copy differs from its original by the one arc its gadget took away. The gadgets
are kept in two tables (arcs made, arcs taken); the arcs that walks ask for are worked out from them and
filled into a transition table.

Words are cut before the automaton reads them: plain ones here, and those with other than ASCII characters
by the library's own normaliser and pre-tokenizer, whose tables of letters are those of its version.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame

from .common import doc_texts, map_rows
from .tokens import Remembered, byte_letters, plain, split_at_spaces, vocabulary_path

#: Unicode white space, as the vocabulary's patterns mean it.
SPACES = "\t\n\v\f\r \x85\xa0  -     　"
#: How the vocabulary cuts text into words; fixed by the vocabulary file.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + SPACES + r"\p{L}\p{N}]+"


class Automaton:
    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        self.labels = {i: s for s, i in vocabulary.items()}
        self.many = max(self.labels, default=0) + 1
        self.made: dict[int, tuple[int, int, int]] = {}  # arc uv -> u, v, rank of its gadget
        self.taken: dict[int, int] = {}  # (u, v), packed -> rank of the gadget that took v from the state behind u
        self.table: dict[int, bool] = {}  # (arc, next arc), packed
        merged = {u + v for u, v in merges}
        self.arcs = {s: i for s, i in vocabulary.items() if s not in merged}
        for rank, (u, v) in enumerate(merges, 1):
            self.add_gadget(rank, u, v, vocabulary[u + v])
        self.last_rank = len(merges)
        self.longest = max(map(len, self.arcs), default=0)

    def add_gadget(self, rank: int, left: str, right: str, uv: int) -> None:
        u, v = self.arcs.get(left), self.arcs.get(right)
        if u is not None and v is not None and self.has_arc(u, rank - 1, v):  # else an earlier merge always parts u from v
            self.made[uv] = (u, v, rank)
            self.taken[u * self.many + v] = rank
            self.arcs[left + right] = uv

    def has_arc(self, at: int, until: int, label: int) -> bool:
        """Whether the state behind the arc `at` has the arc `label`, counting gadgets up to rank `until`.

        The state behind uv began as the one behind v was before that gadget, so originals are followed to
        the right; an arc uv came to the states that had an arc u then, so labels are followed to the left.
        """
        while True:
            u, _, made = self.made.get(label, (-1, -1, 0))
            while True:
                _, original, born = self.made.get(at, (-1, -1, 0))
                if born < self.taken.get(at * self.many + label, 0) <= until:
                    return False
                if original < 0 or born <= made:
                    break
                at, until = original, born - 1
            if u < 0:
                return True
            label, until = u, min(until, made)

    def encode(self, symbols: list[str]) -> list[int]:
        """Labels of the path that spells the symbols."""
        if (whole := self.arcs.get("".join(symbols))) is not None:
            return [whole]
        word, ends = "".join(symbols), [0]
        for s in symbols:
            ends.append(ends[-1] + len(s))
        arcs, table, longest, many, n = self.arcs, self.table, self.longest, self.many, len(symbols)
        path: list[int] = []
        begins, dead, i = [0], set(), 0
        while i < n:
            begin = ends[i]
            for j in range(n if n - i < longest else i + longest, i, -1):
                label = arcs.get(word[begin : ends[j]])
                if label is None or j in dead:
                    continue
                if path:
                    arc = path[-1] * many + label
                    if (allowed := table.get(arc)) is None:
                        allowed = table[arc] = self.has_arc(path[-1], self.last_rank, label)
                    if not allowed:
                        continue
                path.append(label)
                begins.append(j)
                i = j
                break
            else:  # a beginning has one path only, so no other leads on from here
                if not path:
                    raise ValueError(f"{word!r} has a symbol outside the vocabulary")
                dead.add(i)
                path.pop()
                begins.pop()
                i = begins[-1]
        return path


class Coder:
    """Words of whole texts through the automaton; each distinct word goes through it once per worker."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        library = Tokenizer.from_file(path)
        self.normal, self.pre_tokenized = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.automaton = Automaton(model["vocab"], [tuple(m) for m in model["merges"]])
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.labels = self.automaton.labels | {i: s for s, i in self.special.items()}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.find_words, self.spaces = regex.compile(WORD).findall, regex.compile(f"[{SPACES}]+")
        self.letters = dict(enumerate(byte_letters()))
        self.paths = Paths(self)
        self.known = Words(self)

    def cut(self, text: str) -> list[str]:
        """Words of a text without special tokens, spelled in the vocabulary's letters for bytes."""
        if text.isascii():
            return [self.spelled(w) for w in self.find_words(text.lower())]
        return [w for w, _ in self.pre_tokenized(self.normal(text))]

    def spelled(self, word: str) -> str:
        return word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.letters)

    def word(self, word: str) -> tuple[str, str, int]:
        """Decimal ids and labels, each joined by spaces, and their number."""
        ids: list[int] = []
        if word.isalpha() and plain(word):
            ids += self.paths[self.spelled(word.lower())]
        else:
            for k, part in enumerate(self.at_special.split(word) if self.at_special else [word]):
                if k % 2:
                    ids.append(self.special[part])
                else:
                    for piece in self.cut(part):
                        ids += self.paths[piece]
        return " ".join(map(str, ids)), " ".join(map(self.labels.__getitem__, ids)), len(ids)

    def encode(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, decimal ids joined by spaces, and what they decode to."""
        if not text:
            return 0, "", ""
        self.known.age()
        self.paths.age()
        words = split_at_spaces(text)
        found = list(map(self.known.__getitem__, self.spaces.split(text) if words is None else words))
        if not all(found):  # words without ids
            found = [f for f in found if f]
        return sum([f[2] for f in found]), " ".join([f[0] for f in found]), " ".join([f[1] for f in found])


class Paths(Remembered):
    """The automaton's path for a word in the vocabulary's letters."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder = coder

    def compute(self, piece: str) -> list[int]:
        symbols = list(piece)
        symbols[-1] += self.coder.end
        return self.coder.automaton.encode(symbols)


class Words(Remembered):
    """What Coder.word says of a word, or () of one without ids; a full stop or comma behind letters is a word of its own."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder = coder

    def compute(self, word: str) -> tuple:
        if len(word) > 1 and word[-1] in ".," and word[:-1].isalpha() and plain(word):
            (a, b, n), (c, d, m) = self[word[:-1]], self[word[-1]]
            return a + " " + c, b + " " + d, n + m
        known = self.coder.word(word)
        return known if known[2] else ()


@lru_cache(1)
def coder(path: str) -> Coder:
    return Coder(path)


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Each document's doc_id, n_tokens, ids (decimal, joined by spaces) and decoded text.

    A map over the documents, without a shuffle: a word takes the automaton's time once per worker, so
    copies and frequent words cost a look-up. A null or empty text has no ids and decodes to an empty
    text. Rows that repeat a doc_id, or have none, are documents of their own. Other columns are ignored.
    """
    path = path or vocabulary_path()

    def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        c = coder(path)
        for doc_id, text in rows:
            yield doc_id, *c.encode(text)

    return map_rows(doc_texts(docs), rows, "doc_id long, n_tokens long, ids string, decoded string", 256)


def decoded(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows (doc_id, ids: array of integers): the labels of the path's arcs, joined by spaces."""
    path = path or vocabulary_path()

    def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        labels = coder(path).labels
        for doc_id, ids in rows:
            yield doc_id, " ".join(labels[i] for i in ids or [])

    return map_rows(tokens.selectExpr("cast(doc_id as long) doc_id", "cast(ids as array<int>) ids"), rows, "doc_id long, text string", 256)


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The same, with ids and decoded text only as SHA-256."""
    path = path or vocabulary_path()

    def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        c = coder(path)
        for doc_id, text in rows:
            n, ids, back = c.encode(text)
            yield doc_id, n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    return map_rows(doc_texts(docs), rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
