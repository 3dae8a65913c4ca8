"""Packing, the tokenization automaton, merge replay and token files, against the tokenizers and tiktoken libraries."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tracewell.llm import bpe_automaton, byte_bpe, packing, token_files
from tracewell.llm.common import new_path
from tracewell.llm.tokens import vocabulary_path, word_ids


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def random_texts(n, seed=5):
    r = random.Random(seed)
    letters = "aAbB 's'tΣσςİiJ̌éé́ǰ\x1c\x1d\x85\xa0 　,.!<|>endoftextÀß漢字한글0१²ªŉ​\t\n\r\x00\x0bthe ing"
    for _ in range(n):
        text = "".join(r.choice(letters) for _ in range(r.randrange(30)))
        yield text + r.choice(["", "", "<|endoftext|>", "x<|startoftext|> y", "<|ENDOFTEXT|>"])


def test_words_and_automaton_give_the_librarys_ids(tokenizer):
    words, coder = word_ids(vocabulary_path()), bpe_automaton.coder(vocabulary_path())
    for text in random_texts(4000):
        ids = ids_of(tokenizer, text)
        assert np.frombuffer(words.encode(text), "<u4").tolist() == ids, text
        n, written, decoded = coder.encode(text)
        assert (n, written) == (len(ids), " ".join(map(str, ids))), text
        assert decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_every_character_is_cut_as_the_library_does(tokenizer):
    words, coder = word_ids(vocabulary_path()), bpe_automaton.coder(vocabulary_path())
    for begin in range(0, 0x32000, 1 << 14):
        texts = [f"a{chr(x)}b {chr(x)} 1{chr(x)}C{chr(x)}{chr(x)}." for x in range(begin, begin + (1 << 14)) if not 0xD800 <= x < 0xE000]
        for text, found in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            assert coder.encode(text)[1] == " ".join(map(str, found.ids)), text
            assert np.frombuffer(words.encode(text), "<u4").tolist() == found.ids, text


def test_automaton_of_a_small_vocabulary_accepts_what_merging_gives():
    merges = [("a", "b"), ("b", "a"), ("ab", "a"), ("a", "a"), ("aa", "b"), ("ba", "ba")]
    symbols = ["a", "b", *(u + v for u, v in merges)]
    automaton = bpe_automaton.Automaton({s: i for i, s in enumerate(symbols)}, merges)

    def merged(word):
        parts = list(word)
        for u, v in merges:
            out, i = [], 0
            while i < len(parts):
                step = 2 if parts[i : i + 2] == [u, v] else 1
                out.append("".join(parts[i : i + step]))
                i += step
            parts = out
        return parts

    for n in range(1, 11):
        for bits in range(1 << n):
            word = "".join("ab"[bits >> k & 1] for k in range(n))
            assert [symbols[i] for i in automaton.encode(list(word))] == merged(word), word


def test_digests_of_whole_table(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = dict(docs.select("doc_id", "text").collect())
    for r in bpe_automaton.digest(docs).collect():
        ids = ids_of(tokenizer, text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_decoding_ids(spark, tokenizer):
    ids = ids_of(tokenizer, "the quick brown fox")
    got = bpe_automaton.decoded(spark.createDataFrame([(1, ids), (2, []), (3, None)], "doc_id long, ids array<int>")).collect()
    assert [r.text for r in sorted(got)] == [tokenizer.decode(ids, skip_special_tokens=False), "", ""]


@pytest.mark.parametrize("edge", [False, True])
def test_packing(spark, sf_dir, edge_docs, tokenizer, edge):
    docs = edge_docs if edge else spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pieces(docs).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert all(r.length == 1 << r.bucket <= 4096 and r.offset == 0 and r.sequence_id >> 58 == r.bucket for r in rows)
    want = sorted(((r.doc_id is None, r.doc_id or 0), ids_of(tokenizer, r.text) + [2]) for r in docs.collect())
    streams, current = [], []
    for r in rows:  # a document's pieces are in order
        if r.start == 0:
            current = []
        assert r.start == len(current)
        current += np.frombuffer(r.ids, "<u4").tolist()
        if len(current) == r.doc_tokens:
            streams.append(((r.doc_id is None, r.doc_id or 0), current))
    assert sorted(streams) == want


def test_packing_digest_and_buckets(spark, edge_docs, empty_docs, tmp_path):
    packed = packing.pieces(edge_docs)
    for full, short in zip(packed.collect(), packing.digest(packed).collect(), strict=True):
        assert short.ids_crc32 == zlib.crc32(full.ids)
    packing.write_buckets(packed, str(tmp_path / "buckets"))
    back = spark.read.parquet(str(tmp_path / "buckets"))
    assert back.count() == packed.count() and back.filter("length != shiftleft(1, bucket)").count() == 0
    assert packing.pieces(empty_docs).count() == 0


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_chunks_round_trip(planes):
    r = np.random.default_rng(1)
    for ids in (np.zeros(9, np.uint32), r.integers(0, 50_000, 1001, dtype=np.uint32), r.integers(0, 2**32, 77, dtype=np.uint32), np.array([7], np.uint32)):
        assert (token_files.unpack_chunk(token_files.pack_chunk(ids, planes)) == ids).all()


@pytest.mark.parametrize("planes,block", [("byte", 65_536), ("bit", 64), ("byte", 1)])
def test_token_files(spark, edge_docs, tokenizer, planes, block):
    docs = edge_docs.filter("n_chars < 3000") if block == 1 else edge_docs
    folder = new_path(spark, "test-files")
    token_files.write_token_files(docs, folder, planes=planes, block_ids=block)
    got = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    ids = [np.frombuffer(r.ids, "<u4").tolist() for r in got]
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys)
    at = 0
    for r, i in zip(got, ids, strict=True):
        assert (r.start, r.n_tokens) == (at, len(i))
        at += len(i)
    want = defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append(ids_of(tokenizer, r.text) + [1])
    have = defaultdict(list)
    for r, i in zip(got, ids, strict=True):
        have[r.doc_id].append(i)
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}


def test_token_files_digest_and_empty_table(spark, sf_dir, empty_docs, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_path(spark, "test-files")
    token_files.write_token_files(docs, folder)
    got = token_files.digest(token_files.read_token_files(spark, folder)).toPandas().sort_values("doc_id", ignore_index=True)
    texts = docs.select("doc_id", "text").toPandas().sort_values("doc_id", ignore_index=True)
    ids = [ids_of(tokenizer, t) + [1] for t in texts.text]
    sizes = pd.Series([len(i) for i in ids])
    assert got.doc_id.tolist() == texts.doc_id.tolist()
    assert got.n_tokens.tolist() == sizes.tolist() and got.start.tolist() == (sizes.cumsum() - sizes).tolist()
    assert got.ids_crc32.tolist() == [crc(i) for i in ids]
    folder = new_path(spark, "test-files")
    token_files.write_token_files(empty_docs, folder)
    assert token_files.read_token_files(spark, folder).count() == 0


@pytest.fixture(scope="module")
def library():
    with open(vocabulary_path(byte_bpe.RANKS), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def replayed(texts):
    return [([int(i) for i in ids.split(",")] if ids else [], back) for ids, back in byte_bpe.coder(vocabulary_path(byte_bpe.RANKS)).block(texts)]


def test_replay_gives_the_librarys_ids(library):
    r = random.Random(3)
    letters = "aAbB 's'tn'll  \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　​éß漢字한글0١²ªŉ\U0001f600‍the ing and  0123.,!?()"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(5000)]
    texts += ["", "a" * 5000, "ab" * 3000, " " * 900, "\n" * 77, "the" * 500, "".join(r.choice("abcde") for _ in range(20_000)), "<|endoftext|>"]
    for text, (ids, back) in zip(texts, replayed(texts), strict=True):
        assert ids == library.encode_ordinary(text) and back == text.encode(), text


def test_replay_cuts_every_character_as_the_library_does(library):
    for begin in range(0, 0x32000, 1 << 14):
        texts = [f"a{chr(x)}b {chr(x)}1{chr(x)} {chr(x)}{chr(x)}" for x in range(begin, begin + (1 << 14)) if not 0xD800 <= x < 0xE000]
        assert [ids for ids, _ in replayed(texts)] == library.encode_ordinary_batch(texts, num_threads=4)


def test_replay_of_merges_that_go_back_in_rank(tmp_path):
    """A merge can make a pair of lower rank; then that one goes first in its word."""
    r = random.Random(7)
    for _ in range(150):
        tokens = {bytes([b]) for b in range(256)}
        extra = {bytes(r.choice(b"abc") for _ in range(r.randrange(2, 6))) for _ in range(r.randrange(1, 25))}
        ranked = [*sorted(tokens), *r.sample(sorted(extra), len(extra))]
        file = tmp_path / "ranks"
        file.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(ranked)))
        own = byte_bpe.Ranks(str(file))
        theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(ranked)}, special_tokens={})
        words = ["".join(r.choice("abc") for _ in range(r.randrange(1, 40))) for _ in range(30)]
        assert own.replay([w.encode() for w in words]) == [theirs.encode_ordinary(w) for w in words]


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_byte_bpe_of_tables(spark, sf_dir, edge_docs, empty_docs, library, block):
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), edge_docs):
        want = []
        for r in docs.select("doc_id", "text").collect():
            ids = library.encode_ordinary(r.text or "")
            want.append((r.doc_id or 0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
        got = [(r.doc_id or 0, *tuple(r)[1:]) for r in byte_bpe.digest(docs, block=block).collect()]
        assert sorted(got) == sorted(want)
    assert byte_bpe.digest(empty_docs).count() == 0


def test_byte_bpe_parts_and_decoding(spark, edge_docs, library):
    rows = byte_bpe.encoded(edge_docs.filter("doc_id in (4, 5, 8)"), block=5000).collect()
    texts = {r.doc_id: r.text or "" for r in edge_docs.filter("doc_id in (4, 5, 8)").collect()}
    for doc_id, text in texts.items():
        mine = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.part)
        assert [r.part for r in mine] == list(range(len(mine))) and (len(mine) > 1) == (doc_id == 5)
        assert [i for r in mine for i in r.ids] == library.encode_ordinary(text) and b"".join(bytes(r.decoded) for r in mine) == text.encode()
    back = byte_bpe.decoded(spark.createDataFrame([(1, library.encode_ordinary("brown é fox")), (2, []), (3, None)], "doc_id long, ids array<int>")).collect()
    assert [bytes(r.decoded) for r in sorted(back)] == ["brown é fox".encode(), b"", b""]
