"""Ids against the tiktoken library, and the exact round trip."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidelog.llm import bpe
from tidelog.llm.chunks import ChunkMemory
from tidelog.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
OWN = bpe.coder(RANKS, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=OWN.ranks, special_tokens={})


def library(text):
    return np.array(LIBRARY.encode_ordinary(text), "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'stan19.,!\x1c\x85 ́漢é😀"), st.characters(codec="utf-8")), max_size=40))
def test_any_text(text):
    ids = OWN.encode(text)
    assert ids == library(text)
    assert OWN.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["", " ", "a" * 20_000, "ab" * 5_000, "\n" * 3_000, "é漢" * 2_000, "it's  <|endoftext|> 12\r\n x", "x " * 9])
def test_hard_texts(text):
    assert OWN.encode(text) == library(text)
    assert OWN.decode(OWN.encode(text)) == text.encode()


def test_small_memory_gives_the_same():
    small = ChunkMemory(lambda parts: [library(p) for p in parts], limit=3)
    for text in ("one two, three. four", "one  two\n three", " one, one, one.", "x, y; z! two,"):
        assert small.ids(text) == library(text)


def test_a_pre_token_is_merged_once():
    own, merged = bpe.ByteBPE(RANKS, public_tokenizers.PATTERN), []
    merge, own.merge = own.merge, lambda pieces: merged.extend([pieces] if isinstance(pieces, bytes) else pieces) or merge(pieces)
    texts = ["one zqxab zqxcd!! zqxab,\nzqxcd zqxab?! zqxcd;\nzqxcd", "zqxcd zqxef zqxab zqxab***", "zqxef!! zqxab\nzqxef zqxab"]
    assert [own.encode(t) for t in texts] == list(map(library, texts))
    assert merged.count(b" zqxab") == merged.count(b" zqxcd") == merged.count(b"zqxcd") == 1
    assert own.encode_all(texts) == list(map(library, texts)) and merged.count(b" zqxab") == 1


def test_frequent_chunks_stay_remembered():
    asked = []
    small = ChunkMemory(lambda parts: asked.extend(parts) or [library(p) for p in parts], limit=8)
    for k in range(20):
        assert small.ids(text := f"x common word{k}") == library(text)
    assert asked.count(" common") == 1


def test_merged_together_as_alone():
    rng = np.random.default_rng(4)
    pieces = ["".join(rng.choice(list("abcesthn \né漢"), rng.integers(1, 14))).encode() for _ in range(3000)] + [b"ab" * 900, b"a" * 901]
    pieces = [p for p in pieces if p not in OWN.ranks]
    assert OWN.merge(pieces) == [ids for p in pieces for ids in OWN.merge([p])]


def test_other_library_agrees(lspark, sf):
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    texts = [r.text for r in lspark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for text, found in zip(texts, other.encode_batch(texts, add_special_tokens=False)):
        assert np.array(found.ids, "<u4").tobytes() == OWN.encode(text)


def test_whole_table(lspark, sf):
    docs = lspark.read.parquet(f"{sf}/documents.parquet").collect()
    want = sorted((r.doc_id, len(i := library(r.text)) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest())
                  for r in docs)
    assert sorted(tuple(r) for r in QUERIES["op9_byte_bpe"](lspark, sf).collect()) == want


def test_odd_rows(lspark):
    rows = [(1, None, 7), (1, None, 7), (None, "", 8), (2, "w" * 100_000, 9)]
    docs = lspark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(str((r.doc_id, r.n_tokens)) for r in got) == ["(1, 0)", "(1, 0)", f"(2, {len(library('w' * 100_000)) // 4})", "(None, 0)"]
    coded = bpe.encoded(docs, RANKS, public_tokenizers.PATTERN)
    back = bpe.decoded(coded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(len(r.bytes) for r in back) == [0, 0, 0, 100_000]
    assert bpe.round_trip(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
