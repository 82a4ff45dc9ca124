"""Token files and BPE against the tokenizers library."""

import hashlib
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cartograph.llm import bpechunks, tokenfile
from cartograph.llm.wordbpe import WordBpe, unpack
from tests.llm.conftest import clashing, rows_of

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@given(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 300), max_size=700))
@settings(max_examples=60, deadline=None)
def test_segment_round_trip(ids):
    data = np.array(ids, np.uint32)
    payload = tokenfile.write_segment(data)
    assert tokenfile.read_range(payload).tolist() == ids
    assert tokenfile.read_range(payload, 1, 3).tolist() == ids[128:384]


def test_segment_is_packed():
    data = np.random.default_rng(0).integers(1000, 1064, 128 * 200).astype(np.uint32)
    data[::128] = 40_000  # one exception a block
    assert len(tokenfile.write_segment(data)) < 128 * 200 * 6 / 8 + 200 * 16 + 100


def test_word_encoder_equals_library(library, odd_rows):
    bpe = WordBpe(PATH)
    for _, text, *_ in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert list(unpack(bpe.encode(text or ""))) == ids
        assert bpe.decode(bpe.encode(text or "")) == library.decode(ids, skip_special_tokens=False)


def test_word_encoder_on_any_text(library):
    bpe = WordBpe(PATH)

    @given(st.text(max_size=80) | st.text("ab <|endoftext|>é́\n\x1c\u0085　ßİΣς'st9", max_size=60))
    @settings(max_examples=300, deadline=None)
    def check(text):
        assert list(unpack(bpe.encode(text))) == library.encode(text, add_special_tokens=False).ids

    check()


def test_token_file(spark, odd_docs, odd_rows, no_docs, library, monkeypatch):
    monkeypatch.setattr(tokenfile, "SEGMENT_TOKENS", 300)
    got = tokenfile.read_tokens(tokenfile.write_tokens(clashing(odd_docs), PATH))
    want, at = [], 0
    ids = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in odd_rows]
    rows = {(r["doc_id"], r["n_tokens"], r["ids_crc32"]): [] for r in got.collect()}
    assert sorted(rows, key=repr) == sorted({(d, len(x), zlib.crc32(array("I", x).tobytes())) for d, x in ids}, key=repr)
    for r in sorted(got.collect(), key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
        want.append(-1 if r["doc_id"] is None else r["doc_id"])
    assert want == sorted(want) and at == sum(len(x) for _, x in ids)
    assert tokenfile.read_tokens(tokenfile.write_tokens(no_docs, PATH)).count() == 0


def sha(x):
    return hashlib.sha256(x).hexdigest()


def test_bpe_chunk_reuse(odd_docs, odd_rows, no_docs, library):
    got = bpechunks.encode(clashing(odd_docs), PATH, keep=["doc_id"])
    want = []
    for r in odd_rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), sha(array("I", ids).tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    assert rows_of(got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == sorted(want, key=repr)
    assert bpechunks.encode(no_docs, PATH, keep=["doc_id"]).count() == 0


def test_chunks_follow_content(odd_rows):
    for _, text, *_ in odd_rows:
        assert b"".join(bpechunks.chunks(text or "")).decode() == (text or "")
    long = odd_rows[11][1]
    a, b = set(bpechunks.chunks(long)), set(bpechunks.chunks("some words before " + long))
    assert len(a & b) >= len(a) - 2


def test_joins_are_repaired(library):
    bpe = WordBpe(PATH)
    text = "alpha beta gamma delta don't <|endoftext|> stop 123 étude"
    raw = text.encode()
    for cut in range(1, len(raw)):
        try:
            a, b = raw[:cut].decode(), raw[cut:].decode()
        except UnicodeDecodeError:
            continue
        parts = [(x.encode(), bpe.encode(x)) for x in (a, b)]  # cuts inside words disagree and are repaired
        assert list(unpack(bpechunks.join_ids(parts, bpe))) == library.encode(text, add_special_tokens=False).ids
