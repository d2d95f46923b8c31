"""The transducer against the tiktoken library, and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ticklake.llm import bpe

FILES = ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"]


def load(name):
    with open(public_tokenizers.path(name), "rb") as f:
        ranks = bpe.load_ranks(f.read())
    return ranks, tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=FILES)
def coder(request):
    ranks, own = load(request.param)
    return bpe.Encoder(ranks, public_tokenizers.PATTERN), own


TEXTS = ["", " ", "\n\n \t", "hello world's  end", "a" * 3000, "ab" * 2000, " " * 999, "=" * 500 + "-" * 333,
         "Éçeau aianre für größe", "日本語テキスト", "🙂🙃" * 50, "\u0000́e", "<|endoftext|>", "1234567890" * 30,
         "the" * 700, "\r\n" * 90, "a\x1cb\x85 c\xa0\xa0 d²³ ¼ª x"]


def test_fixed_texts(coder):
    enc, own = coder
    for t in TEXTS:
        assert enc.encode(t) == own.encode_ordinary(t), t[:40]


def test_random_pieces(coder):
    enc, own = coder
    rng = random.Random(4)
    tokens = [t for t in enc.fst.tokens.values()]
    for _ in range(3000):
        raw = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 6)))
        assert enc.fst.encode(raw) == own._encode_single_piece(raw), raw
    for _ in range(3000):
        raw = bytes(rng.choice(b"abst e\xc3\xa9\xe2\x82=-") for _ in range(rng.randint(1, 30)))
        assert enc.fst.encode(raw) == own._encode_single_piece(raw), raw


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    enc, own = test_any_text.pair
    text = text.encode("utf-8", "ignore").decode()
    ids = enc.encode(text)
    assert ids == own.encode_ordinary(text)
    assert "".join(bpe.decode(ids, enc.fst.tokens, burst=2)) == text


test_any_text.pair = (lambda r: (bpe.Encoder(r[0], public_tokenizers.PATTERN), r[1]))(load(FILES[0]))


def test_state_table_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 10)
    assert bpe.Encoder({bytes([i]): i for i in range(256)}, r"\s+|\S+").encode("no merges") == list(b"no merges")
    monkeypatch.setattr(bpe, "MAX_PIECES", 3)
    ranks, own = load(FILES[0])
    enc = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    for t in TEXTS:
        assert enc.encode(t) == own.encode_ordinary(t)


def test_utf8_machine_holds_back():
    m = bpe.Utf8Machine()
    data = "aé€🙂z".encode()
    assert "".join(m.feed(data[i:i + 1]) for i in range(len(data))) + m.close() == "aé€🙂z"
    m.feed(b"\xe2\x82")
    with pytest.raises(UnicodeDecodeError):
        m.close()


def test_documents(frame):
    ranks, own = load(FILES[0])
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, None, "x"), (3, "again", "x"), (3, "again", "x")]
    df = frame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, bpe.encode_documents(df, ranks, public_tokenizers.PATTERN, with_ids=True).collect()), key=str)
    want = []
    for i, t, _ in rows:
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest(), ids))
    assert got == sorted(want, key=str)
    assert bpe.encode_documents(df.limit(0), ranks, public_tokenizers.PATTERN).count() == 0
