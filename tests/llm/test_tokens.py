"""Token ids word by word equal those of whole texts."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarnlake.llm.perfect_hash import PerfectHash, fingerprints
from tarnlake.llm.tokens import encoder, public_tokenizer

ODD = ["", " ", "don't  we'll 'S", "a|b | c || d", "<|endoftext|> x", "ÀÉ é ñ 日本語 한국", "x" * 300, "tab\tnew\nline\r\x0b\x0c",
       "no break 　 wide", "emoji 😀😀 1234 5.6%", "İstanbul ΣΑΣ ß"]


def same(texts):
    enc = encoder(public_tokenizer())
    ids, bounds = enc.encode(pa.array(texts, pa.string()), end=7)
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        whole = enc._tokenizer.encode(text or "", add_special_tokens=False).ids
        assert ids[a:b].tolist() == [*whole, 7]


def test_odd_texts():
    same([*ODD, None, " ".join(ODD)])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_any_text(texts):
    same(texts)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 5000])
def test_perfect_hash_numbers_its_keys(n):
    keys = np.random.default_rng(n).choice(1 << 62, n, replace=False).astype(np.int64) - (1 << 61)
    hashed = PerfectHash.build(keys)
    assert sorted(hashed.index(keys).tolist()) == list(range(n))
    assert len(hashed.bits) * 8 <= 8 * max(n, 8)
    foreign = np.arange(1000, dtype=np.int64) + (1 << 62)
    at = hashed.index(foreign)
    if n:
        order = np.argsort(hashed.index(keys))
        kept = fingerprints(keys[order])
        assert not (kept[at[at >= 0]] == fingerprints(foreign[at >= 0])).any()
    with pytest.raises(ValueError, match="distinct"):
        PerfectHash.build(np.asarray([5, 5], np.int64))
