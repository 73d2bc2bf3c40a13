"""The shortcut of plain stretches gives the ids of the whole tokenizer."""

import numpy as np
import pytest

from braidwork.llm import token_store

P = pytest.importorskip("public_tokenizers")


def test_shortcut_equals_tokenizer():
    from tokenizers import Tokenizer

    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        text = f.read()
    coder, whole = token_store.WordEncoder(text), Tokenizer.from_str(text)
    whole.encode_special_tokens = True
    words = [w for c in map(chr, range(0x21, 0x250)) if not c.isspace() for w in (c, c + "abc", "abc" + c, c + ")", c + ".", "A" + c + "b!", c + c)]
    words += ["\u00d7abc", "\u00d7)", "\u00f7.", "a\u00d7b", "<|endoftext|>", "abc<|endoftext|>def", "<|startoftext|>."]
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.ids(words)]
    assert coder.plain
    assert {w: g for w, g, e in zip(words, got, whole.encode_batch(words, add_special_tokens=False)) if g != e.ids} == {}
