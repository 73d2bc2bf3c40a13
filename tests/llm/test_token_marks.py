"""Texts whose pre-tokens are marked and merged in one pass have the ids of the whole tokenizer."""

import json
import random

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from braidwork.llm import token_store


def _file() -> str:
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def test_marked_texts_equal_tokenizer():
    own = _file()
    whole = Tokenizer.from_str(own)
    whole.encode_special_tokens = True
    ranks = token_store.marked_ranks(own)
    coder = token_store.TextEncoder(own, ranks)
    assert coder.coder is not None
    rng = random.Random(5)
    chars = [chr(c) for c in range(0x250)] + list("İıǅǄΣςσ́̇ 　 字я१Ⅷ½😀") + list("'''''stdlrvem0123,.!?  \n\t") * 12 + list("aeinorst") * 60
    texts = [None, "", " ", "\n", "\x01", "\x01 \x02 a", "a,, 12.5%b", "don't 'tis ,'s x", "<|endoftext|>a<|startoftext|>"]
    texts += ["".join(rng.choices(chars, k=rng.randrange(60))) for _ in range(4000)]
    texts += [" ".join("".join(rng.choices("aeinorsthdlcu", k=rng.randrange(1, 14))) + rng.choice(["", "", ",", ".", "...", "'s", "7"]) for _ in range(rng.randrange(80))).title() for _ in range(400)]
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.ids(texts)]
    expected = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [(t, g, e) for t, g, e in zip(texts, got, expected, strict=True) if g != e][:3] == []


def test_files_whose_merges_ids_do_not_tell_are_not_marked():
    own = json.loads(_file())
    own["model"]["merges"][0], own["model"]["merges"][1] = own["model"]["merges"][1], own["model"]["merges"][0]
    assert token_store.marked_ranks(json.dumps(own)) is None
    other = json.loads(_file())
    other["pre_tokenizer"]["pretokenizers"] = other["pre_tokenizer"]["pretokenizers"][1:]
    assert token_store.marked_ranks(json.dumps(other)) is None


def test_words_of_marked_texts_are_not_looked_up():
    own = _file()
    coder, asked = token_store.TextEncoder(own, token_store.marked_ranks(own)), []
    ids = coder.words.ids
    coder.words.ids = lambda texts: asked.extend(texts) or ids(texts)
    coder.ids(["Castle, winter garden's 12 Été...", None])
    assert asked == ["garden's"]
