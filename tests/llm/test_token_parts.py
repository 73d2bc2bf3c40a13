"""Parts of stretches whose ids are known from other stretches are not encoded again, and ids stay the library's."""

import public_tokenizers as P
from tokenizers import Tokenizer

from braidwork.llm.token_store import WordEncoder


def test_parts_met_before_are_not_encoded_again():
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        own = f.read()
    coder, library, asked = WordEncoder(own), Tokenizer.from_str(own), []
    parts = coder._parts
    coder._parts = lambda words: asked.extend(words) or parts(words)
    texts = ["castle winter garden", "castle, WINTER! garden's (garden) Éte", "Winter... CASTLE; été, GARDEN winter!!  "]
    for text in texts:
        got = [int.from_bytes(x[i : i + 4], "little") for x in coder.ids([text]) for i in range(0, len(x), 4)]
        assert got == library.encode(text, add_special_tokens=False).ids
    assert sorted(w for w in asked if w.isascii() and w.isalpha()) == ["castle", "garden", "winter"]
