"""Fewer passes of the language model give the same: words looked up all at once, frequent words spelt once, logits left where they are."""

import numpy as np
import public_tokenizers as P
import pytest

from braidwork.llm import attention_lm


def test_frequent_words_are_spelt_once():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        speller = attention_lm.Speller(f.read(), P.PATTERN, most=40_000)
    often, learned, learn = [b"river", b"castle", b"don't", "été".encode()], [], speller._learn
    speller._learn = lambda words: (learned.extend(words), learn(words))
    for i in range(300):
        got = speller.spelt([*often, b"w%dz" % i, *often])
        assert got[:4] == got[5:]
    # all was forgotten when the cache was full, so that these were learned twice
    assert sorted(w for w in learned if w in often) == sorted(often)
    assert len(speller.known) < 300 and speller.size <= 41_000


@pytest.mark.parametrize("kind", ["<u2", "<u4"])
def test_numbers_of_words(kind):
    rng = np.random.default_rng(0)
    size = np.dtype(kind).itemsize
    words = sorted({rng.integers(0, 6, rng.integers(1, 8)).astype(kind).tobytes() for _ in range(20_000)})
    held = words[::3]
    known = {w: i for i, w in enumerate(held)}
    data = b"".join(words)
    sizes = np.array([len(w) // size for w in words])
    for some, want in ((held, [known.get(w, -1) for w in words]), ([], [-1] * len(words))):
        numbers = attention_lm.Numbers(some, kind)
        assert numbers.of(data, np.frombuffer(data, kind), np.cumsum(sizes) - sizes, sizes).tolist() == want


@pytest.mark.parametrize("most", [1, 400_000])
def test_words_counted_by_their_ids(spark, most):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    texts = [None, "", "river  RIVER été 　 don't \x85 \x1c x", "unbelievablyantidisestablishmentarian zzyzx " * 3, "\ufffd 1,234.5 \U0001f600!! river"]
    docs = spark.createDataFrame([(i, " ".join([t] * k) if t else t) for i, t in enumerate(texts) for k in (1, 2)], "doc_id long, text string")
    for some in (docs, docs.limit(0)):
        want = {r.word: r.c for r in attention_lm.word_counts(some).collect()}
        assert {r.word: r.c for r in attention_lm.counted(attention_lm.encoded(some, ranks, P.PATTERN), ranks, P.PATTERN, most).collect()} == want
    assert not want


def test_large_logits_give_right_chances():
    """Logits were cut at 60, so that classes beyond it were alike."""
    classes = np.arange(41) % 7
    network = attention_lm.Network(classes, 3, np.arange(41))
    network.p["out"] *= 400
    ids = np.random.default_rng(0).integers(0, 41, (3, 20))
    network.p = {k: v.astype(float) for k, v in network.p.items()}
    own, begins = network.ready().chances(ids[:, :-1], ids[:, 5:], 4)
    p, logits = network.p, []
    for row in ids:
        x = p["e"][row[:-1]] + p["pos"][:19]
        s = (x @ p["q"]) @ (x @ p["k"]).T / attention_lm.WIDTH**0.5 + np.where(np.tri(19) > 0, 0, -np.inf)
        s = np.exp(s - s.max(axis=1, keepdims=True))
        h = x + (s / s.sum(axis=1, keepdims=True)) @ x @ p["v"] @ p["o"]
        logits.append((h + np.maximum(h @ p["w1"] + p["b1"], 0) @ p["w2"]) @ p["out"] + p["bias"])
    z = np.array(logits)[:, 4:]
    assert z.max() > 60
    log = z - np.logaddexp.reduce(z, axis=2, keepdims=True)
    assert np.allclose(own, np.take_along_axis(log, classes[ids[:, 5:]][:, :, None], 2)[:, :, 0], atol=1e-6)
    some = np.logaddexp.reduce(log[:, :, :3], axis=2)
    # begins are told down to 1e-30 of the largest class
    assert np.allclose(begins[some > -50], some[some > -50], atol=1e-6)
