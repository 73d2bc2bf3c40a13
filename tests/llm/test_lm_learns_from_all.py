"""The language model learns from every id of every training text."""

import numpy as np
import public_tokenizers as P

from braidwork.llm import attention_lm

WORDS = ["river", "castle", "window", "music", "garden", "unbelievable"]


def _ranks() -> bytes:
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read()


def test_runs_are_whole_texts_whatever_the_key():
    speller = attention_lm.Speller(_ranks(), P.PATTERN)
    for n in (0, 1, 23, 24, 25, 100, 1000):
        text = " ".join(WORDS[i % 6] + str(i) for i in range(n)).encode()
        whole = [speller.end, *np.frombuffer(b"".join(speller.spelt(text.split())), "<u4").tolist(), speller.end]
        for key in (0, 1, 2, 3, 7, 10**12):
            runs = attention_lm.runs_of([key], [text], speller)
            assert np.concatenate([runs[0][:1], *[r[1:] for r in runs]]).tolist() == whole
            targets = np.concatenate([attention_lm.all_windows(r)[:, 1:].ravel() for r in runs])
            assert targets[targets >= 0].tolist() == whole[1:]
    assert [r.tolist() for r in attention_lm.runs_of([4], [None], speller)] == [[speller.end] * 2]


def test_training_tells_each_id_once(spark):
    speller = attention_lm.Speller(_ranks(), P.PATTERN)
    texts = [" ".join(WORDS[(i + j) % 6] for j in range(7 * i)) for i in range(12)]
    ids = [len(b"".join(speller.spelt(t.encode().split()))) // 4 + 1 for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    top = attention_lm.top_ids(np.bincount(np.concatenate(attention_lm.runs_of([*range(12)], [t.encode() for t in texts], speller)), minlength=speller.end + 1))
    found = attention_lm.contexts(docs, top, _ranks(), P.PATTERN)
    # each id but the first mark of a text has one id right before it
    near = min(len(top), 256)
    assert near == len(top) and found[:, :near].sum() == sum(ids)
    network = attention_lm.Network(*attention_lm.classes_by(top, found, speller.leads))
    assert attention_lm.learned(docs, network, _ranks(), P.PATTERN) == sum(ids)
