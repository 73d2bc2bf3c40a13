"""What the language model writes aside: texts spelt once, as ids that tell their words, and no more bytes a word than its numbers need."""

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

from braidwork.llm import attention_lm

ODD = ["", "river", "don't  x x  　   ", "été\x85 \x1c 's --  1,234.5\n\U0001f600!!", "zzyzx " * 100]


def _ranks() -> bytes:
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read()


def test_stored_ids_tell_the_words(spark):
    speller = attention_lm.Speller(_ranks(), P.PATTERN)
    docs = spark.createDataFrame([*enumerate(ODD), (9, None)], "doc_id long, text string")
    rows = attention_lm.encoded(docs, _ranks(), P.PATTERN).orderBy("doc_id").collect()
    texts = [bytes(r.ids) for r in rows]
    flat = np.frombuffer(b"".join(texts), speller.stored)
    assert flat.tolist() == np.concatenate(attention_lm.runs_of([r.doc_id for r in rows], [*(x.encode() for x in ODD), None], speller)).tolist()
    found = attention_lm.words_in(b"".join(texts), flat, [len(x) // flat.itemsize for x in texts], speller.leads)
    told = [[b"".join(speller.tokens[i] for i in np.frombuffer(w, speller.stored)) for w in words] for _, words in found]
    assert told == [[b" " + w for w in attention_lm.tokens_of(x.encode() if x else None)] for x in [*ODD, None]]


def test_scratch_bytes_of_a_rare_word(spark, monkeypatch):
    """All words are rare, and cost two numbers of four bytes each; the ids of texts are gone."""
    monkeypatch.setattr(attention_lm, "FREQUENT", 0)
    kept, written = {}, attention_lm.written
    monkeypatch.setattr(attention_lm, "written", lambda df, name: kept.setdefault(name, written(df, name)))
    rng = np.random.default_rng(0)
    words = 40_000
    texts = [" ".join(rng.choice([f"w{i}" for i in range(50)], words // 20)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert attention_lm.scored(docs, F.col("doc_id") >= 0, _ranks(), P.PATTERN).count() == 20
    sizes = {k: sum(spark._jvm.java.io.File(spark._jvm.java.net.URI(x)).length() for x in df.inputFiles()) for k, df in kept.items()}
    # 5.55 bytes; 6.83 with numbers of eight bytes
    assert sizes["lm-parts"] / words < 6.2, sizes
    assert sizes["lm-ids"] == 0
