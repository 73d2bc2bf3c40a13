"""Substring deduplication, decontamination, near duplicates, quality rules, byte-level BPE and the token store against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from braidwork.llm import byte_bpe, decontaminate, near_dup, quality_rules, substring_dedup, token_store
from braidwork.llm.common import table

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def frame(spark, rows, kind=DOCS):
    return spark.createDataFrame(rows, kind).repartition(3)


def noisy(seed, n=60):
    """Short texts over few words that share passages, with nulls, empties, copies and one repeated id."""
    r = random.Random(seed)
    passages = [" ".join(r.choices("abcdef", k=r.randrange(18, 60))) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [" ".join(r.choices([f"w{k}" for k in range(400)], k=r.randrange(0, 30))), r.choice([*passages, ""]), " ".join(r.choices(["x", "y"], k=r.randrange(0, 50)))]
        r.shuffle(parts)
        rows.append((i * 3, r.choice([" ", "\n", "\t ", "\x0b"]).join(parts)))
    return [*rows, (1, None), (2, ""), (4, "  \n"), (5, rows[7][1]), (7, rows[7][1]), (8, "é" * 30 + " 🂡 "), (10, " ".join(["z"] * 3000))]


# ---- 1


def deduplicated(rows, window=20):
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda x: x[0]):
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            run = tuple(w[i : i + window])
            if run in seen:
                gone.update(range(i, i + window))
            seen.add(run)
        out[key] = len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup(spark, seed):
    rows = noisy(seed)
    got = substring_dedup.deduplicated(frame(spark, rows), digest=True).collect()
    assert {r.doc_id: (r._words, r._removed, r._kept) for r in got} == {k: (a, b, hashlib.sha256(t.encode()).hexdigest()) for k, (a, b, t) in deduplicated(rows).items()}


def test_substring_dedup_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup.packed, "__defaults__", (600,))
    rows = noisy(3, 120)
    got = substring_dedup.deduplicated(frame(spark, rows)).collect()
    wanted = deduplicated(rows)
    assert {r.doc_id: (r._words, r._removed) for r in got} == {k: v[:2] for k, v in wanted.items()}
    given = dict(rows)
    assert all(r.text == (wanted[r.doc_id][2] if r._removed else given[r.doc_id]) for r in got)


def test_substring_dedup_edges(spark):
    assert substring_dedup.deduplicated(frame(spark, [])).count() == 0
    text = " ".join(map(str, range(25)))
    rows = [(None, text, 1, "p"), (3, text, 2, None), (3, text, 3, "q"), (None, None, None, None)]
    odd = frame(spark, rows, "doc_id long, text string, _words int, payload string")
    got = sorted((str(r.doc_id), r._words, r._removed) for r in substring_dedup.deduplicated(odd).collect())
    assert got == [("3", 25, 0), ("3", 25, 25), ("None", 0, 0), ("None", 25, 25)]
    kept = sorted((str(r.doc_id), str(r._words), str(r.payload)) for r in substring_dedup.kept(odd).collect())
    assert kept == sorted((str(k), str(n), str(p)) for k, _, n, p in rows)


# ---- 2

ITEMS = [(1, "The quick, BROWN fox jumps over the lazy dog again and again"), (2, "short item"), (3, None), (4, "!!"), (None, "no id here"), (5, "Éa b"), (2, "short item")]
TEXTS = [
    (1, "x the Quick brown-fox jumps over the LAZY dog again y"), (2, "A Short  item, twice: short item"), (3, None), (4, ""), (5, "clean"), (6, "short items"), (7, "no id here"), (8, "Éa b éa b"),
    (9, "the quick brown fox jumps over the lazy dog " * 50),
]


def decontaminated(items, texts, n=10):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = {}
    for name, text in items:
        w = fold(text)
        for i in range(len(w) - min(n, len(w)) + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add(name)
    out = {}
    for key, text in texts:
        w, hit, found = fold(text), set(), set()
        for g, names in grams.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit.update(range(i, i + len(g)))
                    found |= names
        out[key] = len(w), len(hit), sorted(str(x) for x in found if x is not None)
    return out


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_decontaminate(spark, block):
    found = decontaminate.scan(frame(spark, TEXTS), spark.createDataFrame(ITEMS, "item_id long, text string"), block_bytes=block)
    assert {r.doc_id: (r._words, sum(map(int.bit_count, r._hits)), r._items) for r in found.collect()} == decontaminated(ITEMS, TEXTS)


def test_decontaminate_removes(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.decontaminated(frame(spark, TEXTS), bench).collect()}
    assert got[2] == "A , twice: " and got[5] == "clean" and got[3] is None and got[6] == "short items"
    kept = decontaminate.decontaminated(frame(spark, TEXTS), bench, remove="documents").collect()
    assert {r.doc_id for r in kept} == {3, 4, 5, 6, 9}
    assert decontaminate.decontaminated(frame(spark, TEXTS), bench.limit(0)).count() == len(TEXTS)
    assert decontaminate.decontaminated(frame(spark, []), bench).count() == 0
    odd = frame(spark, [(1, "short item", 5, "x")], "doc_id long, text string, _hits int, _items string")
    assert [tuple(r) for r in decontaminate.decontaminated(odd, bench).collect()] == [(1, "", 5, "x")]


# ---- 9


def linked(rows, share, width=5):
    sets = {}
    for key, text in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[key] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    root = {k: k for k in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in keys}


def near(seed, groups=12):
    r = random.Random(seed)
    rows, key = [], 100
    for _ in range(groups):
        base = r.choices([f"w{k}" for k in range(300)], k=r.randrange(30, 200))
        for _ in range(r.randrange(1, 25)):
            own = list(base)
            for _ in range(r.randrange(0, 4)):
                own[r.randrange(len(own))] = f"n{r.randrange(1000)}"
            rows.append((key, " ".join(own).capitalize()))
            key += r.randrange(1, 5)
    return [*rows, (1, None), (2, ""), (3, "a b"), (4, "A  b"), (5, "b a"), (6, rows[0][1] + "\n")]


@pytest.mark.parametrize("share", [80, 85])
def test_near_dup(spark, share):
    rows = near(share)
    got = near_dup.classes(frame(spark, rows), share=share).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == linked(rows, share)


def test_near_dup_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "SMALL", 3)
    monkeypatch.setattr(near_dup, "CHUNK_BYTES", 4000)
    rows = near(7, 4)
    got = near_dup.classes(frame(spark, rows), share=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == linked(rows, 85)


def test_near_dup_edges(spark):
    assert near_dup.classes(frame(spark, [])).count() == 0
    assert near_dup.kept(frame(spark, [])).count() == 0
    rows = [(5, "a b c d e f", 1), (3, "a b c d e f", 2), (None, "a b c d e f", 3), (3, "other text", 4), (9, None, 5), (None, None, 6), (3, "a b c d e f", 2)]
    kept = near_dup.kept(frame(spark, rows, "doc_id long, text string, fp int")).collect()
    assert sorted((str(r.doc_id), str(r.text), r.fp) for r in kept) == [("3", "a b c d e f", 2), ("9", "None", 5), ("None", "None", 6), ("None", "a b c d e f", 3)]


def test_bayes_floors():
    floors = near_dup.floors(85)
    assert floors[-1][0] == near_dup.HASHES and all(a[1] <= b[1] for a, b in zip(floors, floors[1:], strict=False))
    # a pair at the threshold is dropped about once in a million
    rng = np.random.default_rng(1)
    agree = rng.random((100_000, near_dup.HASHES)) < 0.85
    a = np.zeros(agree.shape, np.uint16)
    assert near_dup.survivors(a, (~agree).astype(np.uint16), 85).mean() > 0.9999
    assert near_dup.survivors(a, (rng.random(agree.shape) > 0.3).astype(np.uint16), 85).mean() < 0.01


# ---- 10


def ruled(text):
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = {g for g in grams if grams.count(g) > 1}
    again = {j for i, g in enumerate(grams) if g in often for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again), failed


def test_quality_rules(spark):
    rows = [*noisy(5, 30), (1000, "a\nb\na\n \n\n b\na"), (1001, "# $% <b> 🂡🂡 " * 30), (1002, "a b c a b c"), (1003, "\x00 \x1c x")]
    got = {r.doc_id: (r.q_n_words, r.q_word_chars, r.q_symbols, r.q_dup_lines, r.q_repeat_words, r.q_base_failed) for r in quality_rules.judged(frame(spark, rows)).collect()}
    assert got == {k: ruled(t) for k, t in rows}


def test_quality_rules_distances(spark):
    english = "the cat sat on the edge of the old town and looked to the hills in a slow walk that is part of the way " * 1
    prose = " ".join(f"{english} {k}x" for k in ("one", "two", "three", "four", "five", "six"))
    prose = " ".join(w + str(i % 97 if i % 5 == 0 else "") for i, w in enumerate(prose.split()))
    junk = " ".join(f"{k * 7919 % 9973:04d}#{k * 104729 % 7919:04d}$" for k in range(200))
    got = {r.doc_id: r for r in quality_rules.judged(frame(spark, [(1, junk), (2, prose), (3, None)])).collect()}
    assert not got[1].q_kept and not got[1].q_base_failed and got[1].q_char_distance > 0.25
    assert got[2].q_lang == "en" and got[2].q_char_distance < got[1].q_char_distance
    p = spark.range(1).select(quality_rules.js_distance(quality_rules.doubles([1, 0]), quality_rules.doubles([0, 1])).alias("far"), quality_rules.js_distance(quality_rules.doubles([0.5, 0.5]), quality_rules.doubles([0.5, 0.5])).alias("near")).first()
    assert (p.far, p.near) == (1.0, 0.0)
    odd = frame(spark, [(None, junk, 1, "x")], "doc_id long, text string, q_words int, Q_KEPT string")
    assert quality_rules.kept(odd).count() == 0 and quality_rules.kept(frame(spark, [])).count() == 0


def test_quality_rules_stay_native(spark, sf):
    plan = quality_rules.op10_quality_rules(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# ---- 8

HARD = [
    (1, None), (2, ""), (3, "  Hello world's it'LL don't\n\n  x  y  "), (4, "日本語のテキスト 🂡🂡 é́"), (5, "a" * 300), (6, "1234567 ½ ²"), (7, "​﻿\x1c\x1d"), (8, "<|endoftext|>"), (9, "x \r\n\t y"),
    (10, "".join(chr(c) for c in range(1, 0x500))), (11, "ther " * 2000),
]


def test_byte_bpe(spark, sf):
    tiktoken = pytest.importorskip("tiktoken")
    path = P.path("byte_bpe_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=dict(ranks), special_tokens={})
    docs = frame(spark, HARD).union(table(spark, sf, "documents").select("doc_id", "text").where("doc_id % 4 = 0"))
    for most in (1 << 19, 64):
        out, codec = byte_bpe.encoded(docs, ranks, most=most)
        for r in out.select("text", "_ids", codec.packed(F.col("_ids")).alias("packed"), codec.decoded(F.col("_ids")).alias("back")).collect():
            ids = coder.encode_ordinary(r.text or "")
            assert r._ids == ids
            assert bytes(r.packed) == np.array(ids, "<u4").tobytes() and bytes(r.back) == (r.text or "").encode()
    assert byte_bpe.digests(frame(spark, []), ranks).count() == 0
    with pytest.raises(ValueError):
        byte_bpe.Codec(spark, [(b"a", 0), (b"b", 2)])


# ---- 3


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes(kind):
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 2**32, n, dtype=np.uint64).astype("<u4")
        assert (token_store.unplanes(n, token_store.planes(ids, kind), kind) == ids).all()
    assert len(token_store.planes(ids, kind)) == {"byte": 4, "bit": 32}[kind]


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_token_store(spark, sf, tmp_path, kind):
    path = P.path("word_bpe_49k.json")
    coder = tokenizers.Tokenizer.from_file(path)
    coder.encode_special_tokens = True
    rows = [*HARD, *[(1000 + r.doc_id, r.text) for r in table(spark, sf, "documents").where("doc_id % 3 = 0").collect()]]
    token_store.write_store(frame(spark, rows), str(tmp_path / kind), open(path, encoding="utf-8").read(), kind=kind, chunk_ids=3000, block_ids=1024)
    got = {r.doc_id: r for r in token_store.read_store(spark, str(tmp_path / kind)).collect()}
    at = 0
    for key, text in sorted(rows):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 1]
        assert (got[key].start, got[key].n_tokens, bytes(got[key].ids)) == (at, len(ids), np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert len(got) == len(rows)


def test_token_store_edges(spark, tmp_path):
    model = open(P.path("word_bpe_49k.json"), encoding="utf-8").read()
    token_store.write_store(frame(spark, []), str(tmp_path / "none"), model)
    assert token_store.read_store(spark, str(tmp_path / "none")).count() == 0
    token_store.write_store(frame(spark, [(None, "a"), (7, "b b"), (7, None)]), str(tmp_path / "odd"), model)
    got = token_store.read_store(spark, str(tmp_path / "odd")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 7, 7] and sorted(r.n_tokens for r in got) == [1, 2, 3]


def test_token_store_query(spark, sf):
    from braidwork.llm.queries import QUERIES

    coder = tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))
    coder.encode_special_tokens = True
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op3_token_store"](spark, sf).collect()}
    at = 0
    for r in table(spark, sf, "documents").orderBy("doc_id").collect():
        ids = np.array([*coder.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        assert got[r.doc_id] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
