"""Operators that SQL cannot express against plain loops: quotation linking, the additive model, URL filters, near duplicates of repeated ids."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from braidwork.llm import near_dup, quality_gam, quote_threads, url_filter
from braidwork.llm.common import table

DOCS = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- 9


def components_by_hand(rows, share):
    sets = []
    for key, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = {key: key for key, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= share * (len(sets[i]) + len(sets[j]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return Counter((key, len(s), find(key)) for (key, _), s in zip(rows, sets, strict=True))


def found(spark, rows, share):
    return Counter(map(tuple, near_dup.classes(spark.createDataFrame(rows, DOCS), share).collect()))


S, T, U = ("one two three four five six seven eight", "red green blue white black brown pink grey", "a b c d e f g h i j k")


@pytest.mark.parametrize("rows", [[(2, S), (5, S), (5, T), (7, T)], [(2, S), (5, S), (3, T), (5, T)], [(5, S), (5, T), (5, U), (1, U), (5, None)], [(4, S), (4, S), (4, None), (6, "")]])
def test_texts_of_one_id_are_one_document(spark, rows):
    assert found(spark, rows, 85) == components_by_hand(rows, 85)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_ids_at_random(spark, monkeypatch, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(words) for _ in range(rng.randrange(30, 120))] for _ in range(25)]
    rows = []
    for _ in range(220):
        own = list(rng.choice(bases))
        for _ in range(rng.randrange(3)):
            own[rng.randrange(len(own))] = rng.choice(words)
        rows.append((rng.randrange(150), " ".join(own)))
    rows += [(rng.randrange(150), rng.choice([None, "", "x", "x y"])) for _ in range(12)]
    monkeypatch.setattr(near_dup, "SMALL", 3)
    monkeypatch.setattr(near_dup, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(near_dup, "HOT", 20)
    assert found(spark, rows, 80) == components_by_hand(rows, 80)


# ---- 5


def threads_by_hand(rows):
    """parent and root of each message, by comparing every passage with every earlier message."""
    own, quoted = {}, {}
    for c, t, text in rows:
        mine, passages = quote_threads.parse(text)
        own[c, t] = quote_threads.passages_of(mine)
        quoted[c, t] = [(level, p) for level, whole in passages for p in quote_threads.passages_of(whole)]
    parent = {}
    for c, t, _ in rows:
        best = None
        for level, p in quoted[c, t]:
            first = min((u for d, u in own if d == c and p in own[d, u]), default=None)
            if first is not None and first < t:
                best = min(best or (level, -first), (level, -first))
        parent[c, t] = None if best is None else -best[1]
    root = {}
    for c, t in parent:
        at = t
        while parent[c, at] is not None:
            at = parent[c, at]
        root[c, t] = at
    return parent, root


def mails(seed):
    rng = random.Random(seed)
    words = "the old station bridge river winter garden music letter friend window market".split()
    rows, said = [], defaultdict(list)
    for c in range(6):
        for t in range(12):
            mine = "\n\n".join(" ".join(rng.choices(words, k=rng.randrange(1, 30))) + "." for _ in range(rng.randrange(1, 3)))
            quote = ""
            if said[c] and rng.random() < 0.8:
                old = rng.choice(said[c])
                part = rng.choice([old, old.split("\n")[0], " ".join(old.split()[2:16])])
                lines = re.sub(r"(\S+ \S+ \S+ \S+ \S+) ", "\\1\n", part) if rng.random() < 0.5 else part
                quote = "Ann wrote:\n" + "\n".join("> " * rng.randrange(1, 3) + x for x in lines.split("\n")) + "\n"
            rows.append((c, t, quote + mine if rng.random() < 0.7 else mine + "\n" + quote))
            said[c].append(mine)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_threads_by_hand(spark, monkeypatch, seed):
    monkeypatch.setattr(quote_threads, "HOT", 50)
    rows = mails(seed)
    parent, root = threads_by_hand(rows)
    got = quote_threads.threaded(spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")).collect()
    assert {(r.conv_id, r.turn): r.parent_turn for r in got} == parent
    assert {(r.conv_id, r.turn): r.root_turn for r in got} == root
    assert sum(p is not None for p in parent.values()) > 30
    order = sorted(root, key=lambda k: (k[0], root[k], k[1]))
    assert {(r.conv_id, r.turn): r.position for r in got} == {k: sum(o[0] == k[0] for o in order[:i]) for i, k in enumerate(order)}


def test_parts_and_short_passages_are_found(spark):
    long = "we walked along the river until the old bridge came in sight and then turned back home. it was late."
    rows = [(1, 0, long), (1, 1, "> the river until the old bridge came in\n> sight and then turned back\nnice walk"), (1, 2, "Sounds good!"), (1, 3, "> Sounds good!\nok"), (1, 4, "> it was late.\nyes")]
    got = {r.turn: r.parent_turn for r in quote_threads.threaded(spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")).collect()}
    assert got == {0: None, 1: 0, 2: None, 3: 2, 4: 0}


# ---- 4


def features_by_hand(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    if not words:
        return [0.0] * len(quality_gam.FEATURES)
    raw = [w.encode() for w in words]
    chars = "".join(words).encode()
    n, size = len(words), max(len(chars), 1)
    share = lambda kept: sum(b in kept for b in chars)
    lines = [x for x in text.encode().split(b"\n") if x.strip()]
    return [
        math.log1p(n), size / n, share(range(65, 91)) / size, share(b"0123456789") / size, share(b"#*$%&|<>") / size, share(b".,;:?") / n, share(b"!\"'()+-/=@[\\]^_`{}~") / n, share(range(128, 256)) / size,
        len(set(words)) / n, max(Counter(words).values()) / n, 1 - len(set(lines)) / len(lines), math.log1p(n / len(lines)), text.count("!!") / n, sum(len(w) <= 3 for w in raw) / n,
    ]


def test_features_and_scores_by_hand(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()} | {10**6: None, 10**6 + 1: "", 10**6 + 2: "x\n\nx !! #a Ü"}
    frame = spark.createDataFrame(list(texts.items()), DOCS)
    known = quality_gam.featured(frame)
    for r in known.collect():
        assert np.allclose(r.x, features_by_hand(texts[r.doc_id]), rtol=1e-9), r.doc_id
    model = quality_gam.learned(known, table(spark, sf, "labels"))
    for r in quality_gam.scored(known, model).collect():
        x = features_by_hand(texts[r.doc_id])
        at = [sum(float(v) >= e for e in edges) for v, edges in zip(x, model.edges, strict=True)]
        odds = model.bias + sum(t[b] for t, b in zip(model.tables, at, strict=True)) + sum(t[at[i], at[j]] for (i, j), t in model.pairs.items())
        near_edge = any(abs(v - e) < 1e-9 for v, edges in zip(x, model.edges, strict=True) for e in edges)
        assert near_edge or math.isclose(r.score, 1 / (1 + math.exp(-odds)), rel_tol=1e-6), r.doc_id


def test_trees_are_the_best_cuts_by_hand():
    """Each cut of a tree is the one of all that gains most."""
    rng = np.random.default_rng(3)
    for _ in range(20):
        g, h = rng.normal(size=9), rng.random(9) + 0.1
        worth = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + 1)  # noqa: E731, B023
        parts = [(0, 9)]
        while len(parts) < quality_gam.LEAVES:
            gains = [(worth(a, m) + worth(m, b) - worth(a, b), a, m, b) for a, b in parts for m in range(a + 1, b)]
            gain, a, m, b = max(gains, default=(0, 0, 0, 0))
            if gain <= 1e-9:
                break
            parts.remove((a, b))
            parts += [(a, m), (m, b)]
        values = np.zeros(9)
        for a, b in parts:
            values[a:b] = -g[a:b].sum() / (h[a:b].sum() + 1)
        assert np.allclose(quality_gam._tree(g, h), values)


def test_fold_of_held_out_rows(spark, sf):
    from braidwork.llm.queries import QUERIES

    for r in QUERIES["op4_quality_gam"](spark, sf).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1


# ---- 7


def slot(spark, kind, grams):
    rows = spark.createDataFrame([(g,) for g in grams] or [("",)], "g string").select("g", F.pmod(F.xxhash64(F.lit(kind), "g"), F.lit(url_filter.SLOTS)).cast("int").alias("s"))
    return {r.g: r.s for r in rows.collect()}


def test_urls_by_hand(spark, sf):
    urls = [r.url for r in table(spark, sf, "pages").limit(40).collect()] + ["http://www.casino-win.com/play", "https://x.org/fr/a?b#c", "no scheme", None, "http://EXAMPLE.com/de/x", "a://b", "http://a.b.net/x?y://z"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labelled = url_filter.LABELLED
    weights = url_filter.train(spark, labelled)
    got = {r.page_id: r for r in url_filter.judged(rows).collect()}
    every = defaultdict(set)

    def cut(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        return re.sub("[A-Z]", lambda m: m[0].lower(), host), path

    def grams(host, path):
        marked, tail = f".{host}.", re.sub("[0-9]", "0", path)
        return {("h3", marked[i : i + 3]) for i in range(len(marked) - 2)} | {("h4", marked[i : i + 4]) for i in range(len(marked) - 3)} | {("p4", tail[i : i + 4]) for i in range(len(tail) - 3)}

    for url in urls:
        for kind, g in grams(*cut(url)):
            every[kind].add(g)
    slots = {kind: slot(spark, kind, sorted(gs)) for kind, gs in every.items()}
    for i, url in enumerate(urls):
        host, path = cut(url)
        own = {slots[k][g] for k, g in grams(host, path)}
        odds = sum(weights[s] for s in own) / math.sqrt(max(len(own), 1)) + weights[url_filter.SLOTS]
        score = 1 / (1 + math.exp(-odds))
        fit = [(len(t), t, v) for v, t in url_filter.RULES if (host == t.split("/", 1)[0] or host.endswith("." + t.split("/", 1)[0])) and path.startswith("/" + t.split("/", 1)[1])]
        r = got[i]
        assert (r.u_host, r.u_path, r.u_rule) == (host, path, max(fit)[1] if fit else None)
        assert math.isclose(r.u_score, score, rel_tol=1e-9)
        assert r.u_verdict == (max(fit)[2] if fit else "block" if score >= url_filter.BLOCK_AT else "allow")
