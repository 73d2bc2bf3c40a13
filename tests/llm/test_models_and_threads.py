"""The quality model, attention scoring, quotation linking, URL filters, the pipeline, and the queries that SQL can express."""

import math
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from braidwork.llm import attention_lm, quality_gam, quote_threads, url_filter
from braidwork.llm.common import ids_and_texts, table
from braidwork.llm.queries import ORACLES, QUERIES

P = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string"
BIG = Path("/root/testdata/sf0.01")


# ---- 4


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.skipif(not BIG.exists(), reason="no test tables")
def test_quality_on_held_out_rows(spark):
    got = {r.doc_id: r for r in quality_gam.op4_quality_gam(spark, str(BIG)).collect()}
    labels = {r.doc_id: r.quality for r in table(spark, str(BIG), "labels").where("quality IS NOT NULL").collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for k, r in got.items())
    held = [k for k in labels if k in got and got[k].held_out]
    y = np.array([labels[k] for k in held])
    assert auc(np.array([got[k].score for k in held]), y) > 0.85
    assert (np.array([got[k].predicted for k in held]) == y).mean() > 0.8


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:2000], y[:2000])
    assert auc(model.score(x[2000:]), y[2000:]) > 0.95 and len(model.pairs) > 0


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "x " * 5000), (3, "y")], DOCS)
    known = quality_gam.featured(docs)
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (3, 0)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        rows = quality_gam.scored(known, quality_gam.learned(known, some)).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows} == {0.5}
    assert quality_gam.scored(quality_gam.featured(docs.limit(0)), quality_gam.learned(known.limit(0), labels)).count() == 0


# ---- 6


def test_attention_gradients():
    rng = np.random.default_rng(1)
    windows = rng.integers(0, 40, (64, attention_lm.WINDOW + 1)).astype(np.int32)
    classes, begin, rows = attention_lm.classes_of(windows, np.arange(41) % 2 == 0)
    net = attention_lm.Network(classes, begin, rows)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    ids, targets, some = windows[:4, :-1], windows[:4, 1:], np.ones((4, attention_lm.WINDOW), bool)
    loss = lambda: -net.ready().chances(ids, targets, 0)[0].mean()
    slopes = net.slopes(ids, targets, some)
    whole = np.zeros_like(net.p["e"])
    whole[slopes["rows"]] = slopes["e"]
    slopes["e"] = whole
    for k, at in (("q", (1, 2)), ("k", (3, 0)), ("v", (2, 2)), ("o", (0, 1)), ("w1", (4, 5)), ("w2", (3, 1)), ("out", (2, 3)), ("e", (int(rows[ids[0, 0]]), 1)), ("pos", (5, 2)), ("bias", (1,)), ("b1", (2,))):
        old, step = net.p[k][at], 1e-5
        net.p[k][at] = old + step
        up = loss()
        net.p[k][at] = old - step
        assert math.isclose((up - loss()) / (2 * step), slopes[k][at], rel_tol=1e-3, abs_tol=1e-7), k
        net.p[k][at] = old


def test_windows_score_each_token_once():
    lengths = np.array([1, 5, attention_lm.WINDOW, attention_lm.WINDOW + 1, 500])
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    seen = Counter()
    for place, some, skip in attention_lm.windowed(np.zeros(int((lengths + 1).sum())), lengths):
        seen.update((place[:, skip:][some] + 1).tolist())
        if skip:
            assert skip == attention_lm.KEEP
    assert set(seen.values()) == {1} and sorted(seen) == sorted(int(s + 1 + i) for s, n in zip(starts, lengths, strict=True) for i in range(n))


def test_lm_base_and_known(spark, sf):
    got = {r.doc_id: r for r in QUERIES["op6_attention_lm"](spark, sf).collect()}
    docs = table(spark, sf, "documents").collect()
    tokens = {r.doc_id: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")), None] for r in docs}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in tokens}
    counts = Counter(t for k, ts in tokens.items() if not held[k] for t in ts)
    n, v = sum(counts.values()), len(counts)
    for k, ts in tokens.items():
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[k], len(ts), sum(counts[t] > 0 for t in ts), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts), rel_tol=1e-9)
    own, base = (sum(getattr(got[k], c) for k in tokens if held[k]) for c in ("score", "base_score"))
    assert own > base


def test_lm_is_a_distribution(spark, sf):
    """Over all first words of one vocabulary and the end, the mixture's chances sum to no more than one."""
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    docs = ids_and_texts(table(spark, sf, "documents")).where("doc_id % 10 = 0")
    counts = attention_lm.word_counts(docs)
    scorer = attention_lm.fitted(docs, counts, ranks, P.PATTERN)
    scorer.network.ready()
    speller = attention_lm.Speller(ranks, P.PATTERN)
    kinds = [r.word.encode() for r in counts.collect() if r.word != attention_lm.END_WORD][:3000]
    found = scorer.words([[x] for x in speller.spelt(kinds)] + [[]], speller.end)
    assert sum(np.exp(att[0]) for att, _ in found) <= 1.001


def test_lm_edges(spark):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (4, "word " * 3000), (4, "x")], DOCS)
    for training in (F.col("doc_id") > 1, F.lit(False)):
        rows = attention_lm.scored(docs, training, ranks, P.PATTERN).collect()
        assert sorted(r.n_tokens for r in rows) == [1, 1, 2, 3, 3001] and all(math.isfinite(r.score) for r in rows)
        # without training documents N and V are 0, and the base gives every token the chance 1
        assert all(r.score <= 1e-6 if r.train_tokens else r.base_score == 0 for r in rows)
    assert attention_lm.scored(docs.limit(0), F.lit(True), ranks, P.PATTERN).count() == 0


def test_lm_learns_from_a_share_of_every_part(spark):
    """Documents anywhere make classes and move weights; what is learned from grows with them."""
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    kinds = ["river", "castle", "window", "music", "garden", "bridge", "winter", "market"]
    docs = spark.createDataFrame([(i, f"{w} " * 200) for i, w in enumerate(kinds)], DOCS)
    network = attention_lm.fitted(docs, attention_lm.word_counts(docs), ranks, P.PATTERN).network
    first = attention_lm.Network(network.classes, network.begin, network.rows)
    ids = [int(np.frombuffer(x, "<u4")[0]) for x in attention_lm.Speller(ranks, P.PATTERN).spelt([w.encode() for w in kinds])]
    assert len({network.classes[i] for i in ids}) == len(kinds)
    assert all((network.p["e"][network.rows[i]] != first.p["e"][network.rows[i]]).any() for i in ids)
    once = attention_lm.learned(docs, first, ranks, P.PATTERN)
    long = spark.createDataFrame([(i, f"{w} " * 200 * 24) for i, w in enumerate(kinds)], DOCS)
    more = attention_lm.learned(long, first, ranks, P.PATTERN)
    assert once > 0 and math.isclose(more, len(kinds) * 201 * 24 / attention_lm.SHARE, rel_tol=0.05)


def test_runs_cover_each_text_once(monkeypatch):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        speller = attention_lm.Speller(f.read(), P.PATTERN)
    monkeypatch.setattr(attention_lm, "SHARE", 1)
    for n in (0, 1, 23, 24, 25, 48, 100):
        text = " ".join(f"word{i}" for i in range(n)).encode()
        runs = attention_lm.runs_of([5], [text], speller)
        whole = [speller.end, *np.frombuffer(b"".join(speller.spelt(text.split())), "<u4").tolist(), speller.end]
        assert np.concatenate([runs[0][:1], *[r[1:] for r in runs]]).tolist() == whole
        assert all(r[0] == q[-1] for q, r in zip(runs, runs[1:], strict=False))


def test_speller_gives_the_ids_of_each_word():
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        speller = attention_lm.Speller(f.read(), P.PATTERN, most=3000)
    words = ["a", "don't", "it's,", "\u00a0x", "x\u00a0", "\u3000", "\u00a0\u2003", "été", "\U0001f600!!", "--", "x" * 500, "1,234.5", "'s", "\x85", "\x1c"] + [f"w{i}z" for i in range(300)]
    for _ in range(2):
        for part in (words, words[::-1], words[::3]):
            got = speller.spelt([w.encode() for w in part])
            assert [np.frombuffer(x, "<u4").tolist() for x in got] == [speller.coder.encode_ordinary(" " + w) for w in part]
    assert isinstance(speller.coder, tiktoken.Encoding)


def test_lm_score_by_hand(spark, monkeypatch):
    """Scores of short and long texts against loops over single positions: windows, masks, spelling and mixture."""
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    shares, kept, fitted = np.array([0.3, 0.3, 0.4]), {}, attention_lm.fitted
    monkeypatch.setattr(attention_lm, "shares_of", lambda *_: shares)
    monkeypatch.setattr(attention_lm, "fitted", lambda *a: kept.setdefault("scorer", fitted(*a)))
    rng = np.random.default_rng(0)
    vocabulary = ["the", "castle", "of", "winter", "marketplace", "zzyzx", "and", "été", "don't"]
    texts = [" ".join(rng.choice(vocabulary, n)) for n in (0, 1, 3, 9, 40, 150)]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    rows = {r.doc_id: r for r in attention_lm.scored(docs, F.col("doc_id") != 3, ranks, P.PATTERN).collect()}
    scorer, speller = kept["scorer"], attention_lm.Speller(ranks, P.PATTERN)
    net, p = scorer.network, {k: v.astype(float) for k, v in scorer.network.p.items()}
    counts = Counter(t for i, x in enumerate(texts) if i != 3 for t in [*x.split(), None])
    total, kinds = sum(counts.values()), len(counts)
    soft = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()

    def classes_at(ids: list[int]) -> np.ndarray:
        """Chances of the class of the next id, after these (at most one window)."""
        x = np.array([p["e"][net.rows[i]] + p["pos"][k] for k, i in enumerate(ids)])
        weights = soft(np.array([(x[-1] @ p["q"]) @ (y @ p["k"]) / attention_lm.WIDTH**0.5 for y in x]))
        h = x[-1] + sum(w * (y @ p["v"]) for w, y in zip(weights, x, strict=True)) @ p["o"]
        return soft((h + np.maximum(h @ p["w1"] + p["b1"], 0) @ p["w2"]) @ p["out"] + p["bias"])

    for i, text in enumerate(texts):
        words = [*text.split(), None]
        spelt = [[speller.end] if w is None else np.frombuffer(speller.spelt([w.encode()])[0], "<u4").tolist() for w in words]
        ids, score = [speller.end], 0.0

        def after(ids: list[int]) -> np.ndarray:
            n, width, step = len(ids), attention_lm.WINDOW, attention_lm.WINDOW - attention_lm.KEEP
            start = 0 if n <= width else -(-(n - width) // step) * step
            return classes_at(ids[start:])

        for w, own in zip(words, spelt, strict=True):
            log, lift = 0.0, 0.0
            for k, x in enumerate(own):
                chance = after(ids)
                c = net.classes[x]
                log += math.log(chance[c]) + scorer.within[x]
                if k == 0:
                    log -= math.log(chance[: net.begin].sum())
                    lift = math.log(chance[c]) - math.log(chance[: net.begin].sum()) - scorer.usual[c]
                ids.append(x)
            if w is not None:
                log += math.log(after(ids)[: net.begin].sum())
            base = (counts[w] + 1) / (total + kinds + 1)
            score += math.log10(shares[0] * base + shares[1] * base * math.exp(lift) + shares[2] * math.exp(log))
        assert math.isclose(rows[i].score, score, rel_tol=1e-3), (i, rows[i].score, score)


# ---- 5

MAIL = [
    (1, 0, "Where is the old station now?\nI looked for it everywhere today."), (1, 1, "Ann wrote:\n> Where is the old station now?\n\nNear the bridge over there."),
    (1, 2, "> > Where is the old station now?\n> Near the bridge over there.\nThank you very much indeed."), (1, 3, "> I looked for it\n> everywhere today.\nMe too, and found nothing."), (1, 4, "> nobody ever wrote this line\nodd message of mine"),
    (2, 0, "Near the bridge over there."), (2, 1, "> Where is the old station now?\nother conversation altogether"), (1, 5, ">Near the bridge over there.\n>\n>> Where is the old station now?\nlast one of all"), (None, 1, "> Near the bridge over there."), (3, None, None), (3, 1, ""),
]


def test_quotes_are_parsed():
    own, passages = quote_threads.parse("Hi\n\nBob wrote:\n> a\n> > b\n>c\ntail\r\n>> d")
    assert own == "Hi\n\ntail" and passages == [(1, "a"), (2, "b"), (1, "c"), (2, "d")]
    assert quote_threads.parse(None) == ("", []) and quote_threads.parse(">") == ("", [(1, "")])


def test_threads(spark):
    rows = quote_threads.threaded(spark.createDataFrame([(c, t, "user", x) for c, t, x in MAIL], "conv_id long, turn long, role string, text string")).collect()
    got = {(r.conv_id, r.turn): (r.parent_turn, r.root_turn, r.reply_depth) for r in rows}
    assert len(rows) == len(MAIL)
    assert got[1, 0] == (None, 0, 0) and got[1, 1] == (0, 0, 1) and got[1, 2] == (1, 0, 2) and got[1, 4] == (None, 4, 0) and got[1, 5] == (1, 0, 2)
    assert got[2, 1] == (None, 1, 0) and got[None, 1] == (None, 1, 0) and got[3, None] == (None, None, 0)
    assert not any(">" in r.text for r in rows)
    assert {r.text for r in rows if (r.conv_id, r.turn) == (1, 1)} == {"Near the bridge over there."}
    assert quote_threads.threaded(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_long_threads(spark):
    lines = [f"this is the message number {i} of them" for i in range(40)]
    rows = [(7, i, "user", (f"> {lines[i - 1]}\n" if i else "") + lines[i]) for i in range(40)]
    got = quote_threads.threaded(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert all((r.root_turn, r.reply_depth) == (0, r.turn) for r in got)


# ---- 7

URLS = [
    ("http://Sub.Example.NET/en/x?q#f", "sub.example.net", "/en/x", "example.net/en/", "allow"), ("https://a.net", "a.net", "", None, None), ("https://a.net/", "a.net", "/", "net/", "block"), ("x://example.com/de/1#?", "example.com", "/de/1", "example.com/de/", "block"),
    ("http://notexample.com/de/1", "notexample.com", "/de/1", None, None), ("http://w.org/fr/", "w.org", "/fr/", "org/fr/", "allow"), ("http://w.org/fr", "w.org", "/fr", None, None), ("no scheme", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
    ("http://h.net/a://b/c", "h.net", "/a://b/c", "net/", "block"), ("http://h.com?x=/net/", "h.com", "", None, None), ("http://ÀB.net/\nx", "Àb.net", "/\nx", "net/", "block"),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u[0], "x") for i, u in enumerate(URLS)], "page_id long, url string, U_HOST string")
    for r in url_filter.judged(pages).collect():
        _, host, path, rule, verdict = URLS[r.page_id]
        assert (r.u_host, r.u_path, r.u_rule) == (host, path, rule), URLS[r.page_id]
        assert r.u_verdict == verdict if verdict else r.u_verdict in ("allow", "block")
    assert url_filter.judged(pages.limit(0)).count() == 0


def test_url_model_tells_unseen_hosts(spark):
    bad = ["http://mega-casino.test/bonus", "http://cheap-viagra.test/order", "http://xxx-porn.test/free", "http://quick-loans.test/cash"]
    good = ["http://www.library.org/catalogue", "http://news.village.com/2021/07", "http://wiki.gardens.org/page/3", "http://museum.com/exhibits"]
    rows = {r.url: r for r in url_filter.judged(spark.createDataFrame([(u,) for u in bad + good], "url string")).collect()}
    assert all(rows[u].u_verdict == "block" for u in bad) and all(rows[u].u_verdict == "allow" for u in good)


def test_url_filter_stays_native(spark, sf):
    plan = url_filter.op7_url_filter(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# ---- pipeline and SQL


def test_pipeline(spark, sf):
    pipeline = pytest.importorskip("corpus_pipeline")
    from test_text_operators import decontaminated, deduplicated, linked, ruled

    docs = table(spark, sf, "documents").collect()
    verdict = {r.doc_id: r.kept for r in QUERIES["op10_quality_rules"](spark, sf).collect()}
    assert all(not ruled(r.text)[-1] for r in docs if verdict[r.doc_id])
    rows = [(r.doc_id, r.text) for r in docs if verdict[r.doc_id]]
    rows = [(k, t) for k, t in rows if linked(rows, 80)[k][1] == k] if len(rows) < 40 else [(k, t) for (k, t), c in ((x, roots[x[0]][1]) for roots in [linked(rows, 80)] for x in rows) if k == c]
    texts = {k: (t if not gone else left) for (k, t), (_, gone, left) in ((x, deduplicated(rows)[x[0]]) for x in [])} or {}
    done = deduplicated(rows)
    texts = {k: done[k][2] if done[k][1] else t for k, t in rows}
    hits = decontaminated([(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()], texts.items())
    tiktoken = pytest.importorskip("tiktoken")
    from braidwork.llm import byte_bpe

    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=dict(byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))), special_tokens={})
    got = {r.doc_id: r for r in pipeline.run(spark, sf).collect()}
    assert set(got) == set(texts)
    assert all(got[k].ids == coder.encode_ordinary(t) for k, t in texts.items() if not hits[k][1])
    assert all(len(got[k].ids) < len(coder.encode_ordinary(t)) for k, t in texts.items() if hits[k][1])


def test_pipeline_edges(spark, sf):
    pipeline = pytest.importorskip("corpus_pipeline")
    kind = "doc_id long, text string, lang string, source string, n_chars long, q_words int, _words string, node long, ids int"
    good = {r.doc_id for r in QUERIES["op10_quality_rules"](spark, sf).where("kept AND n_words < 300").collect()}
    long = next(r.text for r in table(spark, sf, "documents").orderBy("doc_id").collect() if r.doc_id in good)
    rows = [(1, long, None, None, None, 1, "a", 2, 3), (1, long, None, None, None, 1, "a", 2, 3), (None, long, "en", "s", 5, None, None, None, None), (2, None, None, None, None, None, None, None, None), (3, "", "en", "s", 0, 1, "b", 2, 3)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, kind)
        columns = docs.columns
        for _, stage in pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            assert docs.columns == columns
        out = pipeline.STAGES[-1][1](spark, docs, sf).collect()
        assert sorted(str(r.doc_id) for r in out) == (["1", "None"] if some else [])


@pytest.mark.parametrize("name", sorted(k for k, v in ORACLES.items() if v))
def test_against_sql(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    cursor = con.execute(ORACLES[name])
    names = sorted(d[0] for d in cursor.description)
    wanted = [dict(zip([d[0] for d in cursor.description], r, strict=True)) for r in cursor.fetchall()]
    out = QUERIES[name](spark, sf)
    assert sorted(out.columns) == names
    cells = lambda rows: sorted(tuple(str(r[n]) for n in names) for r in rows)
    assert cells([r.asDict() for r in out.collect()]) == cells(wanted)
