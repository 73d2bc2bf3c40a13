"""Odd redirects that targets come across."""

from braidwork.operators import resolve as R


def test_only_targets_that_name_an_odd_redirect_are_resolved(spark):
    frame = spark.createDataFrame
    # l: only its capitalised form is odd; m: that too, but m redirects to a title; T: no redirect; Best L: found later, L plays no part
    links = frame([("en", "T", t) for t in ("L", "l", "m", "T", "Best L")], "lang string, title string, target string")
    labels = frame([("en", "T", "Q1"), ("best", "Best L", "Q2")], "lang string, label string, qid string")
    redirects = frame([("en", "L", "L"), ("en", "M", "M"), ("en", "m", "T"), ("en", "Unmet", "Unmet")], "lang string, title string, target string")
    media = frame([], "filename string")
    _, odd = R.resolve(links, labels, redirects, media)
    assert [tuple(r) for r in odd.collect()] == [("en", "L", "cycle")]
    # the candidates of targets are made once, not for each of the two titles
    assert odd._jdf.queryExecution().optimizedPlan().toString().count("min(struct(rank") == 1
    _, odd = R.resolve(links.where("target = 'l'"), labels, redirects, media)
    assert [tuple(r) for r in odd.collect()] == [("en", "L", "cycle")]
    _, odd = R.resolve(links.where("target = 'm'"), labels, redirects, media)
    assert odd.count() == 0
