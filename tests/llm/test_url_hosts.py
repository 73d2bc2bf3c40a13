"""The registered name of ordinary hosts takes part in the model's verdict."""

import pytest

from braidwork.llm import url_filter

BAD = ["casino-win", "porn-tube", "cheap-viagra"]
GOOD = ["garden-museum", "city-library", "weather-journal"]


@pytest.mark.parametrize("host", ["{}.com", "www.{}.com", "m.{}.net", "www.{}.org"])
def test_name_of_host_counts(spark, host):
    urls = [(f"http://{host.format(n)}/", n in BAD) for n in BAD + GOOD]
    rows = {r.url: r for r in url_filter.judged(spark.createDataFrame(urls, "url string, bad boolean"), rules=()).collect()}
    assert {u: rows[u].u_verdict for u, _ in urls} == {u: "block" if bad else "allow" for u, bad in urls}


def test_threshold_comes_from_held_out_labels(spark):
    found = url_filter.held_out_errors(spark)
    missed = {k: sum(p < k / 20 for p, y in found if y) for k in range(21)}
    assert url_filter.BLOCK_AT == max(k for k, n in missed.items() if 5 * n <= sum(y for _, y in found)) / 20
