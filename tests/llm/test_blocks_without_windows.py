"""Substring deduplication where a block has no window, or none that occurs twice, as the last block of a scan task often has."""

import numpy as np

from braidwork.llm import substring_dedup

DOCS = "doc_id long, text string"


def test_nothing_is_dealt_of_nothing():
    none = np.zeros(0, np.uint64)
    assert list(substring_dedup._dealt(none, none, 4)) == []


def test_blocks_of_short_or_single_texts(spark):
    twice = " ".join(f"w{i}" for i in range(25))
    rows = [[(1, "too short"), (2, None)], [(3, ""), (4, " ".join(f"x{i}" for i in range(30)))], [(5, twice)], [(6, twice + " end")]]
    docs = spark.createDataFrame([r for part in rows[:1] for r in part], DOCS).coalesce(1)
    for part in rows[1:]:
        docs = docs.unionByName(spark.createDataFrame(part, DOCS).coalesce(1))
    got = {r.doc_id: (r._words, r._removed) for r in substring_dedup.deduplicated(docs).collect()}
    assert got == {1: (2, 0), 2: (0, 0), 3: (0, 0), 4: (30, 0), 5: (25, 0), 6: (26, 25)}
    only = docs.where("doc_id < 4")
    assert {r.doc_id: r.text for r in substring_dedup.kept(only).collect()} == {1: "too short", 2: None, 3: ""}
