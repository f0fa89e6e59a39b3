"""Lookups among URLs that share a long path."""

from __future__ import annotations

from skyloom.llm import warc


def test_long_common_paths_are_told_apart(spark):
    path = "http://a.org/" + "x" * 300
    rows = [(i, f"{path}/{i // 2:04d}", f"page {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    p = warc.Warc(block_lines=5)
    archive = warc.build(df, p)
    firsts = sorted((r["shard"], r["block"], r["first"]) for r in archive.directory.collect())
    assert len({f for *_, f in firsts}) > 30  # a block for each few URLs, not one entry for all
    wanted = spark.createDataFrame([(f"{path}/0007",), (f"{path}/0099",), (f"{path}/0100",)], "url string")
    assert sorted(r.page_id for r in warc.captures(wanted, archive, p).collect()) == [14, 15, 198, 199]


def test_parting():
    assert [warc._parting(*x) for x in ((None, "abc"), ("abc", "abc"), ("abc", "abd"), ("ab", "abcd"), ("a", "b"), ("", "xyz"))] == ["abc", "abc", "abd", "abc", "b", "x"]
