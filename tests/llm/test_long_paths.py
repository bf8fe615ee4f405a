"""Listed paths of any length are looked up."""

from __future__ import annotations

from siltbed.llm.url_filter import filter_urls


def test_long_listed_paths_match(spark):
    paths = ["/" + "p" * n for n in (4095, 4096, 4097, 9000)]
    pages = spark.createDataFrame([(i, f"x://a.org{p}/end") for i, p in enumerate(paths)], "page_id long, url string")
    for path in paths:
        entries = spark.createDataFrame(
            [("a.org", path, "block", False)], "host string, path string, verdict string, is_rule boolean"
        )
        want = ["block" if f"{p}/end".startswith(path) else "allow" for p in paths]
        assert [r.verdict for r in filter_urls(pages, entries).orderBy("page_id").collect()] == want
