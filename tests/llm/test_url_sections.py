"""Sections of a large branch and deep segments keep templates of their own."""

from __future__ import annotations

from kestrel.llm import url_filter


def test_small_shares_and_deep_sections_stay_apart(spark):
    urls = ["http://b.example.com/de/%d" % i for i in range(4)] + ["http://b.example.com/it/%d" % i for i in range(3)]
    urls += ["http://b.example.com/fr/%d" % i for i in range(93)]
    # 60 sections of 30 urls, 1.7 % each: every third one is bad
    urls += ["http://big.example/%s/%d" % ("".join(chr(97 + int(c)) for c in "%02d" % s), i) for s in range(60) for i in range(30)]
    # sections apart at the eighth segment only
    urls += ["http://deep.example/a/b/c/d/e/f/g/%s/%d" % (("good", "bad")[i % 2], i) for i in range(60)]
    label = {}
    for i, u in enumerate(urls):
        if "com/de/" in u:
            label[i] = 0
        elif "big." in u and i % 2:
            label[i] = int((i - 100) // 30 % 3 > 0)
        elif "deep." in u and i % 4 < 2:
            label[i] = int("/good/" in u)
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["id"]: r for r in url_filter.judge_urls(pages, rules=(), labels=spark.createDataFrame(list(label.items()), "id long, label int")).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        bad = "com/de/" in u or "/bad/" in u or ("big." in u and (i - 100) // 30 % 3 == 0)
        assert got[i]["verdict"] == ("block" if bad else "allow"), u
    big = {r["template"] for r in got.values() if r["host"] == "big.example"}
    assert len(big) == 2 and any("|+19/" in t for t in big)
