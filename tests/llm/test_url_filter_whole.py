"""The models count every labelled row and read the whole url."""

import math

from tests.llm.test_url_filter import brute_ratios

from scorecast.llm import url_filter as U

RULES = [("allow", "good.com/"), ("block", "bad.net/")]


def scores(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r["url"]: r for r in U.filter_urls(df, RULES).collect()}


def check(got, urls):
    ratio = brute_ratios([(u, int("good.com/" in u), int("bad.net/" in u)) for u in urls])
    for u, r in got.items():
        s = U.START * U.ORDER + u + U.END
        windows = [s[i - U.ORDER:i + 1] for i in range(U.ORDER, len(s))]
        assert math.isclose(r["llr"], sum(map(ratio, windows)) / len(windows), rel_tol=1e-9, abs_tol=1e-9), u


def test_all_labelled_rows_are_counted(spark):
    urls = [f"https://good.com/p/{i}?ref=home#top{i % 3}" for i in range(20)] + [f"http://bad.net/p/{i * 37}?ad=casino" for i in range(20)]
    urls += ["http://n.org/p/1?ad=casino", "http://n.org/p/1?ref=home", "http://n.org/p/2", "no scheme casino", "other scheme home"]
    got = scores(spark, urls)
    check(got, urls)
    assert got["http://n.org/p/1?ad=casino"]["llr"] > got["http://n.org/p/1?ref=home"]["llr"]
    assert got["no scheme casino"]["llr"] != got["other scheme home"]["llr"]


def test_one_url_holds_a_class(spark):
    for n in range(3):  # whichever fold it falls in
        urls = [f"http://good.com/page/{i}" for i in range(20)] + [f"http://bad.net/casino{n}"] * 20 + [f"http://new.net/casino{n}"]
        got = scores(spark, urls)
        assert got[urls[-1]]["llr"] > 0 and got[urls[-1]]["verdict"] == "block"
        if n == 0:
            check(got, urls)
