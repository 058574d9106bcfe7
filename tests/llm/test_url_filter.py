"""Rules against brute force; the trees' verdicts; edges."""

import re

from pyspark.sql import functions as F

from tessera.llm import url_filter
from tessera.llm.queries import op5_url_filter

MEDIUM = "/root/testdata/sf0.01"
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/")]
URLS = [None, "", "no scheme", "http://A.NET/x", "http://net", "http://net/", "https://x.example.net/en/1",
        "https://x.example.net/en", "http://myexample.com/de/1", "http://example.com/de/1?q=://b.net/",
        "ftp://a.org/fr/#x", "http://b.org/FR/", "://net/a", "http://ÄB.net/", "http://u@h.net:80/p",
        "http://x.com/" + "a/" * 3000, "http://example.org/en/?a=1&b=2", "http://line\nbreak.net/a\nb?c",
        "http://?q", "http://#f"]


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fit, key=lambda r: len(r[0])) if fit else (None, None)
    return host, path, rule, verdict


def check(rows):
    for r in rows:
        host, path, rule, verdict = brute(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
        assert 0 <= r.score <= 1


def test_edges(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    out = url_filter.judge(df.withColumn("host", F.lit("mine")).withColumn("label", F.lit(7)))
    rows = out.join(df, "page_id").collect()
    assert len(rows) == len(URLS)
    check(rows)


def test_query_on_table(spark):
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet").select("page_id", "url")
    rows = op5_url_filter(spark, MEDIUM).join(pages, "page_id").collect()
    assert len(rows) == pages.count()
    check(rows)


def test_trees_learn_from_the_labels(spark):
    """Hosts without a rule that look like the blocked ones are blocked."""
    rows = [(i, f"http://h{i}.net/{'9' * 12}{i}?a=1&b=2&c=3") for i in range(200)]
    rows += [(1000 + i, f"http://h{i}.org/fr/page/{chr(97 + i % 26)}") for i in range(200)]
    rows += [(5000, "http://other.info/888888888888?a=1&b=2&c=3"), (5001, "http://other.org/de/page/x")]
    got = {r.page_id: r.verdict for r in url_filter.judge(
        spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[5000] == "block" and got[5001] == "allow"


def test_labels_of_one_kind_and_none(spark):
    def run(urls):
        return [r.verdict for r in url_filter.judge(
            spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))
            .orderBy("page_id").collect()]
    assert run(["http://a.net/", "http://b.com/x"]) == ["block", "block"]
    assert run(["http://a.org/fr/", "http://b.com/x"]) == ["allow", "allow"]
    assert run(["http://b.com/x", None]) == ["allow", "allow"] and run([]) == []


def test_repeated_rows_are_kept(spark):
    df = spark.createDataFrame([(1, "http://a.net/")] * 3 + [(None, "http://a.org/fr/")],
                               "page_id long, url string")
    assert url_filter.judge(df).count() == 4


def test_suffix_rates_leave_the_own_fold_out(spark):
    """Against plain counting; a URL's own copies never enter its rates."""
    urls = [f"http://h{i % 7}.org/{i % 3}" for i in range(40)] * 2
    rows = [(u, 1.0 if i % 4 == 0 else 0.0 if i % 4 == 1 else None) for i, u in enumerate(urls)]
    df = (spark.createDataFrame(rows, "url string, label double")
          .withColumns({"domain": F.substring_index(F.col("url"), "/", 3), "fold": url_filter.fold(F.col("url"))}))
    got = df.join(url_filter.suffix_rates(df.where("label IS NOT NULL"), "domain"), "domain", "left").select(
        "url", "domain", "label", "fold", url_filter.rate_of("domain", 0.25)).collect()
    assert len(got) == len(rows) and len({r.fold for r in got}) > 1
    for r in got:
        seen = [x.label for x in got if x.domain == r.domain and x.label is not None
                and (r.label is None or x.fold != r.fold)]
        assert abs(r.domain_rate - (sum(seen) + 2.5) / (len(seen) + 10)) < 1e-12


def test_held_out_verdicts(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = {r.verdict: (r.n, r.correct) for r in url_filter.held_out(pages).collect()}
    assert set(got) == {"allow", "block"} and sum(n for n, _ in got.values()) > 100
    for n, correct in got.values():
        assert correct > 0.9 * n, got
    assert url_filter.held_out(pages.where("page_id < 0")).collect() == []
