from __future__ import annotations

import re

from tarmac.llm import queries, urls

SCHEMA = "page_id bigint, url string"


def brute_force(url):
    """host, path, rule, verdict and pattern rule by trying every rule."""
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1], found[2]) if found else ("", "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best, own = None, None
    for rule in urls.HOST_RULES + urls.PATTERN_RULES:
        if not host or not re.search(rule.pattern, host + path):
            continue
        if rule.is_host_rule:
            best = max([best, rule], key=lambda r: (len(r.name), r.name) if r else (0, ""))
        else:
            own = min(own or rule.name, rule.name)
    verdict = best.verdict if best else "block" if own else "allow"
    return host, path, best.name if best else None, verdict, own


ODD = [
    None, "", "no scheme", "http://", "http:///en/", "http://net", "http://net/", "HTTP://A.NET/x", "http://annet/x",
    "http://x.example.net/en/a", "http://example.net/en", "http://notexample.net/en/", "http://example.net/EN/",
    "https://example.com/de/1?x=/fr/", "https://www.example.com/de", "ftp://a.org/fr/#top", "http://org/fr/x",
    "http://a.org?x/fr/", "x://y://z.net/", "http://a.net:80/", "http://user@a.net/", "http://cheap-pills.com/",
    "http://mycheap-pills.com/", "http://a.cheap_pills.b.de", "http://a.de/b/c.exe", "http://a.de/c.exe?x", "http://a.de/x;jsessionid=3",
    "http://casino.net/en/", "http://CASINO.org/fr/a", "http://a\nb.net/\n", "http://é.net/é", "http://example.net/en/" + "x" * 100_000,
]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_addresses_equal_brute_force(frame):
    rows = [(i, u, "h") for i, u in enumerate(ODD)] + [(3, "http://", "h"), (None, "http://b.net/", "h")]
    df = urls.judge(frame(rows, SCHEMA + ", host string"))
    assert found(df) == sorted(((i, *brute_force(u)) for i, u, _ in rows), key=repr)


def test_given_pages_equal_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
    expected = sorted(((i, *brute_force(u)) for i, u in pages), key=repr)
    assert found(queries.queries()["op7_url_filter"](spark, sf)) == expected


def test_rules_are_filed_under_their_rarest_token(frame, spark):
    docs = frame([(["common", "rare"],), (["common"],), (["common"],)], "url_tokens array<string>")
    rule = urls.Rule("r", "block", "x", ("common", "rare"), False)
    never = urls.Rule("n", "block", "x", ("common", "absent"), False)
    index = urls.rule_index(docs, urls._rules_table(spark, [rule, never]))
    assert {r["name"]: r["filed_under"] for r in index.collect()} == {"r": "rare", "n": "absent"}


def test_no_python_in_the_plan_and_empty_table(frame, spark):
    df = urls.judge(frame([(1, "http://a.net/")], SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert urls.judge(spark.createDataFrame([], SCHEMA)).collect() == []
