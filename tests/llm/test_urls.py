import re
from itertools import combinations, product

from rillmark.llm import urls
from rillmark.llm.urls import RULES, filter_urls, mined_rules

URLS = [
    None, "", "no scheme", "http://", "https://A.Example.NET/en/1?x=/de/", "http://net", "http://net/", "http://sub.net/x#y", "http://notnet/x", "http://xnet.com/",
    "ftp://example.com/de/", "ftp://example.com/DE/", "http://a.b.example.com/de/x", "http://badexample.com/de/x", "http://w.org/fr/1.html", "http://org/fr/", "http://org/fr",
    "http://x.org?u=http://net/", "https://example.net/en/", "https://example.net/en", "http://é.ÉX.net/ü?q#f", "a://b://net/", "http://h.com\n/de/?a=1&b=2", "http://net:80/",
]


def parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), m[2]) if m else ("", "")


def rule_of(url):
    host, path = parts(url)
    fit = [(r, v) for r, v in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fit, key=lambda r: len(r[0]), default=(None, None))


def pages(spark, rows):
    return spark.createDataFrame([(k, u, "<p>", "x") for k, u in rows], "page_id bigint, url string, html string, verdict string").repartition(3)


def labels(spark, rows):
    return spark.createDataFrame([(k, q, t) for k, q, t in rows], "doc_id bigint, quality int, toxic int")


def test_parts_and_fixed_rules(spark):
    rows = list(enumerate(URLS))
    found = {r["page_id"]: r for r in filter_urls(pages(spark, rows), labels(spark, [])).collect()}
    for k, url in rows:
        rule, verdict = rule_of(url)
        assert (found[k]["host"], found[k]["path"], found[k]["rule"]) == (*parts(url), rule), url
        assert found[k]["verdict"] == (verdict or "allow")


def test_mined_rules_equal_brute_force(spark):
    sets = [["a", "b"], ["a", "b", "c"], ["a", "c"], ["b", "c"], ["a"], ["d", "b"], ["d"], ["c", "d", "a"]] * 8
    marks = ["block" if "a" in s and ("b" in s or "c" in s) else "allow" for s in sets]
    marks[0] = marks[8] = "allow"
    got = {tuple(sorted(r["tokens"])): (r["support"], r["confidence"]) for r in mined_rules(spark.createDataFrame(list(zip(sets, marks)), "tokens array<string>, label string"), 0.05, 0.7).collect()}
    every = {}
    for k in range(1, 5):
        for items in combinations("abcd", k):
            hit = [m for s, m in zip(sets, marks) if set(items) <= set(s)]
            both = hit.count("block")
            if len(hit) and both >= urls.LEAST and both >= 0.05 * len(sets) and both / len(hit) >= 0.7:
                every[items] = (both / len(sets), both / len(hit))
    kept = {i: v for i, v in every.items() if not any(set(j) < set(i) and len(j) == len(i) - 1 and every[j][1] >= v[1] for j in every)}
    assert got == kept and got


def test_tokens_that_stand_together_are_one(spark):
    """Rules with classes, expanded, are the rules over all tokens; and they block the same URLs."""
    sets = [["a", "A", "b"], ["a", "A", "b", "c", "C"], ["a", "A", "c", "C"], ["b", "c", "C"], ["a", "A"], ["d", "b"], ["d"], ["c", "C", "d", "a", "A"]] * 8
    marks = ["block" if "a" in s and ("b" in s or "c" in s) else "allow" for s in sets]
    marks[0] = marks[8] = "allow"
    rules = mined_rules(spark.createDataFrame(list(zip(sets, marks)), "tokens array<string>, label string"), 0.05, 0.7)
    got = {tuple(sorted(one)): (r["support"], r["confidence"]) for r in rules.collect() for one in product(*r["members"])}
    every = {}
    for k in range(1, 5):
        for items in combinations("aAbcCd", k):
            hit = [m for s, m in zip(sets, marks) if set(items) <= set(s)]
            both = hit.count("block")
            if len(hit) and both >= urls.LEAST and both >= 0.05 * len(sets) and both / len(hit) >= 0.7:
                every[tuple(sorted(items))] = (both / len(sets), both / len(hit))
    kept = {i: v for i, v in every.items() if not any(set(j) < set(i) and len(j) == len(i) - 1 and every[j][1] >= v[1] for j in every)}
    assert got == kept and any({"A", "C"} == set(i) for i in got)
    asked = [list(items) for k in range(1, 4) for items in combinations("aAbcCd", k)]
    frame = spark.createDataFrame([("".join(t), t) for t in asked], "url string, tokens array<string>")
    blocked = {r["url"] for r in urls.blocked_urls(frame, rules).collect()}
    assert blocked == {"".join(t) for t in asked if any(set(i) <= set(t) for i in kept)}


def test_a_deep_path_ends(spark):
    """Forty segments that always stand together: subsets of them are not listed."""
    deep = "/".join(f"s{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40))
    rows = [(k, f"http://bad.com/{deep}/{k}" if k < 30 else f"http://good{k % 7}.org/x/{k}") for k in range(230)]
    found = filter_urls(pages(spark, rows), labels(spark, [(k, int(k >= 30), 0) for k in range(230)])).collect()
    assert all(r["verdict"] == ("block" if r["page_id"] < 30 else "allow") for r in found)


def test_labels_make_rules_for_other_pages(spark):
    rows = [(k, f"http://{'bad' if k % 2 else 'good'}.site{k % 5}.com/en/{k}") for k in range(200)]
    judged = labels(spark, [(k, 0 if k % 2 else 1, None) for k in range(150)])
    found = filter_urls(pages(spark, rows), judged).collect()
    assert all(r["verdict"] == ("block" if r["page_id"] % 2 else "allow") for r in found)
    assert {r["mined"] for r in found if r["page_id"] % 2} == {"sub=bad"}


def test_edges(spark, monkeypatch):
    assert filter_urls(pages(spark, []), labels(spark, [])).count() == 0
    rows = [(None, None), (1, "http://a.net/x"), (1, "http://a.net/x"), (1, "http://b.com/")]
    found = filter_urls(pages(spark, rows), labels(spark, [(1, None, 1), (1, 1, 0), (None, 0, 1)])).collect()
    assert sorted((r["page_id"] or 0, r["host"], r["verdict"]) for r in found) == [(0, "", "allow"), (1, "a.net", "block"), (1, "a.net", "block"), (1, "b.com", "allow")]
    monkeypatch.setattr(urls, "BROADCAST_RULES", 0)
    test_labels_make_rules_for_other_pages(spark)


def test_plan_has_no_python(spark):
    text = filter_urls(pages(spark, [(1, "http://a.com/")]), labels(spark, []))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)
