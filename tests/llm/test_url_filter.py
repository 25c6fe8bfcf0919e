import re

from pyspark.sql import functions as F

from clickscope.llm import url_filter as U

URLS = [
    (1, None), (2, ""), (3, "no-scheme.org/es/"), (4, "http://EXAMPLE.org/es/x?q#f"), (5, "https://a.b.example.org/en/12"),
    (6, "http://example.org/en/2"), (7, "http://notexample.org.com/de/"), (8, "x://shop.com/fr/1"), (9, "http://com/de/"),
    (10, "http://www.cheap-pills.example.net/x"), (11, "http://cheap-pills.example.net"), (11, "http://cheap-pills.example.net"),
    (None, "http://pills.net/a://b"), (12, "http://spammer.net/"), (13, "http://" + "a" * 5000 + ".net/" + "p" * 100_000),
    (14, "://?x"), (15, "http://org"), (16, "http://net.org/\n/es"),
]


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = m[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) if m else ""
    path = m[2] if m else ""
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    listed = any(w in U.LISTED_WORDS for label in host.split(".") for w in label.split("-"))
    rule = max(fits)[1:] if fits else (None, "block" if listed else "allow")
    return host, path, rule[0], rule[1], listed


def test_every_url_like_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in URLS], "page_id bigint, url string, host string")
    got = [tuple(r) for r in U.judge_urls(pages).collect()]
    assert sorted(got, key=str) == sorted([(i, *brute(u)) for i, u in URLS], key=str)


def test_a_list_of_domains_and_hosts_with_paths(spark):
    urls = ["http://a.net/x", "http://sub.A.net/y?q", "http://b.net/x", "http://b.net/x/y", "http://www.b.net/x", "http://c.net", None,
            "http://d.org/es/", "http://example.org/es/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    listed = spark.createDataFrame([("A.net",), ("b.net/x",), ("b.net/x",), (None,), ("unseen.net",), ("C.net/",), ("d.org",)], "host string")
    got = {r.id: (r.verdict, r.listed) for r in U.judge_urls(pages, listed=listed).collect()}
    hit = {0, 1, 2, 7}
    assert {i for i, (_, ok) in got.items() if ok} == hit
    assert {i for i, (verdict, _) in got.items() if verdict == "block"} == {0, 1, 2, 8}  # a rule comes before the list
    assert not any(ok for _, ok in ((r.verdict, r.listed) for r in U.judge_urls(pages, listed=listed.limit(0)).collect()))


def test_empty_table(spark):
    assert U.judge_urls(spark.createDataFrame([], "page_id bigint, url string")).collect() == []


def test_membership_is_exact_over_the_universe_also_in_groups(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("key"), "id").alias("key"), (F.col("id") % 11 == 0).alias("truth"))
    listed = keys.where("truth").select("key")
    for bound in (U.MAX_BROADCAST, 800):
        cascades = U.build_cascades(listed.unionByName(listed), keys.select("key"), bound)
        assert (len(cascades) > 1) == (bound == 800)
        flagged = U.flag_listed(keys, F.array("key"), cascades, "hit")
        assert flagged.where("hit != truth").count() == 0


def test_nothing_and_everything_listed(spark):
    keys = spark.range(500).select(F.col("id").cast("string").alias("key"))
    for listed, answer in ((keys.limit(0), False), (keys, True)):
        flagged = U.flag_listed(keys, F.array("key"), U.build_cascades(listed, keys), "hit")
        assert {r["hit"] for r in flagged.collect()} == {answer}


def test_longest_rule_wins(spark):
    rules = (("allow", "org", "/"), ("block", "x.org", "/"), ("allow", "x.org", "/a/b"), ("block", "x.org", "/a"))
    df = spark.createDataFrame([("y.x.org", "/a/b/c"), ("x.org", "/a"), ("x.org", "/"), ("z.org", "/a"), ("org", "")], "h string, p string")
    got = [tuple(r) for r in df.select(U.matching_rule(F.col("h"), F.col("p"), rules).alias("r")).select("r.*").collect()]
    assert got == [("x.org/a/b", "allow"), ("x.org/a", "block"), ("x.org/", "block"), ("org/", "allow"), (None, None)]
