"""URL rules and list against plain Python; the Bloom filter's one-sided error."""

import random
import re

from pyspark.sql import functions as F

from tamiz.llm import url_filter
from tamiz.llm.queries import RULES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return host.translate(str.maketrans(url_filter.UPPER, url_filter.LOWER)), path


TRACKING = {"gclid", "dclid", "fbclid", "msclkid", "yclid", "mc_cid", "mc_eid", "igshid"}


def canon(url):
    host, path = parts(url)
    if not host:
        return None
    rest = url.split("://", 1)[1].split("#")[0]
    query = rest.split("?", 1)[1].split("&") if "?" in rest else []
    kept = sorted(x for x in query if x and x.split("=")[0] not in TRACKING and not x.split("=")[0].startswith("utm_"))
    host = re.sub(r":(80|443)?$", "", re.sub(r"^www\.", "", host))
    return host + re.sub(r"(\.html)?/*$", "", path, count=1) + ("?" + "&".join(kept) if kept else "")


def brute(pages, listed, rules=RULES):
    block = {canon(u) for u in listed} - {None}
    out = []
    for i, url in pages:
        host, path = parts(url)
        fits = [(len(h + p), -k, h + p, v) for k, (h, p, v) in enumerate(rules) if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[2:] if fits else (None, "block" if canon(url) in block else "allow")
        out.append((i, host, path, rule, verdict))
    return sorted(out, key=repr)


def test_against_plain_python(spark):
    rnd = random.Random(2)
    hosts = ["example.com", "WWW.Example.com", "a.example.com", "notexample.com", "x.net", "net", "b.org", "www.b.org", "com", "É.org", "", "b.org:80", "www.b.org:443", "b.org:8080", "b.org:"]
    paths = ["", "/", "/en", "/en/", "/EN/1", "/es/2.html", "/fr/3/", "/de//", "/q.html/", "/es/2"]
    tails = ["", "?a=b", "#x", "?u=http://c.com/en/", "/x?y#z", "?utm_source=f", "?b=1&a=2&gclid=q", "?a=2&&b=1#?c"]
    urls = [f"http{rnd.choice(['', 's'])}://{h}{p}{rnd.choice(tails)}" for h in hosts for p in paths]
    pages = list(enumerate(urls)) + [(900, None), (901, ""), (902, "b.org/x"), (903, "://"), (904, "a://b://c"), (None, urls[70]), (5, urls[5]),
                                     (905, "http://b.org/" + "x" * 100_000), (906, "http://b.org/line\nbreak?q")]
    listed = [u for _, u in pages if rnd.random() < 0.3] + [None, "", "nothing", urls[3], urls[3]]
    got = url_filter.judge(
        spark.createDataFrame([(i, u, "c") for i, u in pages], "page_id long, url string, verdict string"),
        spark.createDataFrame([(u, 1) for u in listed], "url string, canon int"), RULES)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(pages, listed)
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty, empty, RULES).count() == 0
    alone = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string"), empty.select("url"), RULES)
    assert sorted(map(tuple, alone.collect()), key=repr) == brute(pages, [])


def test_canonical_forms():
    assert canon("http://a.org/item?id=1") != canon("http://a.org/item?id=2")
    assert canon("http://www.a.org:80/x.html?utm_source=f&b=2&a=1#z") == canon("https://a.org/x?a=1&b=2")


def test_thousands_of_rules(spark):
    """More rules than any expression holds, several for one host and path, and equally long ones."""
    rnd = random.Random(6)
    hosts = [f"h{i}.{z}" for i in range(150) for z in ("com", "org")]
    rules = [(rnd.choice(hosts), "/" + "".join(rnd.choice("ab/") for _ in range(rnd.randrange(6))), rnd.choice(["allow", "block"])) for _ in range(5000)]
    rules += [("com", "/", "block"), ("com", "/", "allow"), ("x.h1.com", "/a", "allow"), ("h1.com", "/a/a", "block"), ("h1.com", "/aab", "allow")]
    pages = [(i, f"http://{rnd.choice(['', '', 'x.', 'www.'])}{rnd.choice(hosts)}/{''.join(rnd.choice('ab/') for _ in range(rnd.randrange(9)))}") for i in range(1500)]
    frame = spark.createDataFrame(pages, "page_id long, url string")
    got = url_filter.judge(frame, frame.where("page_id % 5 = 0").select("url"), rules)
    want = brute(pages, [u for i, u in pages if i % 5 == 0], rules)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(r[3] is not None for r in want) > 900
    table = url_filter.rules_table(spark, rules)
    assert sorted(map(tuple, url_filter.judge(frame, frame.limit(0).select("url"), table).collect()), key=repr) == brute(pages, [], rules)


def test_filter_passes_all_listed_and_few_others(spark):
    listed = spark.range(5000).select(F.concat(F.lit("h/"), "id").alias("canon"))
    blocks = url_filter.block_count(5000)
    table = url_filter.bloom(listed, blocks)
    other = spark.range(20_000).select(F.concat(F.lit("o/"), "id").alias("canon"))
    assert url_filter.possible(listed, table, blocks).count() == 5000
    assert url_filter.possible(other, table, blocks).count() < 20_000 * 0.03
