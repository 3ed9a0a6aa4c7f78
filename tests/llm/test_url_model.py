import math
import random
import re
import zlib
from collections import Counter

import pytest

from deckspark.llm.queries import URL_RULES
from deckspark.llm.url_model import BIN, MOST_BIN, judge_urls, rule

from .oracle import assert_equals_sql

RULES = [rule(*r) for r in URL_RULES]
HOSTS = ["org", "a.org", "x.example.org", "example.org", "EXAMPLE.org", "b.com", "com", "shop.net", "ads.net", "xorg", "org.", "a.org:80"]
PATHS = ["", "/", "/es/1", "/en/12", "/en/2", "/fr/buy", "/de/x", "/fr", "/Es/", "?q=/es/", "#/de/"]


def by_hand(urls, order=4):
    """(host, path, rule, verdict) of each url, by direct recursion."""
    out, learn, fold = {}, {"allow": Counter(), "block": Counter()}, []
    for url, n in Counter(urls).items():
        text = url or ""
        rest = text.split("://", 1)[1] if "://" in text else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.text)) if fits else None
        out[url] = [host, path, best and best.text, best and best.verdict]
        held = zlib.crc32(text.encode()) % 4 == 2
        if best and held:
            fold.append((text, n, best.verdict))
        elif best:
            s = "\2" * order + text + "\3"
            for i in range(order, len(s)):
                for k in range(order + 1):
                    learn[best.verdict][s[i - k : i + 1]] += n
    total, kinds = {v: Counter() for v in learn}, {v: Counter() for v in learn}
    for v, grams in learn.items():
        for g, n in grams.items():
            total[v][g[:-1]] += n
            kinds[v][g[:-1]] += 1

    def p(v, gram):
        if not gram:
            return 1 / 0x110000
        c = gram[:-1]
        if not total[v][c]:
            return p(v, gram[1:])
        return (learn[v][gram] + kinds[v][c] * p(v, gram[1:])) / (total[v][c] + kinds[v][c])

    def bin_of(text):
        s = "\2" * order + text + "\3"
        each = [math.log(p("allow", s[i - order : i + 1])) - math.log(p("block", s[i - order : i + 1])) for i in range(order, len(s))]
        return max(-MOST_BIN, min(MOST_BIN, math.floor(round(sum(each) / len(each), 9) / BIN)))

    marked = [(bin_of(t), n, v) for t, n, v in fold]
    good, bad = (sum(n for _, n, w in marked if w == v) for v in ("allow", "block"))
    cut = 0
    if good and bad:
        cuts = {0} | {b for b, _, _ in marked} | {b + 1 for b, _, _ in marked}
        lost = lambda c: sum(n for b, n, v in marked if v == "allow" and b < c) * bad + sum(n for b, n, v in marked if v == "block" and b >= c) * good
        cut = min(cuts, key=lambda c: (lost(c), abs(c), c))
    for url in out:
        if out[url][3] is None:
            out[url][3] = "allow" if bin_of(url or "") >= cut else "block"
    return {u: tuple(x) for u, x in out.items()}


def check(spark, urls):
    rows = [(i, u, "a", "b", "c") for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, score string, gram string").repartition(3)
    found = judge_urls(df, RULES)
    assert found.columns == ["page_id", "url", "gram", "host", "path", "rule", "score", "verdict"]
    got, want = found.collect(), by_hand(urls)
    assert sorted(r.page_id for r in got) == list(range(len(urls)))
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == want[r.url]
        assert (r.score is None) == (r.rule is not None)
    return {r.verdict for r in got if r.rule is None}


def test_random_urls(spark):
    rnd = random.Random(3)
    urls = [rnd.choice(["http://", "https://"]) + rnd.choice(HOSTS) + rnd.choice(PATHS) + rnd.choice(["", "", str(rnd.randrange(40)), "é\U0001f600"]) for _ in range(600)]
    urls += [None, None, "", "no scheme", "://", "a://b://c.org/", "http:///x", "http://a.org/\n/es/", "http://é.example.org/es/", "http://shop.net/" + "long" * 5000]
    assert check(spark, urls + ["http://shop.net/hot"] * 400) == {"allow", "block"}


def test_models_of_one_side_or_none(spark):
    check(spark, ["http://a.org/1", "http://shop.net/", "x", None])
    check(spark, ["http://b.com/de/1", "http://shop.net/de/", "x"])
    check(spark, ["http://shop.net/", "x", ""])
    none = judge_urls(spark.createDataFrame([], "page_id long, url string"), RULES)
    assert none.count() == 0 and none.columns[-1] == "verdict"


def test_unruled_urls_follow_what_rules_teach(spark):
    """Paths that rules reject, on hosts that no rule names."""
    rnd = random.Random(5)
    name = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    urls = [f"http://{name()}.com/{rnd.choice(['fr/news', 'de/casino'])}/{name()}" for _ in range(1500)]
    asked = {f"http://{name()}.net/{kind}/{name()}": verdict for kind, verdict in (("fr/news", "allow"), ("de/casino", "block")) for _ in range(40)}
    df = spark.createDataFrame([(i, u) for i, u in enumerate([*urls, *asked])], "page_id long, url string")
    got = {r.url: r.verdict for r in judge_urls(df, RULES).collect()}
    assert sum(got[u] == v for u, v in asked.items()) >= 0.95 * len(asked)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    assert_equals_sql(spark, "op11_url_model", f"/root/testdata/{sf}", ["pages"])
