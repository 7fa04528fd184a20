"""Truth tables of the scalar expressions."""

import random
import re
import string
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from scanweave.functions.address import is_valid_ip
from scanweave.functions.names import is_valid_domain
from scanweave.functions.suffix import SuffixRules, with_ancestors, with_redirect_host, with_suffix_labels
from scanweave.functions.text import quote_url, strip_dot, strip_dots, url_host

IPS = {
    "1.2.3.4": True, "001.2.3.4": True, "256.1.1.1": False, "1.2.3": False,
    "1.2.3.4\n": False, "": False, "::1": True, "::": False, "fe80::": False,
    "1::2": True, "1:2": True, "ab:80": True, "::ffff:1.2.3.4": True, ":": True,
    "1:1.2.3.4": True, "::1.2.3.4": True, "2001:db8::10000": True,
    "2001:db8::10001": False, "1:2:3:4:5:6:7:8": True, "1:2:3:4:5:6:7:8:9": False,
    "1:2:3:4:5:6:7:1.2.3.4": False, "1:2:3:4:5:6:1.2.3.4": True, "g::1": False,
    "1::2::3": False, ":1": True, "example.com": False, "1.2.3.4:1": False,
    "0000255.0.0.01": True, "::00010000": True, "1:": True, "::1:2:3:4:5:6:7": False,
    "::1:2:3:4:5:6": True, ":1.2.3.4": True, "1.2.3.4.5": False, None: False,
}

DOMAINS = {
    "example.com": True, "a-b.example.com": True, "a_b.example.com": True,
    "_x.example.com": False, "-a.example.com": False, "localhost": False,
    "1.2.3.4": False, "example.c": False, "example.com.": False, "example.com\n": False,
    "bücher.example": True, "例え.テスト": True, "*.example.com": False, "": False,
    "a" * 63 + ".com": True, "a" * 64 + ".com": False, None: False,
    "é" * 70 + ".com": False,
}

ANCESTORS = {
    "a.b.example.co.uk": ["a.b.example.co.uk", "b.example.co.uk", "example.co.uk"],
    "*.example.com": ["*.example.com", "example.com"],
    "x.foo.github.io": ["x.foo.github.io", "foo.github.io"],
    "co.uk": [],
    "github.io": [],
    "*.co.uk": ["*.co.uk"],
    "www.ck": ["www.ck"],
    "x.y.z.kobe.jp": ["x.y.z.kobe.jp", "y.z.kobe.jp"],
    "a.city.kobe.jp": ["a.city.kobe.jp", "city.kobe.jp"],
    "Www.Example.ORG": ["Www.Example.ORG", "Example.ORG"],
    "foo.localhost": ["foo.localhost"],
    "a.foo.localhost": ["a.foo.localhost", "foo.localhost"],
    "a.b.公司.cn": ["a.b.公司.cn", "b.公司.cn"],
    "a.b.xn--55qx5d.cn": ["a.b.xn--55qx5d.cn", "b.xn--55qx5d.cn"],
    "a.x.compute.amazonaws.com.cn": ["a.x.compute.amazonaws.com.cn"],
    "localhost": None, "_x.example.com": None, "1.2.3.4": None, None: None,
}

REDIRECTS = {
    "https://u@Www.example.org:8443/x?y": "Www.example.org",
    "/x": None, "foo.py": "foo.py", "http://1.2.3.4/": None, "http://[::1]/": None,
    "//example.org/x": "example.org", "http://example.org./": "example.org",
    "https://github.io/": "github.io", "relative.html": None,
    "mailto:a@b.com": "b.com", "https://co.uk/": None, "http:// example.com /": "example.com",
    "https://.example.com/": "example.com", "https://..example.com/": None,
    "https://a:b@c@d.com?x=//y.org": "d.com", "": None, None: None,
    "http://bücher.de/": "bücher.de", "https://a.example.com#@b.org": "a.example.com",
}

QUOTED = {
    "a b": "a%20b", "%41": "%2541", "é": "%C3%A9", "~*+": "~%2A%2B", "#": "%23",
    "https://h/p?q=1&r=2": "https://h/p?q=1&r=2", None: "",
}


def evaluate(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    rows = column(df).select("i", "y").collect()
    by_index = {r.i: r.y for r in rows}
    return {v: by_index[i] for i, v in enumerate(values)}


def with_y(expression):
    return lambda df: df.withColumn("y", expression(F.col("x")))


def test_ip(spark):
    assert evaluate(spark, IPS, with_y(is_valid_ip)) == IPS


def test_domain(spark):
    assert evaluate(spark, DOMAINS, with_y(is_valid_domain)) == DOMAINS


def test_domain_equals_the_idna_codec(spark):
    pick = random.Random(3)
    pattern = re.compile(
        r"(?:[A-Za-z0-9](?:[A-Za-z0-9_-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z0-9][A-Za-z0-9_-]{0,61}[A-Za-z]\Z"
    )

    def want(name):
        try:
            return bool(pattern.match(name.encode("idna").decode()))
        except UnicodeError:
            return False

    names = list({"".join(pick.choices("aZ0-_.éпр公。 *", k=pick.randint(1, 12))) for _ in range(4000)})
    assert evaluate(spark, names, with_y(is_valid_domain)) == {n: want(n) for n in names}


def test_domain_with_many_labels(spark):
    df = spark.range(1).select(F.concat(F.repeat(F.lit("a."), 200_000), F.lit("com")).alias("x"))
    assert df.select(is_valid_domain(F.col("x"))).first()[0] is True


def test_ancestors(spark, rules):
    got = evaluate(spark, ANCESTORS, lambda df: with_ancestors(df, F.col("x"), rules, "y"))
    assert got == ANCESTORS


def test_redirect_host(spark, rules):
    got = evaluate(spark, REDIRECTS, lambda df: with_redirect_host(df, F.col("x"), rules, "y"))
    assert got == REDIRECTS


def test_suffix_sections(spark, rules):
    names = ["a.github.io", "a.co.uk", "a.b.unknowntld"]
    for private, want in [(True, [2, 2, 0]), (False, [1, 2, 0])]:
        got = evaluate(
            spark, names, lambda df: with_suffix_labels(df, F.col("x"), rules, private=private, out="y")
        )
        assert list(got.values()) == want


def test_suffix_lookup_does_not_shuffle(spark, rules):
    df = spark.range(3).select(F.concat(F.col("id").cast("string"), F.lit(".example.com")).alias("x"))
    plan = with_ancestors(df, F.col("x"), rules)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_own_rule_list(spark, tmp_path):
    path = tmp_path / "rules.dat"
    path.write_text("// ===BEGIN ICANN DOMAINS===\nzz\n*.wild.zz\n!open.wild.zz\n")
    own = SuffixRules(spark, str(path))
    names = ["a.zz", "a.b.wild.zz", "x.open.wild.zz", "a.com"]
    got = evaluate(spark, names, lambda df: with_suffix_labels(df, F.col("x"), own, private=True, out="y"))
    assert list(got.values()) == [1, 3, 2, 0]


def test_quote(spark):
    assert evaluate(spark, QUOTED, with_y(quote_url)) == QUOTED


def test_quote_equals_the_standard_library(spark):
    pick = random.Random(7)
    alphabet = string.printable + "äß€漢😀%+~*_-."
    texts = list({"".join(pick.choices(alphabet, k=pick.randint(0, 30))) for _ in range(2000)})
    want = {t: quote(t, safe=":/?=&") for t in texts}
    assert evaluate(spark, texts, with_y(quote_url)) == want


@pytest.mark.parametrize(
    "expression, want",
    [
        (strip_dot, {"a.": "a", "a..": "a.", "a": "a", "a.\n": "a.\n", None: None}),
        (strip_dots, {"a.": "a", "a. . ": "a", " a": " a", "..": "", None: None}),
        (url_host, {"HTTPS://A.b:1/": "A.b", "x": "x", "": "", None: None}),
    ],
)
def test_text(spark, expression, want):
    assert evaluate(spark, want, with_y(expression)) == want


def test_strict_addresses(spark):
    import ipaddress
    import random

    pick = random.Random(8)
    groups = ["", "0", "1", "ab", "FFFF", "10000", "0001", "g", "1.2.3.4", "01.2.3.4", "256.1.1.1", "1.2.3"]
    texts = {":".join(pick.choice(groups[: pick.choice([5, 7, 12])]) for _ in range(pick.randint(1, 10))) for _ in range(4000)}
    texts |= {"::", "::1", "1::", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4", "::1.2.3.4"}
    texts |= {"1:2:3:4:5:6:7:1.2.3.4", "1::2::3", "1.2.3.4", "1.2.3.4\n", "1:2", ":::", "1:2:3:4:5::1.2.3.4", "1:2:3:4:5:6::1.2.3.4"}

    def valid(text):
        try:
            ipaddress.ip_address(text)
        except ValueError:
            return False
        return True

    frame = spark.createDataFrame([(t,) for t in texts] + [(None,)], "ip string")
    got = {r.ip: r.ok for r in frame.select("ip", is_valid_ip(F.col("ip"), strict=True).alias("ok")).collect()}
    assert got.pop(None) is False
    assert got == {t: valid(t) for t in texts} and 50 < sum(got.values())
