import duckdb
import pytest

from cityflow.llm import url_rules
from cityflow.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import SF

RULES = [
    url_rules.host_rule("com", "/", "allow"),
    url_rules.host_rule("example.com", "/en/", "block"),
    url_rules.host_rule("www.example.com", "/en/", "allow"),
    url_rules.host_rule("a.org", "/fo", "block"),
    *url_rules.WORD_RULES,
]
CASES = [
    ("http://WWW.Example.com/en/x?y#z", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("https://b.example.com/en/", "b.example.com", "/en/", "example.com/en/", "block"),
    ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("https://example.com", "example.com", "", None, "allow"),
    ("https://example.com/EN/", "example.com", "/EN/", "com/", "allow"),
    ("x://a.org/foot", "a.org", "/foot", "a.org/fo/", "block"),
    ("x://a.org/Casino?b", "a.org", "/Casino", None, "block"),
    ("x://a.org/casinos", "a.org", "/casinos", None, "allow"),
    ("x://h?://com/", "h", "", None, "allow"),
    ("x://ÀB.net/é\n/login", "Àb.net", "/é\n/login", None, "block"),
    ("x://a.org/ad\u017f/", "a.org", "/ad\u017f/", None, "allow"),
    ("x://a.org/\u212aads/x", "a.org", "/\u212aads/x", None, "block"),
    ("x://a.org/CaSiNo\u017f", "a.org", "/CaSiNo\u017f", None, "block"),
    ("com/en/", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
    ("http://x.com/" + "a/" * 50_000, "x.com", "/" + "a/" * 50_000, "com/", "allow"),
]


def frame(spark, urls):
    return spark.createDataFrame(
        [(k, u, "t", "w") for k, u in enumerate(urls)], "page_id bigint, url string, found string, rule string"
    )


def test_cases(spark):
    rows = url_rules.judge(frame(spark, [c[0] for c in CASES]), RULES).orderBy("page_id").collect()
    assert [(r.url, r.host, r.path, r.rule, r.verdict) for r in rows] == CASES


def test_query_equals_sql(spark):
    got = QUERIES["op7_url_filters"](spark, SF).collect()
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
        want = con.sql(ORACLES["op7_url_filters"]).fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_only_candidates_run(spark, monkeypatch):
    """A rule whose rarest token is not in a url never runs there."""
    broken = url_rules.Rule("broken", "block", "(", ("absent", "com"))
    urls = [c[0] for c in CASES[:3]]
    rows = url_rules.judge(frame(spark, urls), [*RULES, broken]).collect()
    assert len(rows) == 3


def test_empty_and_too_many(spark):
    assert url_rules.judge(frame(spark, ["x"]).where("false"), RULES).collect() == []
    assert {r.verdict for r in url_rules.judge(frame(spark, ["x", "http://a.com/ads"]), []).collect()} == {"allow"}
    with pytest.raises(ValueError):
        url_rules.judge(frame(spark, ["x"]), RULES[:1] * (url_rules.RULES_MOST + 1))
