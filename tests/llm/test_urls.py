import duckdb
import pandas as pd
from ordermart.llm.queries import ORACLE
from ordermart.llm.urls import fixed_rules, judge_urls

URLS = [
    None,
    "",
    "no scheme example.net/en/",
    "http://",
    "http:///",
    "HTTP://WWW.Example.NET/en/a?x=/de/",
    "http://example.net/en",
    "http://example.net/en/",
    "http://a.b.example.net/en//x",
    "http://net/",
    "http://net",
    "http://xnet/",
    "http://example.com/de/x#top",
    "http://myexample.com/de/x",
    "http://.example.com/de/",
    "http://a..org/fr/",
    "http://org?/fr/",
    "http://org#/fr/",
    "x://y://org/fr/",
    "http://ÀÉ.org/fr/ü",
    "http://a.org/fr/\nline",
    "http://host.org/" + "d/" * 3000,
]


def judged(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url AS host", "page_id AS rule")
    return judge_urls(df, fixed_rules(spark)).toPandas()


def test_odd_urls_agree_with_sql(spark):
    rows = [(k if k % 5 else None, url, "x") for k, url in enumerate(URLS + URLS)]
    pages = pd.DataFrame(rows, columns=["page_id", "url", "html"])
    expected = duckdb.connect().register("pages", pages).execute(ORACLE["op6_url_filters"]).df()

    def plain(frame):
        frame = frame[["page_id", "host", "path", "rule", "verdict"]].astype(object)
        return sorted(frame.where(frame.notna(), None).map(str).values.tolist())

    assert plain(judged(spark, rows)) == plain(expected)


def test_rules_within_a_path_and_ties(spark):
    rules = fixed_rules(
        spark, [("block", "a.org", "/x"), ("allow", "a.org", "/xy/z"), ("allow", "b.org", "/"), ("block", "b.org", "/")]
    )
    rows = [(1, "http://a.org/xx"), (2, "http://a.org/xy/zz"), (3, "http://a.org/xy/"), (4, "http://b.org/")]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in got} == {
        1: ("a.org/x", "block"),
        2: ("a.org/xy/z", "allow"),
        3: ("a.org/x", "block"),
        4: ("b.org/", "block"),
    }


def test_no_python_in_the_plan_and_empty_table(spark):
    df = judge_urls(spark.createDataFrame([], "page_id long, url string"), fixed_rules(spark))
    assert df.collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_url_of_many_slashes_and_dots(spark):
    rows = [(1, "http://a.net" + "/" * 100_000), (2, f"http://{'a.' * 100_000}example.net/en/"), (3, "http://a.org" + "/fr" * 50_000)]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string"), fixed_rules(spark)).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in got} == {
        1: ("net/", "block"),
        2: ("example.net/en/", "allow"),
        3: ("org/fr/", "allow"),
    }


def test_rules_of_several_depths(spark):
    rules = fixed_rules(spark, [("block", "org", "/"), ("allow", "a.b.org", "/x/y/z/"), ("block", "b.org", "/x/"), ("allow", "", "/")])
    rows = [(1, "http://c.a.b.org/x/y/z/"), (2, "http://a.b.org/x/y/"), (3, "http://b.org/y"), (4, "http:///q"), (5, "http://net/")]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    assert {r.page_id: r.rule for r in got} == {1: "a.b.org/x/y/z/", 2: "b.org/x/", 3: "org/", 4: "/", 5: None}
