from text_cases import SF01

from runwaylens.llm.q06_reputation import RULES
from runwaylens.llm.reputation import judge


def pages(spark, *urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")


def test_hosts_paths_and_rules(spark):
    rows = judge(
        pages(
            spark,
            "https://WWW.Example.ORG/en/12?x=1",
            "http://example.org/es/",
            "http://notexample.org/es/",
            "http://a.com/de/1#f",
            "http://a.com?q://b.org/",
            "no scheme.org/",
            None,
            "",
            "x://org",
            "http://a.net/p://b.org/x",
        ),
        RULES,
    ).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in rows] == [
        ("www.example.org", "/en/12", "example.org/en/1"),
        ("example.org", "/es/", "example.org/es/"),
        ("notexample.org", "/es/", "org/"),
        ("a.com", "/de/1", "com/de/"),
        ("a.com", "", None),
        ("", "", None),
        ("", "", None),
        ("", "", None),
        ("org", "", None),
        ("a.net", "/p://b.org/x", None),
    ]
    assert [r.verdict for r in rows[:4]] == ["block", "block", "allow", "block"]


def test_reputation_shrinks_to_the_levels_above(spark):
    bad = [(f"h{i % 3}.bad.net", False) for i in range(90)]
    good = [(f"h{i % 40}.good.net", True) for i in range(400)]
    outcomes = spark.createDataFrame([*bad, *good, ("one.good.net", False), (None, True)], "host string, good boolean")
    urls = ["http://h0.bad.net/", "http://new.bad.net/", "http://one.good.net/", "http://new.good.net/", "http://x.org/"]
    rows = judge(pages(spark, *urls), [], outcomes).orderBy("page_id").collect()
    assert [r.verdict for r in rows] == ["block", "block", "allow", "allow", "allow"]


def test_no_outcomes_empty_tables_and_clashing_columns(spark):
    df = spark.read.parquet(f"{SF01}/pages.parquet").selectExpr("*", "1 AS host", "2 AS verdict", "3 AS g")
    out = judge(df, [])
    assert {r.verdict for r in out.collect()} == {"allow"} and out.count() == df.count()
    assert judge(df.limit(0), RULES).count() == 0
