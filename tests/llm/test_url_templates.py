from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from conftest import plan_of

from cohortloom.llm.oracles import URL_TEMPLATES
from cohortloom.llm.queries import op11_url_templates
from cohortloom.llm.url_templates import (RULES, TreeRules, UrlRule, fitting_rule, judge_urls,
                                          url_parts)
from llm_helpers import package_on_workers  # noqa: F401
from pyspark.sql import functions as F

ODD = [
    (1, None), (2, ""), (3, "no scheme/en/"), (4, "HTTP://A.Example.NET/en/1?x=/fr/"),
    (5, "http://net"), (6, "http://net/"), (7, "http://example.net/en"), (8, "http://anet/x"),
    (9, "http://b.org/fr/x#y"), (10, "http://b.org/FR/x"), (11, "https://x.example.com/de/9"),
    (12, "ftp://u:p@example.net:80/en/1"), (13, "x://y://z/a"), (14, "http://ÄÖ.org/fr/ü"),
    (14, "http://ÄÖ.org/fr/ü"), (None, "http://b.org/fr/x"), (15, "http://c.com" + "/s" * 5000),
    (16, "http://c.com//a//b/"), (17, "http://c.com/{n}|x/5.html"), (18, "http://c.com/a?b"),
    (19, "http://c.com/a.html\n"), (20, "http://d.io/12\n/x"), (21, "http://\u0130.net/"),
]


def pages_of(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string")
    return df.withColumns({c: F.lit("x") for c in (
        "host", "path", "rule", "verdict", "key", "node", "rate", "n", "segment", "template", "_to",
        "_hot", "_salt", "bad", "_label_key", "rows", "branches")})


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, bad int")


def many(hosts=6, each=120):
    """Hosts with articles by number, users by name and a tag page; tags are bad."""
    pages, labels = [], []
    for h in range(hosts):
        for i in range(each):
            kind = i % 4
            path = [f"/news/{i}.html", f"/user/n{i}x/posts", f"/tag/{'abc'[i % 3]}{i}", f"/w{'q' * i}"][kind]
            number = len(pages)
            pages.append((number, f"https://h{h}.test{path}"))
            if i % 3 == 0:
                labels.append((number, int(kind == 2)))
    return pages, labels


@pytest.mark.parametrize("hot_rows", [1_000_000, 20])
def test_equals_sql_on_odd_and_hot_tables(spark, tmp_path, hot_rows):
    pages, labels = many()
    hot = [(10_000 + i, f"http://hot.site/en/{i % 300}") for i in range(900)]
    rows = [*pages, *hot, *ODD]
    got = judge_urls(pages_of(spark, rows), labels_of(spark, labels), hot_rows=hot_rows)
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", rows)
    con.execute("create table labels (doc_id bigint, quality int, toxic int)")
    con.executemany("insert into labels values (?, 1, ?)", labels)
    columns = ["page_id", "host", "path", "rule", "verdict", "template"]
    want = Counter(con.execute(f"select {', '.join(columns)} from ({URL_TEMPLATES})").fetchall())
    assert Counter(tuple(r) for r in got.select(columns).collect()) == want


def test_bad_templates_are_rejected_and_others_left(spark):
    pages, labels = many()
    rows = {r.page_id: r for r in judge_urls(
        pages_of(spark, pages), labels_of(spark, labels)).collect()}
    for number, url in pages:
        assert rows[number].verdict == ("block" if "/tag/" in url else "allow"), rows[number]
    # User names and numbers have become wildcards, the fixed segments have not.
    assert any("=user" in r.template for r in rows.values())
    assert len({r.template for r in rows.values() if "/user/" in r.path}) == 1


def test_few_labels_do_not_condemn(spark):
    pages = [(i, f"http://a.io/x/{i}") for i in range(50)] + [(100 + i, f"http://b.io/y/{i}") for i in range(50)]
    labels = [(i, 0) for i in range(40)] + [(100, 1), (101, 1)]
    got = judge_urls(pages_of(spark, pages), labels_of(spark, labels))
    assert {r.verdict for r in got.collect()} == {"allow"}


def test_parts_and_rules(spark):
    df = pages_of(spark, ODD)
    host, path = url_parts(F.col("url"))
    got = {r.page_id: r for r in df.select(
        "page_id", host.alias("h"), path.alias("p")).withColumn(
            "r", fitting_rule(F.col("h"), F.col("p"), RULES)).collect()}
    assert (got[1].h, got[1].p) == (got[2].h, got[2].p) == (got[3].h, got[3].p) == ("", "")
    assert (got[4].h, got[4].p, got[4].r.name) == ("a.example.net", "/en/1", "example.net/en/")
    assert got[5].r is None and got[6].r.name == "net/" and got[7].r.name == "net/"
    assert got[8].r is None and got[9].r.name == "org/fr/" and got[10].r is None
    assert got[11].r.verdict == "block" and got[12].h == "u:p@example.net:80"
    assert (got[13].h, got[13].p) == ("y:", "//z/a")
    same = (UrlRule("b.org", "/", "block"), UrlRule("org", "/fr", "allow"), UrlRule("b.org", "/fr/x", "block"))
    row = df.where("page_id = 9").select(fitting_rule(F.lit("b.org"), F.lit("/fr/x"), same).alias("r")).first()
    assert row.r.name == "b.org/fr/x"


def test_empty_tables_and_labels_of_any_kind(spark):
    none = labels_of(spark, [])
    assert judge_urls(pages_of(spark, []), none).count() == 0
    got = judge_urls(pages_of(spark, ODD), none).collect()
    assert len(got) == len(ODD) and all(r.bad_rate == 0 for r in got)
    odd = labels_of(spark, [(None, 1), (1, None), (7, 1), (7, 0), (999, 1)])
    assert judge_urls(pages_of(spark, ODD), odd, tree=TreeRules(levels=1)).count() == len(ODD)


def test_no_python_in_the_plan(spark, small):
    plan = plan_of(op11_url_templates(spark, small))
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "RDD"))
