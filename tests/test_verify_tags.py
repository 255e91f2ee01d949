import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.operators import matching, reports, tagging, verify
from rollbook.sources import rules as rule_source
from tests.conftest import as_set

NOW = dt.datetime(2024, 5, 1)
ANSWER = "cr_no string, outcome_http string, name_zh string, name_en string, address_raw string"


@pytest.fixture
def classified(rows):
    raw = rows([(k, "z", "e", "a", None) for k in "12345"] + [("6", None, "e ", " a", None)], schemas.COMPANIES_RAW)
    answers = rows(
        [("1", "ok", "z", "e", "a"), ("2", "ok", "z", "e", "new"), ("3", "gone", None, None, None),
         ("4", "error", None, None, None), ("5", None, None, None, None), ("6", "ok", "　", "e", "a"), ("7", "ok", "z", None, " a ")],
        ANSWER,
    )
    return verify.classify(answers, raw)


def test_outcomes(classified):
    outcomes = {r["cr_no"]: r["outcome"] for r in classified.collect()}
    assert outcomes == {"1": "unchanged", "2": "updated", "3": "gone", "4": "error", "5": "error", "6": "unchanged", "7": "new"}
    stats = verify.verify_stats(classified).first().asDict()
    assert stats == {"new": 1, "updated": 1, "unchanged": 2, "gone": 1, "error": 2}


def test_raw_changes(classified):
    got = as_set(verify.raw_changes(classified, NOW).drop("fetched_at"))
    assert got == [("2", "z", "e", "new"), ("7", "z", "", "a")]


def test_cascade_and_touch(classified, rows):
    master = rows(
        [(k, "z", "e", "a", "c", "G", "r", "d", "s", "b", 1.0, 2.0, 90.0, False, "t", "x", "y", None, "F") for k in "12"],
        schemas.columns(" ".join(f"{f.name}:{f.dataType.simpleString()}" for f in schemas.MASTER) + " industry_tag"),
    )
    kept, reset = verify.cascade_reset(master, classified, NOW).orderBy("cr_no").collect()
    assert kept["geo_address"] == "G" and kept["confidence"] == 90.0
    assert all(reset[c] is None for c in verify.DERIVED)
    assert (reset["address_raw"], reset["confidence"], reset["manual_review"]) == ("new", 0.0, True)
    assert (reset["last_updated"], reset["industry_tag"], reset["company_type"]) == (NOW, "F", "t")
    queue = rows([(k, "hit", None, None) for k in "123"], schemas.SCAN_QUEUE)
    touched = {r["brn"]: r["queried_at"] for r in verify.touch_queue(queue, classified, NOW).collect()}
    assert touched == {"1": NOW, "2": NOW, "3": None}


KEYWORDS = {"F": ["工程", "Building"], "G": ["行", "店", ""], "I": ["酒店"], "J": ["IT", "科技"], "K": ["銀行", "Bank"]}
NAMES = [
    ("1", "大新銀行", None, "G"), ("2", "海景酒店", "", "G"), ("3", None, "ABC LIMITED", "J"),
    ("4", None, "abc bank", None), ("5", "建築工程行", "Bank", "F"), ("6", None, None, None), ("7", "x", "Bank + Co", "K"),
]


@pytest.fixture
def names(rows):
    return rows([n[:3] for n in NAMES], "cr_no string, name_zh string, name_en string")


@pytest.fixture
def keywords(spark):
    return rule_source.keyword_frame(spark, KEYWORDS)


def sections(df):
    return {r["cr_no"]: r["section"] for r in df.collect()}


def test_first_section_in_order(names, keywords):
    assert sections(tagging.with_keyword_section(names, keywords)) == {n[0]: n[3] for n in NAMES}


def plain_fold(text):
    """As java.util.regex compares characters without case: to upper, then to lower, one by one."""
    out = []
    for c in text:
        c = c.upper() if len(c.upper()) == 1 else c
        out.append("i" if c == "İ" else c.lower() if len(c.lower()) == 1 else c)
    return "".join(out)


def plain_match(name, rules, word_boundary=False, ignore_case=False, longest_match=False):
    """Rules (section, section_ord, kw_ord, keyword) tried one after the other."""
    order = (lambda r: (-len(r[3]), r[1:])) if longest_match else (lambda r: r[1:])
    for section, _, _, keyword in sorted((r for r in rules if r[3]), key=order):
        text, word = (plain_fold(name), plain_fold(keyword)) if ignore_case else (name, keyword)
        if word in text and (not word_boundary or re.search(rf"\b{re.escape(word)}\b", text)):
            return section, keyword
    return None


OPTIONS = [{}, {"ignore_case": True}, {"word_boundary": True, "longest_match": True}, {"word_boundary": True, "ignore_case": True}]


@pytest.mark.parametrize("n_rules", [10, 5000])
def test_matches_against_plain_rules(spark, n_rules, monkeypatch):
    draw = random.Random(n_rules)
    text = lambda n: "".join(draw.choice("aAbB工行İiıIΣσςſsSKk #-_1") for _ in range(n))
    rules = [(f"S{k % 7}", k % 7, k // 7, text(draw.randint(0, 4)) if n_rules == 10 else text(draw.randint(3, 6))) for k in range(n_rules)]
    rules += [("T", 9, 0, "istanbul"), ("T", 9, 1, "οδοσ"), ("T", 9, 2, "STRASSE"), ("T", 9, 3, None), ("T", 9, 4, "C++ (x)|")]
    names = ["İSTANBUL TRADING", "ΟΔΟΣ LTD", "ΟΔΟς LTD", "ſtraſſe", "xC++ (x)|", "", *[text(draw.randint(0, 30)) for _ in range(150)]]
    rows = spark.createDataFrame([(str(i), "", n) for i, n in enumerate(names)] + [("null", None, None)], "cr_no string, name_zh string, name_en string")
    table = spark.createDataFrame(rules, "section string, section_ord int, kw_ord int, keyword string")
    for most in (500_000, n_rules // 3):  # one automaton, several
        monkeypatch.setattr(matching, "MOST_KEYWORDS", most)
        for options in OPTIONS if most > n_rules else OPTIONS[3:]:
            want = {str(i): m for i, n in enumerate(names) if (m := plain_match(" " + n, rules, **options))}
            if (m := plain_match(" ", rules, **options)) is not None:
                want["null"] = m
            got = {r["cr_no"]: (r["section"], r["keyword"]) for r in tagging.tag_explain(rows, table, **options).collect()}
            assert got == want, options
    folded = {r["cr_no"] for r in tagging.tag_explain(rows, table.where("section = 'T'"), ignore_case=True).collect()}
    assert {"0", "1", "2", "3"} <= folded


def test_no_rules(names, keywords):
    assert tagging.tag_explain(names, keywords.limit(0)).isEmpty()
    assert set(sections(tagging.with_keyword_section(names, keywords.limit(0))).values()) == {None}


def test_a_hundred_thousand_keywords(spark, names, keywords):
    more = spark.range(100_000).selectExpr("'Z' AS section", "99 AS section_ord", "CAST(id AS INT) AS kw_ord", "concat('no name ', id) AS keyword")
    every = keywords.unionByName(more)
    for options in OPTIONS[:2]:
        assert as_set(tagging.tag_explain(names, every, **options)) == as_set(tagging.tag_explain(names, keywords, **options))


def test_long_keyword_lists_are_joined_and_not_broadcast(spark, monkeypatch):
    draw = random.Random(8)
    text = lambda n: "".join(draw.choice("aAbB工İiς𝔸 #-_1") for _ in range(n))
    rules = [(f"S{k % 7}", k % 7, k // 7, text(draw.randint(1, 5))) for k in range(900)] + [(None, 1, None, "zz"), ("U", 1, 3, "zz")]
    names = [text(draw.randint(0, 30)) for _ in range(120)] + ["q zz", "zzz", ""] * 2
    rows = spark.createDataFrame([(str(i), None, n) for i, n in enumerate(names)] + [("null", None, None)], "cr_no string, name_zh string, name_en string")
    table = spark.createDataFrame(rules, "section string, section_ord int, kw_ord int, keyword string")
    want = {str(o): as_set(tagging.tag_explain(rows, table, **o)) for o in OPTIONS}

    def refused(*_):
        raise AssertionError("the whole list went through the driver")

    monkeypatch.setattr(matching, "MOST_KEYWORDS", 100)
    monkeypatch.setattr(matching, "_finder", refused)
    for options in OPTIONS:
        assert as_set(tagging.tag_explain(rows, table, **options)) == want[str(options)]
        marked = tagging.with_keyword_section(rows, table, **options)
        assert marked.columns == [*rows.columns, "section"] and marked.count() == len(names) + 1


def test_section_names_need_no_shuffle_by_code(spark, names):
    from rollbook.sources import rules as rule_source

    tagged = names.withColumn("industry_tag", F.substring("name_en", 1, 1))
    plan = tagging.with_section_names(tagged, rule_source.section_table(spark))._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(industry_tag" not in plan


def test_options(names, keywords):
    assert sections(tagging.with_keyword_section(names, keywords, ignore_case=True))["4"] == "K"
    assert sections(tagging.with_keyword_section(names, keywords, word_boundary=True))["3"] is None
    longest = sections(tagging.with_keyword_section(names, keywords, longest_match=True))
    assert (longest["1"], longest["2"]) == ("K", "I")


def test_special_characters_in_keywords(spark, rows):
    rules = rule_source.keyword_frame(spark, {"A": ["C++ (x)", "a|b"], "B": ["q.z", "\\E"]})
    df = rows([("1", "", "C++ (x)"), ("2", "", "a"), ("3", "", "qaz"), ("4", "", "q.z"), ("5", "", "\\E")], "cr_no string, name_zh string, name_en string")
    want = {"1": "A", "2": None, "3": None, "4": "B", "5": "B"}
    assert sections(tagging.with_keyword_section(df, rules)) == want
    assert {r["cr_no"]: r["section"] for r in tagging.tag_explain(df, rules).collect()} == {k: v for k, v in want.items() if v}


def test_two_tiers(spark, names, keywords, rows):
    table = rule_source.section_table(spark)
    labels = rows([("4", " k "), ("6", "zz"), ("1", "A")], "cr_no string, code string")
    tags = {r["cr_no"]: r for r in tagging.tags_for(names, keywords, table, labels).collect()}
    assert sorted(tags) == ["1", "2", "3", "4", "5", "7"]
    by_label = tags["4"]
    assert (by_label["industry_tag"], by_label["industry_method"], by_label["industry_conf"], by_label["industry_review"]) == ("K", "llm", 0.75, True)
    assert (tags["1"]["industry_tag"], tags["1"]["industry_method"], tags["1"]["industry_review"]) == ("G", "keyword", False)
    assert by_label["industry_name_en"] == "Finance and Insurance"
    relaxed = tagging.tags_for(names, keywords, table, labels, review_below=0.6)
    assert tagging.tag_stats(relaxed).first()[:] == (6, 1, 0)
    assert as_set(tagging.unknown_labels(labels, table)) == [("6", "ZZ")]
    assert tagging.tags_for(names, keywords, table).count() == 5


def test_merge_keywords(spark, keywords, rows):
    assigned = rows([(1, "Tower", "f"), (2, "Building", "F"), (3, "", "F"), (4, "Zoo", "Z"), (5, "Arch", "F"), (6, "Tower", "f")], "ord int, word string, code string")
    merged = tagging.merge_keywords(keywords, assigned)
    assert as_set(merged.where("section = 'F'").orderBy("kw_ord").select("kw_ord", "keyword")) == [
        (0, "工程"), (1, "Building"), (2, "Tower"), (3, "Arch"),
    ]
    assert merged.where("section = 'Z'").isEmpty()
    new = tagging.merge_keywords(keywords, assigned, allow_new_codes=True)
    assert as_set(new.where("section = 'Z'")) == [("Z", 5, 0, "Zoo")]
    assert as_set(tagging.merge_keywords(merged, assigned)) == as_set(merged)


def test_summary_of_an_empty_master(spark):
    empty = spark.createDataFrame([], schemas.MASTER)
    row = reports.master_summary(empty, spark.createDataFrame([], schemas.ADDRESS_CACHE)).first()
    assert row[:] == (0, 0, 0, None, 0.0, "N/A", "0.0")


def test_summary_text(spark):
    df = spark.createDataFrame([], schemas.MASTER)
    rows = spark.range(8).select(
        F.col("id").cast("string").alias("cr_no"), (F.col("id") % 4 == 0).alias("manual_review"),
        F.when(F.col("id") > 0, F.lit(80.0)).otherwise(0.0).alias("confidence"),
    )
    full = df.unionByName(rows, allowMissingColumns=True)
    row = reports.master_summary(full, full).first()
    assert (row["hit_rate_text"], row["avg_confidence_text"], row["avg_confidence"]) == ("75.0%", "80.0", 80.0)
