import random

import pytest
from pyspark.sql import functions as F

from newsloom.functions import rules as R
from newsloom.operators import rulebook

TITLES = [
    ("A cheap quantum-proof semiconductor", "", "Công nghệ"),
    ("Bảo mật cho người dùng phổ thông", "", "Công nghệ"),
    ("Lãi suất giữ nguyên hết quý", "", "Kinh tế"),
    ("The senate sits until late", "", "Chính trị"),
    ("Golfer misses the cut", "", "Thể thao"),
    ("Tim mạch: lời khuyên cho mùa đông", "", "Sức khỏe"),
    ("Five hundred loose bricks", "", "Tin tức"),
    ("Ethereum fork delayed", "", "Công nghệ"),
    ("Buổi sớm", "tín dụng nới rộng", "Kinh tế"),
    # "UN" is listed in upper case and never meets lower-cased text.
    ("UN meets", "", "Tin tức"),
    # Substring, not word: "said" holds "ai".
    ("He said", "", "Công nghệ"),
    ("NATO summit", "", "Chính trị"),
]


def hits(rules, title="t", content="c"):
    return R.hits_in_order(R.match_text(F.col(title), F.col(content)), rules)


def test_first_match(rows_of):
    got = rows_of([t[:2] for t in TITLES], "t string, c string", R.first_match_category(hits(R.FIRST_MATCH_RULES)))
    assert [r[0] for r in got] == [t[2] for t in TITLES]


def test_rule_sets_are_whole():
    assert len(R.FIRST_MATCH_RULES.rows()) == 225 and len(R.FIRST_MATCH_RULES.categories) == 9
    assert len(R.SCORED_RULES.rows()) == 121 and len(R.SCORED_RULES.categories) == 7


def test_keywords_in_rule_order_and_capped(rows_of):
    text = "Startup bán chip và phần mềm, chip cho cloud; fintech, web3, nvidia, ransomware, iphone, android, uav, chip"
    (keywords,), (none,) = rows_of([(text, ""), ("Five loose", "bricks")], "t string, c string",
                                   R.top_keywords(hits(R.FIRST_MATCH_RULES)))
    found = [k for k in R.FIRST_MATCH_RULES.keywords() if k in (text + " ").lower()]
    assert keywords == found[:8] and len(found) > 8 and none == []


def test_one_pass_equals_look_up(rows_of):
    words = R.FIRST_MATCH_RULES.keywords()
    data = [(" ".join(words[i::7]), "x" * i) for i in range(7)] + [("", ""), ("sức khỏe champions league", "aiai")]
    found = rows_of(data, "t string, c string", hits(R.FIRST_MATCH_RULES))
    assert found == [([k for k in words if k in f"{t} {c}".lower()],) for t, c in data]


@pytest.mark.parametrize("more", [0, 40])
def test_an_empty_keyword_is_in_every_text(rows_of, more):
    words = ["w3", "", *(f"k{i}" for i in range(more))]
    got = rows_of([("W3 w3", ""), ("", ""), (None, "")], "t string, c string", R.keyword_hits(F.lower("t"), words))
    assert got == [(["w3", ""],), ([""],), (None,)]
    assert rows_of([("x",)], "t string", R.keyword_hits(F.col("t"), [""])) == [([""],)]


def test_scores_and_ties(rows_of):
    data = [("government market trade", ""), ("government market", ""), ("market government", ""), ("zzz", ""),
            ("trade trade trade war conflict", "")]
    scores = R.category_scores(hits(R.SCORED_RULES))
    got = rows_of(data, "t string, c string", R.scored_category(scores))
    assert [r[0] for r in got] == ["Kinh tế", "Chính trị", "Chính trị", "Tin tức", "Thế giới"]


def test_rules_from_a_table(spark):
    table = R.SCORED_RULES.table(spark)
    assert R.RuleSet.from_table(table.repartition(5)) == R.SCORED_RULES


def test_a_large_rules_table_is_served(spark, rows_of):
    """70 MB of keywords, more than was once allowed."""
    table = spark.range(700).select(F.lit(0).alias("cat_ord"), F.lit("c").alias("category"), F.col("id").cast("int").alias("kw_ord"),
                                    F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), 100_000)).alias("keyword"))
    rules = R.RuleSet.from_table(table)
    assert sum(len(k) for k in rules.keywords()) > 70_000_000
    got = rows_of([("7" + "x" * 100_000,), ("none",)], "t string", F.size(R.keyword_hits(F.col("t"), rules.keywords())))
    assert got == [(1,), (0,)]


def test_joined_rules_match_the_broadcast_ones(spark):
    """Keywords of all lengths, repeated, empty, never hit; texts that are null, empty and repeated."""
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcé 😀") for _ in range(n))
    keywords = [word(rng.randrange(1, 9)) for _ in range(3000)] + ["", "zzzz", "zz", "a"]
    rules = [(i % 7, f"c{i % 7}", i, k) for i, k in enumerate(keywords + keywords[:50])]
    table = spark.createDataFrame(rules, "cat_ord int, category string, kw_ord int, keyword string")
    texts = [(i, word(rng.randrange(200))) for i in range(300)] + [(300, None), (301, ""), (5, "abc abc")]
    rows = spark.createDataFrame(texts, "n int, t string")
    got = [(r.n, r.t, None if r.hits is None else [h.keyword for h in r.hits]) for r in rulebook.rule_hits(rows, table, "n", F.col("t")).collect()]
    order = list(dict.fromkeys(keywords))
    assert sorted(got, key=repr) == sorted([(n, t, [k for k in order if t is not None and k in t]) for n, t in texts], key=repr)
    none = rulebook.rule_hits(rows, table.limit(0), "n", F.col("t"))
    assert {len(r.hits) for r in none.collect()} == {0}


def test_keyword_hits_take_arrow_batches(spark):
    """Texts are not copied to pandas, whole batches at a time; null texts have null hits."""
    from pyspark.util import PythonEvalType

    assert R._one_pass(("ai",)).evalType == PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF
    rows = spark.createDataFrame([(0, "said who"), (1, None), (2, ""), (3, "x")], "i int, t string")
    got = rows.select("i", R.keyword_hits(F.col("t"), ["who", "", "ai"]).alias("h")).orderBy("i").collect()
    assert [r.h for r in got] == [["who", "", "ai"], None, [""], [""]]
