"""Text, URL, number and date expressions against small cases."""

import pytest
from pyspark.sql import functions as F

from newsloom.functions import dates, numbers, udf
from newsloom.functions import text as X
from newsloom.functions import url as U


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("title", "want"),
    [("OpenAI发布GPT-5！", "openai 发布 gpt 5"), ("  Ｆｕｌｌ　width ", "full width"), (None, ""), ("a_b c", "a_b c"), ("!!!", ""), ("Ärger & Öl", "ärger öl")],
)
def test_normalize_title(spark, title, want):
    assert one(spark, X.normalize_title(F.lit(title).cast("string"))) == want


@pytest.mark.parametrize(
    ("url", "norm", "host"),
    [
        ("https://www.Example.com/a/b/?x=1#y", "example.com/a/b", "example.com"),
        ("example.com/a/", "example.com/a", ""),
        ("http://h.example:8080/p;v=1", "h.example:8080/p", "h.example:8080"),
        (None, "", ""),
        ("  https://h.example", "h.example", "h.example"),
    ],
)
def test_urls(spark, url, norm, host):
    c = F.lit(url).cast("string")
    assert (one(spark, U.normalize_url(c)), one(spark, U.url_host(c))) == (norm, host)


def test_tracking_and_domains(spark):
    assert one(spark, U.tracking_params(F.lit("https://a.example/?UTM_source=x&id=3&ref&page=2"))) == 2
    assert one(spark, U.in_domains(F.lit("https://news.a.example/x"), F.array(F.lit("a.example"))))
    assert not one(spark, U.in_domains(F.lit("https://nota.example/x"), F.array(F.lit("a.example"))))
    assert one(spark, U.resolve_link(F.lit("/p"), F.lit("https://a.example/x/y"))) == "https://a.example/p"
    assert one(spark, U.resolve_link(F.lit("mailto:x@y"), F.lit("https://a.example/"))) == ""
    assert one(spark, X.embedded_domains(F.lit("see https://www.b.example/x and http://c.example"))) == ["b.example", "c.example"]


def test_tokens(spark):
    assert one(spark, X.word_tokens(F.lit("a bb ccc bb"))) == ["bb", "ccc"]
    assert one(spark, X.bigrams(F.lit("abab"))) == ["ab", "ba"]
    assert one(spark, X.bigrams(F.lit("a"))) == [] and one(spark, X.bigrams(F.lit(""))) == []
    assert one(spark, X.cjk_bigrams(F.lit("ab你好c吗"))) == ["你好", "好吗"]


def test_cleaning(spark):
    assert one(spark, X.clean_html(F.lit("<p>a &amp; b</p>\n<br>c"))) == "a & b c"
    assert one(spark, X.truncate(F.lit("abcdefghij"), 8)) == "abcde..."
    assert one(spark, X.truncate(F.lit("abc"), 8)) == "abc"
    assert one(spark, X.extract_cdata(F.lit("<![CDATA[x]]>"))) == "x"
    assert one(spark, X.strip_markdown(F.lit("# T\n**b** [l](http://x) `c`"))) == "T\nb l c"
    assert one(spark, X.search_query(F.lit("ai news"), F.array(F.lit("press release"), F.lit("jobs")))) == 'ai news -"press release" -jobs'
    assert one(spark, X.error_text(F.lit("\n one \n\n two\n three"))) == "one | two"
    assert one(spark, X.output_markers(F.array(F.lit("A=1"), F.lit("x"), F.lit("A=2"), F.lit("B=p=q")))) == {"A": "2", "B": "p=q"}


@pytest.mark.parametrize(("said", "want"), [("1.2万", 12000), ("3亿", 300000000), ("5w", 50000), ("1,234", 1234), ("no", None), (None, None), ("热度 12.7", 12)])
def test_human_numbers(spark, said, want):
    assert one(spark, numbers.human_number(F.lit(said).cast("string"))) == want


@pytest.mark.parametrize(("value", "want"), [("7", 7), ("0", 1), ("99", 10), ("x", 3), (None, 3)])
def test_priority(spark, value, want):
    assert one(spark, numbers.normalize_priority(F.lit(value).cast("string"))) == want


def test_feed_dates_and_recency(spark):
    assert one(spark, F.unix_seconds(dates.parse_feed_date(F.lit("Mon, 15 Sep 2025 16:46:16 +0800")))) == 1757925976
    assert one(spark, F.unix_seconds(dates.parse_feed_date(F.lit("2025-09-15")))) == 1757894400
    now = F.lit("2025-01-02 00:00:00").cast("timestamp")
    for text, want in (("2025-01-01 20:00:00", 1.5), ("2025-01-01 10:00:00", 1.0), ("2024-12-01 00:00:00", 0.0), ("2025-02-01 00:00:00", 1.5), (None, 0.0)):
        assert one(spark, dates.recency_score(F.lit(text).cast("timestamp"), now)) == want


def test_fuzzy_ratios():
    assert udf.ratio("abcd", "abed") == pytest.approx(0.75)
    assert udf.token_set_ratio("new york mets", "mets new york today") == 1.0
    assert udf.token_set_ratio("", "a") == 0.0
    assert udf.partial_ratio("bcd", "abcde") == 1.0

    def slow(s, t):
        m = len(s)
        return max((udf.ratio(s, t[max(0, e - m) : e]) for e in range(1, len(t) + m) if t[max(0, e - m) : e]), default=0.0)

    for a, b in (("abca", "xbcaaby"), ("aabb", "babaabab"), ("q", "abc"), ("abc de", "ab cde fg")):
        assert udf.partial_ratio(a, b) == pytest.approx(slow(a, b))


def test_release_summary(spark):
    texts = {
        "# Head\n\nuses `snake_case_name` and **bold**\n\n\n*em* [link](https://x.example)": "Head uses snake_case_name and bold em link",
        "```\ncode\n```  after\t\u3000gap": "after gap",
        "a" * 300 + " " + "b" * 150 + " " + "c" * 100: "a" * 300 + " " + "b" * 150 + "...",
        "a" * 300 + " " + "b" * 300: "a" * 300 + " " + "b" * 199 + "...",
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.release_summary(F.col("t")).alias("s"))
    assert {r["t"]: r["s"] for r in df.collect()} == texts
