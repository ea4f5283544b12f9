"""Look-alike forms, addresses and Merkle digests."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm import address, lookalike, wordsets

SAME = [("Leаked ріpeline", "Leaked pipeline"), ("ＡＢＣ　１２", "ABC 12"), ("café", "café"), ("a​b­", "ab"), ("ﬁne", "fine"), ("⼈⼯", "人工"), ("е́", "é"), ("x  y", "x y"), ("Kelvin", "Kelvin"), ("ё", "ë"), (" a ", "a")]
DIFFERENT = [("Resume", "Résumé"), ("a", "A"), ("1", "l"), ("a—b", "a-b"), ("x²", "x2"), ("①", "1"), ("“a”", '"a"'), ("naïve", "naive"), ("n̄", "ñ")]


def fitted(texts):
    counts = {}
    for t in texts:
        for c in t:
            counts[c] = counts.get(c, 0) + 1
    return lookalike.Rewriter(*lookalike.rewrite_rules(counts))


def test_same_and_different():
    rewrite = fitted([t for p in SAME + DIFFERENT for t in p])
    for a, b in SAME:
        assert rewrite(a) == rewrite(b) and lookalike.read_form(a) == lookalike.read_form(b), (a, b)
    for a, b in DIFFERENT:
        assert rewrite(a) != rewrite(b) and lookalike.read_form(a) != lookalike.read_form(b), (a, b)


def test_representative_follows_frequency():
    assert fitted(["оооо", "o"])("o") == "о"
    assert fitted(["oooo", "о"])("о") == "o"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aеéó̈ﬁﬀfiＡАA 　​ññÜкй", max_size=12), min_size=1, max_size=6))
def test_automaton_gives_the_classes_of_the_plain_form(texts):
    rewrite = fitted(texts)
    for a in texts:
        assert rewrite(rewrite(a)) == rewrite(a)
        for b in texts:
            assert (rewrite(a) == rewrite(b)) == (lookalike.read_form(a) == lookalike.read_form(b))


def test_pairs_edge_cases(spark):
    rows = [(1, "Leaked x"), (2, "Leаked x"), (3, "Leaked x"), (4, None), (5, ""), (6, "​"), (7, "leaked x"), (8, "y" * 60_000), (9, "y" * 60_000 + "​")]
    df = spark.createDataFrame(rows, "id bigint, title string").withColumn("form", F.lit("clash")).withColumn("text", F.lit(1))
    got = {(r["id_a"], r["id_b"]) for r in lookalike.look_alike_pairs(df, "id", "title").collect()}
    assert got == {(1, 2), (2, 3), (8, 9)}
    assert lookalike.look_alike_pairs(df.limit(0), "id", "title").count() == 0
    with pytest.raises(ValueError):
        lookalike.with_form(df, "title", "form")


def test_classes_say_what_the_pairs_say(spark):
    texts = ["Leaked x", "Leаked x", "Leaked x", None, "", "\u200b", "leaked x", "ﬁne", "fine", "alone", "ｆine", "alone"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, title string").withColumn("class_id", F.lit(1))
    got = {r["id"]: (r["class_id"], r["rows"], r["variants"]) for r in lookalike.look_alike_classes(df, "id", "title").collect()}
    assert got == {0: (0, 3, 2), 1: (0, 3, 2), 2: (0, 3, 2), 7: (7, 3, 3), 8: (7, 3, 3), 10: (7, 3, 3)}
    assert lookalike.look_alike_classes(df.limit(0), "id", "title").count() == 0


def test_one_fit_for_several_columns_saved_and_loaded(spark, tmp_path):
    a = spark.createDataFrame([("оооо: a",), ("ｘ：",)], "t string")
    b = spark.createDataFrame([("oo: a",), ("x:",), (None,)], "u string")
    rules = lookalike.fit((a, "t"), (b, "u"))
    lookalike.save_rules(spark, rules, f"file://{tmp_path}/rules")
    assert lookalike.load_rules(spark, f"file://{tmp_path}/rules") == rules
    forms = lambda d, c: [r["f"] for r in lookalike.with_form(d, c, "f", rules).collect()]
    assert forms(a, "t")[1] == forms(b, "u")[1] and forms(a, "t")[0][0] == forms(b, "u")[0][0] and forms(b, "u")[2] is None


def test_no_text_has_two_forms(spark, tables):
    rows = lookalike.p2_forms(spark, tables).where("text is not null").select("text", "form").distinct()
    assert rows.groupBy("text").count().where("count > 1").count() == 0


def test_public_shapes_keep_case_and_digits_apart(spark):
    shapes = lookalike.public_shapes(spark)
    assert shapes["а"] == "a" and shapes["А"] == "A" and shapes["Ꭺ"] == "A" and len(shapes) > 200
    assert all(x.isascii() and o.islower() == x.islower() for o, x in shapes.items() if x.isalpha() and o.islower() != o.isupper())
    assert not set(shapes) & set("0123456789éßøæ")


def test_strings_are_nodes():
    classes = lookalike.shape_classes({"ﬁ": 9, "f": 1, "i": 1, "é": 2})
    assert classes.find("ﬁ") == classes.find("fi") == "fi" and classes.find("é") == "e\u0301"


LINKS = [
    "https://www.a.example/x/y-z?id=1&lang=en", " HTTP://A.example:80/x/y_z/?lang=en&id=1#top", "(//a.example/x/y.z?utm_source=q&id=1&lang=en)", "a.example/X/y%2Dz?id=1&amp;lang=en&ref",
    "https://a.example/x/y-z?id=2&lang=en", "https://b.example/x/y-z?id=1&lang=en", "https://a.example/x/y?id=1&lang=en", None, "", "   ", "https://a.example/%zz", "https://a.example/" + "w/" * 20_000,
]


def test_addresses(spark):
    df = spark.createDataFrame(list(enumerate(LINKS)), "id bigint, link string").withColumn("path", F.lit("extra"))
    got = {r["id"]: (r["address_digest"], r["address"]) for r in address.with_address(df, "link").collect()}
    assert len({got[i] for i in range(4)}) == 1
    assert len({got[i] for i in (0, 4, 5, 6, 10, 11)}) == 6
    assert all(got[i] == (None, None) for i in (7, 8, 9))
    found = {(r["first_id"], r["article_id"]) for r in address.copies_of_first(address.with_address(df, "link"), "id", address.KEYS).collect()}
    assert found == {(0, 1), (0, 2), (0, 3)}
    assert address.copies_of_first(address.with_address(df.limit(0), "link"), "id", address.KEYS).count() == 0
    with pytest.raises(ValueError):
        address.with_address(df.withColumn("address", F.lit(1)), "link")


def test_every_html_escape(spark):
    same = [["a.example/caf\u00e9", "a.example/caf&eacute;", "a.example/caf&#0233;", "a.example/caf&#x00E9;"], ["a.example/x-y", "a.example/x&#8211;y", "a.example/x&#x2013;y"], ["a.example/\u0142", "a.example/&#322;"], ["a.example/B"], ["a.example/p?x=1&copy=2"]]
    df = spark.createDataFrame([(k, x) for k, links in enumerate(same) for x in links], "k int, link string")
    got = {(r["k"], r["address"]) for r in address.with_address(df, "link").collect()}
    assert len(got) == len({a for _, a in got}) == len(same)


def test_merkle_digest(spark):
    kind = T.StructType([T.StructField("a", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("steps", T.ArrayType(T.StringType())), T.StructField("m", T.MapType(T.StringType(), T.StringType()))])
    rows = [({"a": "Hello, World", "tags": ["x", "y"], "steps": ["1", "2"], "m": {"k": "v", "l": "w"}},), ({"a": " hello world", "tags": ["y", "x"], "steps": ["1", "2"], "m": {"l": "w", "k": "v"}},), ({"a": "hello world", "tags": ["y", "x"], "steps": ["2", "1"], "m": {"l": "w", "k": "v"}},), ({"a": None, "tags": None, "steps": None, "m": None},)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("r", kind)]))
    d = [r["d"] for r in df.select(address.merkle_digest(F.col("r"), kind, frozenset({"tags"})).alias("d")).collect()]
    assert d[0] == d[1] != d[2] and d[3] is not None


def test_title_words():
    assert wordsets.title_words("Leаked: the pipeline, THE") == ["leaked", "pipeline", "the"]
    assert wordsets.title_words("为何A涨") == ["a", "为", "何", "涨"]
    assert wordsets.title_words("ПРОГНОЗ") == wordsets.title_words("прогноз")
    assert wordsets.title_words("Café") != wordsets.title_words("Cafe")
    assert wordsets.title_words("?!") == []
