"""Visually identical text with different characters, brought to one form.

Classes. A node is a string of one or more code points. A code point is united with its expansion (its canonical
decomposition, or the compatibility decomposition where that keeps the shape: full and half width, no-break, ligatures
and radicals, font variants, Arabic presentation forms; superscripts, circled, squared and small forms stay apart) and
with the letters of the same shape in other scripts: those that the public table of confusable characters (as ICU carries
it) gives the same skeleton as an ASCII letter of their own category, so that case and digits stay apart, besides a few of
SAME_SHAPE. Union-find closes this transitively. The representative of a class of single code points is its most frequent
member in the corpus (ties: lowest code point). A class that holds a string of several letters is represented by that
string, read over the representatives of its letters, and an accented letter by the composed form over its base's
representative: greedy rewriting towards ligatures would not be confluent ("ff"+"i", "f"+"fi").

Rewriting. Invisible characters go, blanks of any width become one space. Then an Aho-Corasick automaton over all members
that aren't representatives rewrites the text greedily, leftmost longest first, again as long as an accent is left that
composes with what stands before it.

Defined results: null stays null; empty, blank and invisible texts become ''; letter case, accents, digits and other
punctuation are kept; texts of any length are processed whole; equal texts get equal forms in whatever row they stand.

Scale: the counts are one map-side combined aggregation whose result is bounded by the code points of Unicode; the
rules made of them (some thousand strings) travel in the closure. Rewriting is a narrow Arrow step.
"""

from __future__ import annotations

import unicodedata as U
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import written

# Letters and signs of the shape of a Latin letter or an ASCII sign, by that letter or sign.
SAME_SHAPE = {
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "G": "Ԍ", "H": "НΗ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚ", "M": "МΜ", "N": "Ν",
    "O": "ОΟՕ", "P": "РΡ", "Q": "Ԛ", "S": "ЅՏ", "T": "ТΤ", "W": "Ԝ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ",
    "a": "а", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡ", "h": "һ", "i": "і", "j": "јϳ", "l": "ӏ", "o": "оοօ", "p": "р", "q": "ԛ",
    "s": "ѕ", "v": "ѵν", "w": "ԝ", "x": "х", "y": "уү",
    "-": "‐‑", "/": "⁄∕", ":": "∶꞉", "|": "∣ǀ", "!": "ǃ", "*": "∗",
}
#: Compatibility decompositions that keep the shape.
KEPT_TAGS = {"<wide>", "<narrow>", "<noBreak>", "<compat>", "<font>", "<isolated>", "<initial>", "<medial>", "<final>"}
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85  ⠀ㅤﾠ"


def invisible(c: str) -> bool:
    kind = U.category(c)
    return kind == "Cf" or (kind == "Cc" and c not in BLANKS) or c in "͏ᅟᅠ឴឵" or "︀" <= c <= "️" or "\U000e0100" <= c <= "\U000e01ef"


def blank(c: str) -> bool:
    return c in BLANKS or U.category(c) == "Zs"


def expansion(c: str) -> str:
    """Fully decomposed string of the same look; the code point itself where there is none."""
    if invisible(c):
        return ""
    if blank(c):
        return " "
    tag, _, rest = U.decomposition(c).rpartition("> ")
    if not rest or (tag and tag + ">" not in KEPT_TAGS):
        return U.normalize("NFD", c)
    out = "".join(map(expansion, (chr(int(x, 16)) for x in rest.split())))
    return c if out.startswith(" ") else out  # a free-standing accent is a sign of its own


class Classes:
    """Union-find over strings of code points; the root of a class is its representative."""

    def __init__(self, counts: dict[str, int] | None = None):
        self.parent: dict[str, str] = {}
        self.counts = counts or {}

    def find(self, c: str) -> str:
        while (p := self.parent.get(c, c)) != c:
            self.parent[c] = self.parent.get(p, p)
            c = p
        return c

    def better(self, a: str, b: str) -> bool:
        return (-len(a), -self.counts.get(a, 0), a) < (-len(b), -self.counts.get(b, 0), b)

    def union(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            a, b = (a, b) if self.better(a, b) else (b, a)
            self.parent[b] = a  # the root is always the best member

    def read(self, c: str) -> str:
        """The representative of a code point, decomposed; that of a longer string by its code points."""
        root = self.find(c)
        return root if len(root) == 1 else "".join(map(self.find, root))


class Reader(dict):
    """str.translate table that fills itself: code point -> string of representatives (decomposed)."""

    def __init__(self, classes: Classes):
        super().__init__()
        self.classes = classes

    def __missing__(self, cp: int) -> str:
        e = expansion(chr(cp))
        if e and e != " ":
            self.classes.union(chr(cp), e)
            e = self.classes.read(chr(cp))
        self[cp] = e
        return e


_shapes: dict[str, str] | None = None


def public_shapes(spark) -> dict[str, str]:
    """Letters of other scripts and forms -> the ASCII letter of their shape, by ICU's table of confusables; one call a session."""
    global _shapes
    if _shapes is None:
        # letters that are no decomposition of others; ideographs and syllable blocks look like none of ASCII
        found = [chr(c) for c in range(0x80, 0x20000) if not (0x2E80 <= c <= 0xA4CF or 0xAC00 <= c <= 0xD7FF or 0x13000 <= c <= 0x18FFF)]
        found = [c for c in found if U.category(c) in ("Lu", "Ll", "Lo") and not U.decomposition(c)]
        ascii_letters = [chr(c) for c in (*range(65, 91), *range(97, 123))]
        checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
        skeletons = checker.getSkeleton("\n".join(found + ascii_letters)).split("\n")
        of = {(k, U.category(c)): c for c, k in zip(ascii_letters, skeletons[len(found) :])}
        table = {c: of[k, U.category(c)] for c, k in zip(found, skeletons) if (k, U.category(c)) in of}
        _shapes = table | {o: x for x, others in SAME_SHAPE.items() for o in others}
    return _shapes


def listed_shapes() -> dict[str, str]:
    return {o: x for x, others in SAME_SHAPE.items() for o in others}


def shape_classes(counts: dict[str, int] | None = None, shapes: dict[str, str] | None = None) -> Classes:
    classes = Classes(counts)
    for other, letter in (listed_shapes() if shapes is None else shapes).items():
        classes.union(letter, other)
    for c in counts or ():
        e = expansion(c)
        if e and e != " ":
            classes.union(c, e)
    return classes


_plain_reader: Reader | None = None


def read_form(text: str) -> str:
    """The form with the lowest code points as representatives (Latin letters for their look-alikes); needs no corpus."""
    global _plain_reader
    if text.isascii() and text.isprintable():
        return " ".join(text.split())
    if _plain_reader is None:
        _plain_reader = Reader(shape_classes())
    return " ".join(U.normalize("NFC", text.translate(_plain_reader)).split())


def rewrite_rules(counts: dict[str, int], shapes: dict[str, str] | None = None) -> tuple[dict[int, str], dict[str, str]]:
    """(code points that vanish or become a space, member string -> representative string) for a corpus with these counts."""
    counts = {c: n for c, n in counts.items() if not "\ud800" <= c <= "\udfff"}
    classes = shape_classes(counts, shapes)
    reader = Reader(classes)
    gone = {ord(c): (" " if blank(c) else "") for c in counts if blank(c) or invisible(c)}
    rules: dict[str, str] = {}
    form = {c: U.normalize("NFC", reader[ord(c)]) for c in counts if ord(c) not in gone}
    # letters over which an accent may stand: every class member seen, and what their rules make of them
    for c, f in form.items():
        if f != c:
            rules[c] = f
    marks = [c for c in counts if U.combining(c)]
    letters = set(form) | {x for f in form.values() for x in f}
    for m in marks:
        for c in letters:
            if not U.combining(c):
                whole = U.normalize("NFC", reader[ord(c)] + m)
                if len(whole) <= len(U.normalize("NFC", reader[ord(c)])):
                    rules[c + m] = whole
    return gone, rules


class Rewriter:
    """Greedy rewriting by a multi-pattern automaton; built once a Python worker."""

    def __init__(self, gone: dict[int, str], rules: dict[str, str]):
        import ahocorasick

        self.gone, self.automaton = gone, ahocorasick.Automaton()
        for member, to in rules.items():
            self.automaton.add_word(member, (len(member), to))
        self.empty = not rules
        self.ascii_stays = not any(member.isascii() for member in rules)
        if rules:
            self.automaton.make_automaton()

    def once(self, text: str) -> str:
        out, at = [], 0
        for end, (n, to) in self.automaton.iter_long(text):
            out += (text[at : end + 1 - n], to)
            at = end + 1
        return "".join(out) + text[at:] if at else text

    def __call__(self, text: str) -> str:
        if self.ascii_stays and text.isascii() and text.isprintable():
            return " ".join(text.split())
        text = text.translate(self.gone)
        while not self.empty and (then := self.once(text)) != text:
            marked = not then.isascii() and any(map(U.combining, then))
            text = U.normalize("NFC", then) if marked else then
            if not marked:
                break
        return " ".join((text if text.isascii() else U.normalize("NFC", text)).split())


def code_point_counts(df: DataFrame, column: str) -> DataFrame:
    """cp bigint, n bigint over all texts of the column; at most one row per code point of Unicode."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0x110000, np.int64)
        for batch in batches:
            joined = "".join(x for x in batch[column] if x is not None)
            total += np.bincount(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), minlength=0x110000)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"cp": at, "n": total[at]})

    return df.select(column).mapInPandas(count, "cp bigint, n bigint").groupBy("cp").agg(F.sum("n").alias("n"))


Rules = tuple[dict[int, str], dict[str, str]]


def fit(*columns: tuple[DataFrame, str]) -> Rules:
    """One set of rules for the texts of all these (table, column). What comes to the driver is bounded by Unicode, not by the rows."""
    counts = reduce(DataFrame.unionByName, (code_point_counts(df, c) for df, c in columns)).groupBy("cp").agg(F.sum("n").alias("n"))
    return rewrite_rules({chr(r["cp"]): r["n"] for r in counts.collect()}, public_shapes(columns[0][0].sparkSession))


def save_rules(spark, rules: Rules, path: str) -> None:
    """As a table (kind, member, form), so that later texts get the forms of these."""
    rows = [("gone", chr(c), x) for c, x in rules[0].items()] + [("member", m, x) for m, x in rules[1].items()]
    spark.createDataFrame(rows, "kind string, member string, form string").coalesce(1).write.parquet(path)


def load_rules(spark, path: str) -> Rules:
    rows = spark.read.parquet(path).collect()  # bounded as in fit
    return {ord(r["member"]): r["form"] for r in rows if r["kind"] == "gone"}, {r["member"]: r["form"] for r in rows if r["kind"] == "member"}


def visual_form(rules: Rules):
    """Pandas UDF text -> form for fitted rules."""
    gone, members = rules

    @F.pandas_udf("string")
    def form(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        rewrite = Rewriter(gone, members)
        for texts in batches:
            yield texts.map(rewrite, na_action="ignore")

    return form


def with_form(df: DataFrame, column: str, out: str, rules: Rules | None = None) -> DataFrame:
    """df with the column's one form in a new column; fits the rules on the column itself unless given."""
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column already there: {out}")
    return df.withColumn(out, visual_form(rules or fit((df, column)))(F.col(f"`{column}`")))


def look_alike_pairs(df: DataFrame, id_column: str, column: str, rules: Rules | None = None) -> DataFrame:
    """id_a < id_b of rows with different strings of one form.

    Groups that hold one string only never leave the aggregation; the others are few and meet by a hash of the form, with
    the forms themselves compared after.
    """
    texts = df.where(F.col(column).isNotNull()).select(F.col(id_column).alias("id"), F.col(column).alias("text"))
    formed = with_form(texts, "text", "form", rules)
    formed = formed.select("id", "text", "form", F.xxhash64("form").alias("key"))
    mixed = formed.groupBy("key").agg(F.min(F.xxhash64("text")).alias("lo"), F.max(F.xxhash64("text")).alias("hi")).where("lo <> hi").select("key")
    some = formed.where("form <> ''").join(mixed, "key", "left_semi")
    a, b = some.alias("a"), some.alias("b")
    return a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id")) & (F.col("a.form") == F.col("b.form")) & (F.col("a.text") != F.col("b.text"))).select(
        F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")
    )


def look_alike_classes(df: DataFrame, id_column: str, column: str, rules: Rules | None = None) -> DataFrame:
    """id, class_id (the least id of its form), rows and variants (different strings) of the class, for forms of several strings.

    Says as much as the pairs in a row a record, however many copies a text has.
    """
    texts = df.where(F.col(column).isNotNull()).select(F.col(id_column).alias("id"), F.col(column).alias("text"))
    formed = with_form(texts, "text", "form", rules).where("form <> ''")
    formed = written(formed.select("id", F.xxhash64("text").alias("t"), F.xxhash64("form").alias("k1"), F.xxhash64(F.reverse("form"), F.length("form")).alias("k2")), "forms")
    strings = formed.groupBy("k1", "k2", "t").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    classes = strings.groupBy("k1", "k2").agg(F.min("id").alias("class_id"), F.sum("n").alias("rows"), F.count("*").alias("variants")).where("variants > 1")
    return formed.join(classes, ["k1", "k2"]).select("id", "class_id", "rows", "variants")


def _texts(spark, sf: str) -> tuple[list[tuple[str, DataFrame, str]], Rules]:
    """The two columns, and one set of rules for both."""
    texts = [(t, spark.read.parquet(f"{sf}/{t}.parquet"), c) for t, c in (("twitter_articles", "title"), ("web_articles", "snippet"))]
    return texts, fit(*[(d, c) for _, d, c in texts])


def p2_found(spark, sf: str) -> DataFrame:
    texts, rules = _texts(spark, sf)
    return reduce(DataFrame.unionByName, (look_alike_pairs(d, "article_id", c, rules) for _, d, c in texts))


def p2_classes(spark, sf: str) -> DataFrame:
    texts, rules = _texts(spark, sf)
    return reduce(DataFrame.unionByName, (look_alike_classes(d, "article_id", c, rules).select(F.lit(t).alias("table_name"), F.col("id").alias("article_id"), "class_id", "rows", "variants") for t, d, c in texts))


def p2_forms(spark, sf: str) -> DataFrame:
    """Every text of the two tables with its one form."""
    texts, rules = _texts(spark, sf)
    return reduce(DataFrame.unionByName, (with_form(d.select("article_id", F.col(c).alias("text")), "text", "form", rules) for _, d, c in texts))


def plain_form(column: Column) -> Column:
    """The corpus-free form, for operators that compare titles as they read to the eye."""

    @F.pandas_udf("string")
    def form(texts: pd.Series) -> pd.Series:
        return texts.map(read_form, na_action="ignore")

    return form(column)
