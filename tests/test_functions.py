"""Fixed cases of functions and of operators that no SQL states."""

import re

import pytest
from pyspark.sql import functions as F

from tessella.functions import paths as P, text as X, values as V
from tessella.operators import trees


def one(spark, value):
    return spark.range(1).select(value.alias("v")).first().v


@pytest.mark.parametrize("cell,want", [("true", True), ("TRUE", True), (" t ", True), ("Y", True), ("no", False), ("0", False), ("", None), ("maybe", None)])
def test_boolean(spark, cell, want):
    assert one(spark, V.boolean(F.lit(cell))) is want


@pytest.mark.parametrize("cell,want", [("11/4/2025", "2025-11-04"), ("25/12/2024", "2024-12-25"), ("June 2022", "June 2022"), ("1399420800000", "2014-05-07"), ("12345", "12345"), ("", "")])
def test_iso_date(spark, cell, want):
    assert one(spark, V.iso_date(F.lit(cell))) == want


@pytest.mark.parametrize("cell,want", [("2026-02-06", "Feb 2026"), ("1703548800000", "Dec 2023"), ("November 2022", "Nov 2022"), ("not a date", "")])
def test_release_month(spark, cell, want):
    assert one(spark, V.release_month(F.lit(cell))) == want


def test_natural_order(spark):
    df = spark.createDataFrame([(v,) for v in ("9.1.0", "10.4.0", "2.0.0-rc1", "2.0.0", "10.2.1")], "v string")
    assert [r.v for r in df.orderBy(V.natural_key(F.col("v"))).collect()] == ["2.0.0", "2.0.0-rc1", "9.1.0", "10.2.1", "10.4.0"]


@pytest.mark.parametrize("title,want", [("Data Management", "data-management"), ("Café® 2", "cafe-2"), ("---", "")])
def test_slug(spark, title, want):
    assert one(spark, X.slug(F.lit(title))) == want


def test_heading_anchor(spark):
    assert one(spark, X.heading_anchor(F.lit("Release 10.4.0"))) == "release-1040"
    assert one(spark, X.heading_anchor(F.lit("Know_the_Basics"))) == "know_the_basics"


@pytest.mark.parametrize("raw,want", [("images/a.png", "relative"), ("mailto:x@y", "absolute"), ("//cdn/x", "absolute"), ("/shared/a", "rooted"), ("#x", "fragment"), (" ", "empty")])
def test_reference_kind(spark, raw, want):
    assert one(spark, P.reference_kind(F.lit(raw))) == want


def test_reference_parts(spark):
    got = one(spark, P.split_reference(F.lit("..\\Images\\My%20Image.png?v=2#top")))
    assert tuple(got) == ("../Images/My Image.png", "v=2", "top")


def test_paths(spark):
    assert one(spark, P.resolve(F.lit("a/b"), F.lit("../../../x/./y"))) == "../x/y"
    assert one(spark, P.relative_to(F.lit("a/b"), F.lit("a/c/d.md"))) == "../c/d.md"
    assert one(spark, P.percent_decode(F.lit("a+b%20c"))) == "a+b c"
    assert one(spark, P.is_unsafe(F.lit("a/con.txt"))) and not one(spark, P.is_unsafe(F.lit("a/icon.txt")))


def test_normalise(spark):
    assert one(spark, X.normalise(F.lit("Ｆull “Quote”  —  ﬁn"))) == 'full "quote" - fin'
    assert one(spark, X.normalise(F.lit("5\u2032 a\u200bb\u00adc\u2026"), compatibility=False)) == "5' abc..."


@pytest.mark.parametrize("label,want", [("Note:", "note"), ("NOTES", "note"), ("notice", "note"), ("Remember", "note"), ("othernote", "note"), ("tip", "tip"), ("Hint!", "tip"), ("fastpath", "tip"), ("important", "important"), ("attention", "important"), ("restriction", "important"), ("warning", "warning"), ("trouble", "warning"), ("caution", "caution"), ("Danger", "caution"), ("tips", None)])
def test_alert_kind(spark, label, want):
    assert one(spark, X.alert_kind(F.lit(label))) == want


@pytest.mark.parametrize("title,stem,want", [("Developer’s Guide™", "x", "developers-guide"), ("", "1__Copy_Files_old", "copy-files"), ("Step_1", "Step_1", "step"), ("conn_SetRetryDelayLimit", "conn_SetRetryDel2", "conn-setretrydelaylimit"), ("R & D u0027s", "", "r-and-d-s"), ("The " + "word of the " * 9 + "end", "", "the-word-word-word-word-word-word-word-word-word"), ("x" * 60, "", "x" * 50)])
def test_page_stem(spark, title, stem, want):
    assert one(spark, X.page_stem(F.lit(title), F.lit(stem))) == want


def test_pack_starts_over(spark):
    rows = spark.createDataFrame([(1, i, i, w) for i, w in enumerate((5, 5, 20, 3, 4, 9))], "g int, node long, pos long, words long")
    assert [r.page for r in trees.pack(rows, "g", 10).orderBy("node").collect()] == [0, 0, 1, 2, 2, 3]


def test_shingles_take_the_words_once(spark):
    texts = [None, "", "a b", " ".join("abcdefgh"), " ".join("abcdefghi"), "x " * 40, "Ab c-d e_f. " * 9, " ".join(f"w{i % 300}" for i in range(20000)), "a." * 20000 + "a"]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string").select("n", X.shingles(X.words(F.col("t"))).alias("s"))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    got = dict(map(tuple, rows.collect()))
    for n, text in enumerate(texts):
        w = text and re.findall(r"[a-z0-9]+(?:['.\-_/][a-z0-9]+)*", text)
        want = None if text is None else list(dict.fromkeys(" ".join(w[i : i + 8]) for i in range(max(len(w) - 7, 1)))) if w else []
        assert got[n] == want
