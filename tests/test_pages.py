"""Fixed cases of pages: HTML, Markdown, coverage, layout, registries; and a log whose merge is interrupted."""

import pytest
from pyspark.sql import functions as F

from tessella.operators import documents as D, html as H, layout as Y, markdown as M, registries as G
from tessella.sources import readers as R, writers as W
from tessella.streaming import events as S


def one(spark, value):
    return spark.range(1).select(value.alias("v")).first().v


@pytest.mark.parametrize(
    "html,want",
    [
        ("<body><h1>A <b>b</b></h1><p>x &amp; y<br>z<!-- no --><script>no</script><ul><li>one<li>two</ul>tail", ["A b", "x & y z", "one", "two", "tail"]),
        ("<p>a<hr>b</p>", ["a", "b"]),
        ("<p>a<img src=x>b<wbr>c<button>no</button><select><option>no</select></p>", ["abc"]),
        ("<table><tbody><tr><td>1<td>2</table>", ["1", "2"]),
        ("<span><div>a</div><div>b</div></span>c", ["abc"]),
        ("", []),
    ],
)
def test_blocks(html, want):
    assert H.blocks(H.parse(html)) == want


def test_blocks_leave_the_head_out(spark):
    assert one(spark, H.html_blocks(F.lit("<head><title>t</title></head><body>x</body>"))) == ["x"]


def test_container_text(spark):
    page = '<div id="m" class="a b"><p>in</p><p class="ad">no</p></div><p>out</p>'
    for selector in ("#m", "div.a.b", "div[id=m]", "x, .b"):
        assert one(spark, H.container_blocks(F.lit(page), selector, [".ad"])) == ["in"]
    assert one(spark, H.container_blocks(F.lit(page), ".none")) is None


@pytest.mark.parametrize(
    "html,want",
    [
        ("<h2>T</h2><p>a <em>b</em> <a href='x.htm'>c</a></p>", "## T\n\na *b* [c](x.htm)"),
        ("<ol><li>one</li><li>two<ul><li>in</li></ul></li></ol>", "1. one\n2. two\n   - in"),
        ("<ul><li><p>a</p><p>b</p></li></ul>", "- a\n\n  b"),
        ("<p>say<b> x </b>now<br>then</p>", "say **x** now\\\nthen"),
        ("<pre>a\n```\nb</pre>", "````\na\n```\nb\n````"),
        ("<table><tr><th>A|</th><th>B</th></tr><tr><td><p>1</p></td><td>2<br>3</td></tr></table>", "| A\\| | B |\n| --- | --- |\n| 1 | 2<br>3 |"),
        ("<table><tr><td>1</td><td>2</td></tr></table>", "|  |  |\n| --- | --- |\n| 1 | 2 |"),
        ("<table><tr><td colspan=2>1</td></tr></table>", '<table>\n<tr><td colspan="2">1</td></tr>\n</table>'),
        ("<dl><dt>t</dt><dd><p>d</p><dl><dt>u</dt><dd>e</dd></dl></dd></dl>", "**t**\n\nd\n\n**u**\n\ne"),
        ("<p><code>a`b</code><img src='i.png' alt='x  y'></p>", "``a`b``![x y](i.png)"),
    ],
)
def test_markdown(html, want):
    assert H.renderer("plain").page(html) == want


@pytest.mark.parametrize("cells,want", [("<td>a<td>b", None), ("<td rowspan=2>a", "span"), ("<td><table></table>", "nested"), ("<td><p>a</p><p>b</p>", "blocks"), ("<td><ul><li>a</ul>", "blocks"), ("<td><div><p>a</p></div>", None), ("<td>x<p>a</p>", "blocks")])
def test_pipe_tables(cells, want):
    table = next(n for n in H.parse(f"<table><tr>{cells}</tr></table>").walk() if n.tag == "table")
    assert H.unsafe(H.table_rows(table)[0]) == want


def test_dialects_are_registered_once():
    with pytest.raises(ValueError):
        H.register("plain")(type("Other", (H.Renderer,), {}))
    with pytest.raises(ValueError):
        H.renderer("unknown")


@pytest.mark.parametrize(
    "text,want",
    [
        ("> [!TIP]\n>\n> body\n", "> **Tip:**\n> body\n"),
        ("> [!danger]\n> x", "> **Caution:**\n> x"),
        ("> **Note:**\n> **Remember:** hey\n", "> **Remember:**\n> hey\n"),
        ("> [!NOTE]\n> **Notes:**\n> hey\n", "> **Notes:**\n> hey\n"),
        ("- > [!WOW]\n  > | a |\n", "- > **Note:**\n  >\n  > | a |\n"),
        ("> **Third-Party:**\n>\n> stays\n", "> **Third-Party:**\n>\n> stays\n"),
        ("```\n> [!NOTE]\n```\n", "```\n> [!NOTE]\n```\n"),
        ("> [!NOTE]\r\n> a\r\n", "> **Note:**\r\n> a\r\n"),
    ],
)
def test_callouts(text, want):
    assert M.repaired(text) == want and M.repaired(want) == want


def test_references():
    text = 'a [x](b.md "t") `[n](q)` ![i](c.png)\n\n<https://e.x> b\n[![z](i.png)](t.md)\n[r]: d.md\n\n<table><a href=\'h.md\'>[not](k)</a>\n\n~~~\n[no](n)\n~~~\n'
    assert sorted((r["raw"], r["line"], r["syntax"]) for r in M.references_of(text)) == sorted([("b.md", 1, "markdown"), ("c.png", 1, "markdown"), ("https://e.x", 3, "markdown"), ("i.png", 4, "markdown"), ("t.md", 4, "markdown"), ("d.md", 5, "markdown"), ("h.md", 7, "html")])
    masked = M.masked(text)
    assert len(masked) == len(text) and masked.count("\n") == text.count("\n") and "[no]" not in masked and "[n]" not in masked


def test_links_are_retargeted(spark):
    pages = spark.createDataFrame([("p", "[x](b.md#f) [y](c.md) `[x](b.md)` [z](d.md)"), ("q", "[x](b.md)"), ("r", None)], "page string, text string")
    located = spark.createDataFrame([("p", "b.md", "N.md"), ("p", "c.md", "P.md#a")], "page string, target string, new string")
    assert {r.page: r.text for r in M.retarget(pages, located).collect()} == {"p": "[x](N.md#f) [y](P.md#a) `[x](b.md)` [z](d.md)", "q": "[x](b.md)", "r": None}


def test_shifted_headings():
    assert M.shifted("# A\n\n## B\n```\n# no\n```\n###### F\n", "T", 2) == "## A\n\n### B\n```\n# no\n```\n###### F\n"
    assert M.shifted("", "T", 3) == "### T"


def test_heading_compaction(spark):
    assert one(spark, D.compact_headings(F.array(*map(F.lit, [1, 2, 2, 6, 6, 2, 6, 6])))) == [1, 2, 2, 3, 3, 2, 3, 3] == H.compacted([1, 2, 2, 6, 6, 2, 6, 6])


def test_coverage(spark):
    text = "the quick brown fox jumps over the lazy dog today. never said this at all. hm no. resultyou see it."
    rows = spark.createDataFrame([(1, [text]), (2, [])], "k int, blocks array<string>")
    target = spark.createDataFrame([(1, ["so the quick brown fox jumps over", "the lazy dog today.", "result", "you see it."])], "k int, blocks array<string>")
    got = {r.k: (r.words, r.present, r.missing, r.percent) for r in D.coverage(rows, target, "k").collect()}
    assert got == {1: (20, 15, 1, 75.0), 2: (0, 0, 0, 100.0)}


def test_no_sentence_spans_two_blocks(spark):
    rows = spark.createDataFrame([(1, ["a b c"])], "k int, blocks array<string>")
    target = spark.createDataFrame([(1, ["a b", "c"])], "k int, blocks array<string>")
    assert [r.judged[0].there for r in D.sentences_present(rows, target, "k").collect()] == [False]


def tree(spark, rows):
    return spark.createDataFrame([(1, *r) for r in rows], "tree int, node int, parent int, pos int, title string")


def test_titles_are_matched_in_order(spark):
    local = tree(spark, [(1, None, 1, "A"), (2, 1, 1, "x"), (3, None, 2, "B"), (4, None, 3, "B"), (5, None, 4, "C"), (6, 5, 1, "y")])
    served = tree(spark, [(1, None, 1, "B"), (2, None, 2, "a!"), (3, 2, 1, "z"), (4, None, 3, "B"), (5, 4, 1, "C")])
    got = {(r.kind, r.path) for r in Y.compare_titles(local, served).collect()}
    assert got == {("title", "A > x"), ("moved", "C"), ("missing", "C > y"), ("order", "(top)")}


def test_pins_settle_against_the_final_paths(spark):
    rows = [(1, 0, "a", "a.md", "b.md"), (1, 1, "b", "b.md", "c.md"), (1, 2, "c", "c.md", None), (1, 3, "d", "d.md", "E.md"), (1, 4, "e", "e.md", "f.md"), (1, 5, "g", "g.md", "F.md")]
    got = {r.key: (r.path, r.verdict) for r in Y.pinned(spark.createDataFrame(rows, "tree int, pos int, key string, path string, wanted string")).collect()}
    assert got == {"a": ("a.md", "refused"), "b": ("b.md", "refused"), "c": ("c.md", "kept"), "d": ("E.md", "applied"), "e": ("f.md", "applied"), "g": ("g.md", "refused")}


def test_long_chains_alone_are_cut(spark):
    rows = [(1, 0, "a", "short/page.md"), (1, 1, "b", "a-very-long-folder-name-of-the-guide/page-one-with-words.md"), (1, 2, "c", "a-very-long-folder-name-of-the-guide/page-one-with-other.md")]
    got = {r.key: (r.path, r.cap) for r in Y.fitted(spark.createDataFrame(rows, "tree int, pos int, key string, path string"), 40).collect()}
    assert got["a"][0] == "short/page.md" and all(len(p) <= 40 for p, _ in got.values()) and len({p for p, _ in got.values()}) == 3
    assert got["b"][0].startswith("a-very-long") and 8 <= got["b"][1] < 49


def test_registries():
    codes = dict(G.CODES)
    G.code("TEST_CODE", "note", "verify")
    with pytest.raises(ValueError):
        G.code("TEST_CODE", "error", "verify")
    G.CODES.clear()
    G.CODES.update(codes)
    with pytest.raises(ValueError):
        G.repair("R001", "again", len, str)


def test_table_function_equals_the_column_form(spark):
    G.install(spark)
    docs = spark.createDataFrame([(1, "[a](b.md) ![c](d.png)"), (2, None)], "k int, md string")
    by_sql = spark.sql("SELECT k, r.* FROM {docs} d, LATERAL references(d.md) r", docs=docs).collect()
    by_column = docs.select("k", F.explode(M.references(F.col("md"))).alias("r")).select("k", "r.*").collect()
    assert sorted(by_sql) == sorted(by_column) and len(by_sql) == 2


def test_rule_tables_are_checked(spark):
    assert R.rule_table(spark, "- {name: a, n: 1}\n- {name: b}", ["name", "n"], "name").collect() == [("a", "1"), ("b", None)]
    for bad in ("- {name: a}\n- {name: a}", "- {other: 1}", "a: b"):
        with pytest.raises(ValueError):
            R.rule_table(spark, bad, ["name"], "name")


def test_unsafe_and_conflicting_members(spark):
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in (("a.txt", "1"), ("A.txt", "2"), ("b.txt", "1"), ("B.txt", "1"), ("../x", "1")):
            z.writestr(name, text)
    members = R.archive(spark.createDataFrame([("z", out.getvalue())], "path string, content binary"))
    assert {r.member for r in members.where("unsafe").collect()} == {"../x"}
    assert [r.name for r in R.archive_conflicts(members).collect()] == ["a.txt"]


def test_a_merge_that_was_interrupted_loses_nothing(spark, tmp_path):
    base = f"file://{tmp_path}"
    events = spark.createDataFrame([("p", "1", "s", "ok", 1), ("q", "1", "s", "failed", 2)], "slug string, version string, stage string, outcome string, happened int")
    events.coalesce(1).write.parquet(f"{base}/in/1")
    stream = lambda: spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(f"{base}/in")
    S.keep_current(spark, stream(), f"{base}/log", f"{base}/checkpoint").awaitTermination()
    (tmp_path / "log").rename(tmp_path / "log.old")  # as if stopped between the two renames
    events.where("slug = 'p'").withColumn("happened", F.lit(7)).coalesce(1).write.parquet(f"{base}/in/2")
    S.keep_current(spark, stream(), f"{base}/log", f"{base}/checkpoint").awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(f"{base}/log").collect()} == {("p", "1", "s", 7, None), ("q", "1", "s", None, 2)}
    assert not W.exists(spark, f"{base}/log.old")


def test_watermarked_streams(spark, tmp_path):
    rows = spark.sql("SELECT id % 3 AS event_id, timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id % 3) AS happened, 's' AS stage, 'ok' AS outcome FROM range(9)")
    rows.write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"file://{tmp_path}/in")
    for name, df, want in (("first_seen", S.first_seen(stream), 3), ("windowed", S.windowed(stream), 0)):
        df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"file://{tmp_path}/{name}").trigger(availableNow=True).start().awaitTermination()
        assert spark.table(name).count() >= want
