"""Queries over pages: HTML, Markdown, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessella.functions import paths as P
from tessella.operators import documents as D, html as H, layout as Y, markdown as M, registries as G
from tessella.plans import samples  # noqa: F401  (it registers an engine and a format)
from tessella.plans.model import relation
from tessella.plans.registry import query, scalar
from tessella.sources import readers as R

_c = F.col
_word = r"'[a-z0-9]+(?:[''.\-_/][a-z0-9]+)*'"
#: Sentences of `s` (doc_id, blocks) judged by the blocks of `t`: doc_id, sentence, n, there.
_judged = rf"""sl AS (SELECT doc_id, unnest(blocks) AS line FROM s), ss AS (SELECT doc_id, unnest(list_filter([trim(x) FOR x IN string_split(regexp_replace(line, '([.!?:;])\s+', '\1␟', 'g'), '␟')], lambda x: x <> '')) AS sentence FROM sl),
    sw AS (SELECT doc_id, sentence, regexp_extract_all(sentence, {_word}) AS w FROM ss),
    tl AS (SELECT doc_id, unnest(blocks) AS line, generate_subscripts(blocks, 1) AS pos FROM t), tw AS (SELECT doc_id, pos, line, regexp_extract_all(line, {_word}) AS w FROM tl),
    tt AS (SELECT doc_id, ' ' || string_agg(array_to_string(w, ' '), ' | ' ORDER BY pos) || ' ' AS joined, string_agg(regexp_replace(line, '[^a-z0-9]+', '', 'g'), '' ORDER BY pos) AS letters, flatten(list(CASE WHEN len(w) >= 8 THEN [array_to_string(w[i:i+7], ' ') FOR i IN range(1, len(w) - 6)] ELSE [] END)) AS runs FROM tw GROUP BY 1),
    sm AS (SELECT sw.doc_id, sentence, w, len(w) AS n, coalesce(joined, ' ') AS joined, coalesce(letters, '') AS letters, coalesce(runs, []) AS runs, CASE WHEN len(w) >= 8 THEN list_distinct([array_to_string(w[i:i+7], ' ') FOR i IN range(1, len(w) - 6)]) ELSE [] END AS mine FROM sw LEFT JOIN tt USING (doc_id) WHERE len(w) > 0),
    judged AS (SELECT doc_id, sentence, n, contains(joined, ' ' || array_to_string(w, ' ') || ' ') OR (n >= 4 AND contains(letters, regexp_replace(sentence, '[^a-z0-9]+', '', 'g'))) OR (n >= 8 AND len(list_intersect(mine, runs)) >= 0.8 * len(mine)) AS there FROM sm)"""
_sums = "sum(n)::bigint AS words, sum(CASE WHEN there OR n < 4 THEN n ELSE 0 END)::bigint AS present, count(*) FILTER (NOT there AND n >= 4) AS missing"


def _blocks(docs: DataFrame, text) -> DataFrame:
    return docs.select("doc_id", F.split(text, "\n").alias("blocks"))


@query(
    rf"""WITH s AS (SELECT doc_id, string_split(lower(text), chr(10)) AS blocks FROM {{documents}} WHERE text IS NOT NULL), t AS (SELECT doc_id, string_split(regexp_replace(lower(text), ' (the|of) ', ' ', 'g'), chr(10)) AS blocks FROM {{documents}} WHERE text IS NOT NULL), {_judged},
    sums AS (SELECT doc_id, {_sums} FROM judged GROUP BY 1)
    SELECT s.doc_id, coalesce(words, 0) AS words, coalesce(present, 0) AS present, coalesce(missing, 0) AS missing, CASE WHEN coalesce(words, 0) = 0 THEN 100.0 ELSE round_even(present * 100.0::double / words, 1) END AS percent FROM s LEFT JOIN sums USING (doc_id)"""
)
def f112_text_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = relation(spark, sf_dir, "documents").where("text is not null")
    return D.coverage(_blocks(docs, F.lower("text")), _blocks(docs, F.regexp_replace(F.lower("text"), " (the|of) ", " ")), "doc_id")


@query(rf"WITH s AS (SELECT doc_id, string_split(lower(text), chr(10)) AS blocks FROM {{documents}}), t AS (SELECT doc_id + 1 AS doc_id, blocks FROM s), {_judged} SELECT doc_id, sentence, n AS words, there FROM judged")
def f152_sentence_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of every document, looked for in the document before it."""
    docs = _blocks(relation(spark, sf_dir, "documents"), F.lower("text"))
    found = D.sentences_present(docs, docs.withColumn("doc_id", _c("doc_id") + 1), "doc_id")
    return found.select("doc_id", F.explode("judged").alias("e")).select("doc_id", "e.*")


# HTML. No SQL parses it; tests hold the parser and the renderers against fixed pages.


@query(r"""SELECT page_id, tag, len(regexp_extract_all(regexp_replace(html, '(?s)<script>.*?</script>|<!--.*?-->', '', 'g'), '<' || tag || '[ >]')) AS n FROM {pages}, (SELECT unnest(['p', 'a', 'li', 'h1', 'article', 'div', 'b']) AS tag) t""")
def f017_html_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many elements of some kinds each page's tree has."""
    tags = F.explode(F.array(*map(F.lit, ["p", "a", "li", "h1", "article", "div", "b"]))).alias("tag")
    return relation(spark, sf_dir, "pages").select("page_id", H.tag_counts(_c("html")).alias("m"), tags).select("page_id", "tag", F.coalesce(F.element_at("m", _c("tag")), F.lit(0)).cast("long").alias("n"))


@query()
def f194_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, "pages").select("page_id", F.posexplode(H.html_blocks("html")).alias("pos", "block"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1), '\s+', ' ', 'g')) AS text FROM (SELECT page_id, replace(replace(replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&') AS html FROM {pages}) t WHERE html LIKE '%<footer>%'")
def f195_container_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of each page's footer."""
    found = relation(spark, sf_dir, "pages").select("page_id", F.array_join(H.container_blocks(_c("html"), "footer", ["button", ".ad"]), " ").alias("text"))
    return found.where("text is not null")


@query()
def f199_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, "pages").select("page_id", H.to_markdown(_c("html")).alias("markdown"))


_cell = "p_name || ' <b>' || p_brand || '</b> ' || p_type"


@query("SELECT p_partkey, 'See **' || p_name || '** and *' || p_brand || '* in `' || p_type || '` [' || p_name || '](' || p_partkey || '.htm) ![' || p_brand || '](i.png)\\' || chr(10) || 'end' AS markdown FROM {part}")
def f200_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.concat(F.lit("<p>See <b>"), "p_name", F.lit(" </b>and <em>"), "p_brand", F.lit("</em> in <code>"), "p_type", F.lit("</code> <a href='"), _c("p_partkey").cast("string"), F.lit(".htm'>"), "p_name", F.lit("</a> <img src='i.png' alt='"), "p_brand", F.lit("'><br>end</p>"))
    return relation(spark, sf_dir, "part").select("p_partkey", H.to_markdown(html).alias("markdown"))


@query(
    """SELECT p_partkey, CASE p_partkey % 5 WHEN 1 THEN 'span' WHEN 2 THEN 'nested' WHEN 3 THEN 'blocks' WHEN 4 THEN 'ragged' END AS reason, CASE WHEN p_partkey % 2 = 0 THEN 0 END AS header, p_name || ' ' || p_brand AS first FROM {part}
    UNION ALL SELECT p_partkey, NULL, NULL, p_type FROM {part} WHERE p_partkey % 5 = 2"""
)
def f201_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, tag = _c("p_partkey") % 5, F.when(_c("p_partkey") % 2 == 0, "th").otherwise("td")
    second = F.when(kind == 1, "<td colspan=2>s</td>").when(kind == 2, F.concat(F.lit("<td><table><tr><td>"), "p_type", F.lit("</td></tr></table></td>"))).when(kind == 3, "<td><p>a</p><p>b</p></td>").when(kind == 4, "").otherwise("<td><div><p>b</p></div></td>")
    html = F.concat(F.lit("<table><tr><"), tag, F.lit(">"), "p_name", F.lit(" <i>"), "p_brand", F.lit("</i></"), tag, F.lit("><"), tag, F.lit(">x</"), tag, F.lit("></tr><tbody><tr><td>1</td>"), second, F.lit("</tr></tbody></table>"))
    found = relation(spark, sf_dir, "part").select("p_partkey", F.explode(H.tables(html)).alias("t"))
    return found.select("p_partkey", "t.reason", "t.header", _c("t.rows")[0][0].alias("first"))


@query("SELECT p_partkey, 'term: ' || p_name || '|definition: ' || p_brand || ' ' || p_type || '|term: b|definition: c' AS entries FROM {part}")
def f204_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.concat(F.lit("<div class='x dl'><div class=dlentry><span class='dt'>"), "p_name", F.lit("</span><div class='dd'><p>"), "p_brand", F.lit(" "), "p_type", F.lit("</p></div></div></div><p class=dd>no</p><dl><dt>b</dt><dd>c</dd></dl>"))
    return relation(spark, sf_dir, "part").select("p_partkey", F.array_join(H.definition_lists(html), "|").alias("entries"))


@query("SELECT p_partkey, p_brand AS alt, sha256(p_name) AS digest FROM {part} WHERE p_partkey % 4 <> 0")
def f213_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures of each page, resolved against the page's folder, with the digest of the file that is there."""
    part = relation(spark, sf_dir, "part")
    html = F.concat(F.lit("<p><img alt='"), "p_brand", F.lit("' src='../i/./"), _c("p_partkey").cast("string"), F.lit(".png'><img src=' '></p>"))
    used = part.select("p_partkey", F.explode(H.images(html)).alias("i")).select("p_partkey", "i.alt", P.resolve(F.lit("g/pages"), _c("i.src")).alias("path"))
    files = part.where("p_partkey % 4 <> 0").select(F.concat(F.lit("g/i/"), _c("p_partkey").cast("string"), F.lit(".png")).alias("path"), F.sha2("p_name", 256).alias("digest"))
    return used.join(files, "path").select("p_partkey", "alt", "digest")


@query("SELECT p_partkey, '# ' || p_name || chr(10) || chr(10) || '> **' || ['Note', 'Tip', 'Caution', 'Warning'][p_partkey % 4 + 1] || ':**' || chr(10) || '> ' || p_brand AS markdown FROM {part}")
def f214_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One box in the four vocabularies, written alike."""
    kind, four = _c("p_partkey") % 4, lambda *x: F.element_at(F.array(*map(F.lit, x)), (_c("p_partkey") % 4 + 1).cast("int"))
    head = F.concat(F.when(kind == 3, "<div class='Heading1'>").otherwise("<h1>"), "p_name", F.when(kind == 3, "</div>").otherwise("</h1>"))
    box = F.concat(four('<p class="x" data-mc-autonum="&lt;b&gt;Note: &lt;/b&gt;">', '<div class="note tip note_tip"><span class="tiptitle">Tip:</span> ', '<div class="caution"><h3>Caution</h3><p>', '<table class="IconTable"><tr><td><div class="IconWarning"></div></td><td>'), "p_brand", four("</p>", "</div>", "</p></div>", "</td></tr></table>"))
    pages = relation(spark, sf_dir, "part").select("p_partkey", F.concat(head, box).alias("html"), kind.alias("kind"))
    out = None
    for n, name in enumerate(("flare", "dita", "docbook", "webworks")):
        part = pages.where(_c("kind") == n).select("p_partkey", H.to_markdown(_c("html"), name).alias("markdown"))
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT p_partkey, '# ' || p_name || chr(10) || chr(10) || '## ' || p_brand || chr(10) || chr(10) || '## ' || p_type || chr(10) || chr(10) || '### end' AS markdown FROM {part}")
def f203_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings written without gaps: 1, 4, 3, (an empty one), 6 become 1, 2, 2, 3."""
    html = F.concat(F.lit("<h1>"), "p_name", F.lit("</h1><h4>"), "p_brand", F.lit("</h4><h3>"), "p_type", F.lit("</h3><h5> </h5><h6>end</h6>"))
    return relation(spark, sf_dir, "part").select("p_partkey", H.to_markdown(html).alias("markdown"))


@query("SELECT p_partkey, '# a' || chr(10) || chr(10) || '## ' || p_name || chr(10) || chr(10) || '### ' || p_brand AS markdown FROM {part}")
def f273_mixed_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-named and real headings numbered in one pass."""
    html = F.concat(F.lit("<div class=Heading1>a</div><h3>"), "p_name", F.lit("</h3><div class=Heading6>"), "p_brand", F.lit("</div>"))
    return relation(spark, sf_dir, "part").select("p_partkey", H.to_markdown(html, "webworks").alias("markdown"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '3. ' || p_name || chr(10) || '4. ' || p_brand ELSE '- ' || p_name || chr(10) || '- ' || p_brand END AS markdown FROM {part}")
def f269_fake_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = F.when(_c("p_partkey") % 2 == 0, "3.").otherwise("&#8226;")
    html = F.concat(F.lit("<table class='AutoNumber_p_Item'><tr><td data-mc-autonum='"), mark, F.lit("'>"), "p_name", F.lit("</td></tr><tr><td data-mc-autonum='x'>"), "p_brand", F.lit("</td></tr></table>"))
    return relation(spark, sf_dir, "part").select("p_partkey", H.to_markdown(html, "flare").alias("markdown"))


@query("SELECT p_partkey, p_name || ' (' || p_brand || ')' AS markdown FROM {part}")
def f271_popups(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.concat(F.lit("<p><a class='MCTextPopup'>"), "p_name", F.lit("<span class='MCTextPopupBody'>"), "p_brand", F.lit("</span></a></p>"))
    return relation(spark, sf_dir, "part").select("p_partkey", H.to_markdown(html, "flare").alias("markdown"))


# Markdown


def _md():
    """A document with front matter, code, and three references at its end."""
    return F.concat(F.lit("---\nt: x\n---\n# A `b`\n```\n[n](no.md)\n```\n"), F.regexp_replace("text", r"[`\[\]<>|#*]", " "), F.lit("\n[one *x*](a%20b.md \"t\") ![p](i.png) <a href='h.htm'>H &amp; i</a>\n"))


_lines = "len(string_split(text, chr(10)))"
_plain = r"regexp_replace(text, '[`\[\]<>|#*]', ' ', 'g')"

scalar("f206_mask_code", "documents", "doc_id", lambda: F.md5(M.mask_code(_md())), rf'''md5('   ' || chr(10) || '    ' || chr(10) || '   ' || chr(10) || '# A    ' || chr(10) || '   ' || chr(10) || '          ' || chr(10) || '   ' || chr(10) || {_plain} || chr(10) || '[one *x*](a%20b.md "t") ![p](i.png) <a href=''h.htm''>H &amp; i</a>' || chr(10))''')


@query(f"SELECT doc_id, e.raw AS raw, e.syntax AS syntax, cast({_lines} + 8 AS int) AS line FROM {{documents}}, (VALUES ('a%20b.md', 'markdown'), ('i.png', 'markdown'), ('h.htm', 'html')) e(raw, syntax) WHERE text IS NOT NULL")
def f207_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.explode(M.references(_md())).alias("r")).select("doc_id", "r.raw", "r.syntax", "r.line")


@query(f"SELECT doc_id, cast({_lines} + 8 AS int) AS line, e.target AS target, e.text AS text FROM {{documents}}, (VALUES ('a%20b.md', 'one *x*'), ('h.htm', 'H & i')) e(target, text) WHERE {{documents}}.text IS NOT NULL".replace(_lines, "len(string_split(documents.text, chr(10)))"))
def f209_labelled_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.explode(M.labelled_links(_md())).alias("r")).select("doc_id", "r.*")


scalar("f202_callouts", "documents", "doc_id", lambda: M.callouts(F.concat(F.lit("> [!danger]\n>\n> "), F.split_part("text", F.lit("\n"), F.lit(1)), F.lit("\n\n> **Note:**\n> **Notes:** "), _c("source"), F.lit("\n```\n> [!TIP]\n```\n"))), "'> **Caution:**' || chr(10) || '> ' || split_part(text, chr(10), 1) || chr(10) || chr(10) || '> **Notes:**' || chr(10) || '> ' || source || chr(10) || '```' || chr(10) || '> [!TIP]' || chr(10) || '```' || chr(10)")
scalar("f211_heading_shift", "documents", "doc_id", lambda: M.shift_headings(F.concat(F.when(_c("doc_id") % 2 == 0, "# T\n\n").otherwise(""), F.lit("## S\n\n```\n# no\n```\n###### D "), _c("source")), F.concat(F.lit("Title of "), "source"), F.lit(3)), "CASE WHEN doc_id % 2 = 0 THEN '### T' ELSE '### Title of ' || source END || chr(10) || chr(10) || '#### S' || chr(10) || chr(10) || '```' || chr(10) || '# no' || chr(10) || '```' || chr(10) || '###### D ' || source")
scalar("f239_repair", "documents", "doc_id", lambda: F.to_json(G.apply_repair(F.concat(F.lit("> [!TIP]\n> "), _c("source"), F.lit("\n\n> [!what]\n")), "R001")), """'{"hits":2,"text":"> **Tip:**\\n> ' || source || '\\n\\n> **Note:**\\n"}'""")


@query("WITH RECURSIVE l AS (SELECT doc_id, [cast(length(x) % 6 + 1 AS int) FOR x IN string_split(text, chr(10))] AS a FROM {documents}), r AS (SELECT doc_id, a, 0 AS i, cast([] AS int[]) AS above, cast([] AS int[]) AS out FROM l UNION ALL SELECT doc_id, a, i + 1, list_append(list_filter(above, lambda x: x < a[i + 1]), a[i + 1]), list_append(out, cast(least(list_min(a) + len(list_filter(above, lambda x: x < a[i + 1])), 6) AS int)) FROM r WHERE i < len(a)) SELECT doc_id, array_to_string(out, ',') AS value FROM r WHERE i = len(a)")
def f126_heading_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = F.transform(F.split("text", "\n"), lambda x: (F.length(x) % 6 + 1).cast("int"))
    return relation(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.array_join(D.compact_headings(levels).cast("array<string>"), ",").alias("value"))


@query("SELECT fid, 'See [it](new/' || path || '#top) and [out](gone.md), `[it](' || path || ')`' AS text FROM {files}")
def f092_link_retarget(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = relation(spark, sf_dir, "files")
    pages = files.select(_c("fid").alias("page"), F.concat(F.lit("See [it]("), "path", F.lit("#top) and [out](gone.md), `[it]("), "path", F.lit(")`")).alias("text"))
    located = files.select(_c("fid").alias("page"), _c("path").alias("target"), F.concat(F.lit("new/"), "path").alias("new"))
    return M.retarget(pages, located).select(_c("page").alias("fid"), "text")


@query("SELECT tree, repeat(' ', CASE WHEN node = 1 THEN 0 ELSE 2 END) || CASE WHEN node = 1 THEN '- ' ELSE (node + 2) || '. ' END || title AS line FROM {menus}")
def f267_list_nesting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each tree's rows as one list: a bullet, and below it a run that begins with 4."""
    item = F.struct("node", F.when(_c("node") == 1, 2).otherwise(5).alias("depth"), (_c("node") > 1).alias("ordered"), F.lit(4).alias("number"), _c("title").alias("text"))
    runs = relation(spark, sf_dir, "menus").groupBy("tree").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return runs.select("tree", F.explode(Y.nest(_c("items"))).alias("line"))


@query("SELECT slug, release, CASE release % 4 WHEN 0 THEN 'unreadable' WHEN 1 THEN 'empty' WHEN 2 THEN 'unparseable' ELSE 'ok' END AS status FROM (SELECT DISTINCT slug, release FROM {ids}) t")
def f020_help_map_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = relation(spark, sf_dir, "ids").select("slug", "release").distinct()
    text = F.element_at(F.array(F.lit(None), F.lit("<CatapultAliasFile/>"), F.concat(F.lit("<Map Name='x' Link='y'/>"), F.repeat(F.lit("é"), F.lit(150_000))), F.lit('<Map Name="a" Link="b#c"/>')), (_c("release") % 4 + 1).cast("int"))
    return sets.select("slug", "release", R.help_map_status(text).alias("status"))


@query()
def f241_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The references of each page by SQL, and an aggregate function; tests hold both against the column forms."""
    G.install(spark)
    docs = relation(spark, sf_dir, "documents").where("text is not null").select("doc_id", "source", _md().alias("md"))
    return spark.sql("SELECT source, distinct_words(raw) AS words FROM {docs} d, LATERAL references(d.md) GROUP BY source", docs=docs)


# A user's own generator and table of contents (plans/samples.py)


@query("SELECT p_partkey, '## ' || p_name AS markdown FROM {part}")
def f236_own_engine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page written by an engine that was registered by name."""
    html = F.concat(F.lit("<p class=menu>x</p><div class=head>"), "p_name", F.lit("</div>"))
    return relation(spark, sf_dir, "part").select("p_partkey", H.to_markdown(html, "shouting").alias("markdown"))


@query("SELECT p_partkey, 'a __' || p_name || '__' || chr(10) || chr(10) || '> **Mind:**' || chr(10) || '> ' || p_brand AS markdown FROM {part}")
def f237_hooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.concat(F.lit("<p>a <u>"), "p_name", F.lit("</u></p><div data-box='Mind:'>"), "p_brand", F.lit("</div>"))
    return relation(spark, sf_dir, "part").select("p_partkey", H.to_markdown(html, "shouting").alias("markdown"))


@query("SELECT p_partkey, e.depth AS depth, CASE e.depth WHEN 0 THEN p_name ELSE p_brand END AS title, e.path AS path FROM {part}, (VALUES (0, 'a.md'), (1, 'b.md')) e(depth, path)")
def f238_own_toc(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat("p_name", F.lit(" = a.md\n  "), "p_brand", F.lit(" = b.md\n"))
    return relation(spark, sf_dir, "part").select("p_partkey", F.explode(R.toc(text, "indented")).alias("e")).select("p_partkey", "e.*")
