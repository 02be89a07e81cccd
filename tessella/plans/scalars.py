"""Scalar functions and predicates over whole relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.functions import paths as P, text as X, values as V
from tessella.operators import rules as L
from tessella.plans.registry import scalar

_c = F.col
_normal = r"trim(regexp_replace(lower(translate(text, '‘’“”‐‑–—', '''''\"\"----')), '\s+', ' ', 'g'))".replace('\\"', '"')
_iso = """coalesce(strftime(coalesce(
    CASE WHEN regexp_matches(trim(date_cell), '^\\d{4}-\\d{2}-\\d{2}T') THEN try_cast(substr(trim(date_cell), 1, 10) AS date) END,
    CASE WHEN regexp_matches(trim(date_cell), '^\\d{12,13}$') THEN cast(epoch_ms(cast(trim(date_cell) AS bigint)) AS date) END,
    cast(try_strptime(trim(date_cell), ['%Y-%m-%d', '%m/%d/%Y', '%d/%m/%Y', '%Y/%m/%d', '%d-%m-%Y']) AS date)), '%Y-%m-%d'), trim(date_cell))"""
_released = f"coalesce(try_cast({_iso} AS date), cast(try_strptime(trim(date_cell), ['%B %Y', '%b %Y']) AS date))"

# text
scalar("f148_normalise", "documents", "doc_id", lambda: X.normalise(_c("text"), compatibility=False), _normal)
scalar("f148_normalise_nfkc", "documents", "doc_id", lambda: X.normalise(_c("text")), _normal)
scalar("f149_words", "documents", "doc_id", lambda: F.md5(F.array_join(X.words(X.normalise(_c("text"), compatibility=False)), " ")), f"md5(array_to_string(regexp_extract_all({_normal}, '[a-z0-9]+(?:[''.\\-_/][a-z0-9]+)*'), ' '))")
scalar("f150_shingles", "documents", "doc_id", lambda: F.size(X.shingles(X.words(_c("text")))), r"""(SELECT CASE WHEN len(w) = 0 THEN 0 WHEN len(w) <= 8 THEN 1 ELSE len(list_distinct([array_to_string(w[i:i+7], ' ') FOR i IN range(1, len(w) - 6)])) END FROM (SELECT regexp_extract_all(text, '[a-z0-9]+(?:[''.\-_/][a-z0-9]+)*') AS w))""")
scalar("f151_sentences", "documents", "doc_id", lambda: F.array_join(X.sentences(_c("text")), "|~|"), r"array_to_string(list_filter([trim(s) FOR s IN string_split(regexp_replace(text, '([.!?:;])\s+', '\1␟', 'g'), '␟')], lambda s: s <> ''), '|~|')")
scalar("f153_compact", "documents", "doc_id", lambda: F.md5(X.compact(_c("text"))), "md5(regexp_replace(lower(text), '[^a-z0-9]+', '', 'g'))")
scalar("f154_slug", "part", "p_partkey", lambda: X.slug(F.concat_ws(" ", "p_name", "p_brand")), "regexp_replace(regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')")
scalar("f156_heading_anchor", "part", "p_partkey", lambda: X.heading_anchor(F.concat(F.lit("<b>"), _c("p_brand"), F.lit("</b> 10.4.0 "), _c("p_name"))), "regexp_replace(regexp_replace(trim(lower(p_brand || ' 10.4.0 ' || p_name)), '[^a-z0-9_ \\-]', '', 'g'), ' +', '-', 'g')")
scalar("f157_version_segment", "cells", "k", lambda: X.version_segment(_c("version_cell")), "regexp_replace(regexp_replace(lower(replace(version_cell, '.', '-')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')")
scalar("f158_tree_name", "products", "slug", lambda: X.tree_name(F.lit("fr-fr"), _c("bu"), _c("family"), docs=True), "'loc-fr-fr-' || bu || '-' || family || '-userdocs'")
_alerts = "Note: Notes NOTICE remember OtherNote Tip Hint! fast-path Important attention Restriction warning TROUBLE: Caution danger Other".split()
scalar("f159_alert_kind", "cells", "k", lambda: X.alert_kind(F.element_at(F.array(*map(F.lit, _alerts)), (_c("k") % 16 + 1).cast("int"))), "['note', 'note', 'note', 'note', 'note', 'tip', 'tip', 'tip', 'important', 'important', 'important', 'warning', 'warning', 'caution', 'caution', NULL][k % 16 + 1]")
scalar("f155_page_stem", "part", "p_partkey", lambda: X.page_stem(F.when(_c("p_partkey") % 3 == 0, F.concat_ws(" the ", "p_name", "p_brand", "p_type", "p_name")).when(_c("p_partkey") % 3 == 1, F.lit(" ")).otherwise(F.concat_ws("_", F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("x"))), F.concat(F.lit("1__"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_old"))),
    """(WITH a AS (SELECT regexp_replace(lower(CASE WHEN p_partkey % 3 = 0 THEN p_name || ' the ' || p_brand || ' the ' || p_type || ' the ' || p_name ELSE p_name END), '[^a-z0-9]+', '-', 'g') AS s),
    b AS (SELECT s, array_to_string(list_filter(string_split(s, '-'), lambda w: w NOT IN ('a', 'an', 'the', 'of', 'for', 'to', 'and', 'in', 'on', 'with')), '-') AS kept FROM a)
    SELECT CASE WHEN length(s) <= 50 THEN s WHEN length(kept) <= 50 THEN kept ELSE regexp_replace(kept[1:50], '-[^-]*$', '') END FROM b)""")
scalar("f160_title_from_filename", "files", "fid", lambda: X.title_from_filename(P.leaf(_c("path"))), r"trim(regexp_replace(regexp_replace(regexp_extract(path, '[^/]*$'), '\.[^.]*$', ''), '[_.-]+', ' ', 'g'))")
scalar("f161_title_chain", "files", "fid", lambda: F.coalesce(F.when(_c("kind") == "economy", _c("kind")), F.when(_c("fid") % 2 == 0, _c("brand")), X.title_from_filename(P.leaf(_c("path")))), r"coalesce(CASE WHEN kind = 'economy' THEN kind END, CASE WHEN fid % 2 = 0 THEN brand END, trim(regexp_replace(regexp_replace(regexp_extract(path, '[^/]*$'), '\.[^.]*$', ''), '[_.-]+', ' ', 'g')))")
scalar("f162_kind_routing", "files", "fid", lambda: F.when(_c("path").rlike(r"(?i)\.png$"), "image").when(_c("path").rlike("guide0/"), "guide").when(P.is_topic(_c("path")), "topic").otherwise("other"), r"CASE WHEN path ILIKE '%.png' THEN 'image' WHEN contains(path, 'guide0/') THEN 'guide' WHEN regexp_matches(lower(path), '\.x?html?$') THEN 'topic' ELSE 'other' END")
scalar("f163_api_name", "files", "fid", lambda: L.api_name(F.concat(P.parent(_c("path")), F.when(_c("fid") % 5 == 0, "/html").otherwise("/Doc/javadoc")), ["guide0", "guide1", "guide2", "guide3", "html", "doc"]), r"regexp_extract(path, '^[^/]*/(.*)/[^/]*$', 1) || CASE WHEN fid % 5 = 0 THEN '' ELSE '-javadoc' END")
scalar("f164_fence", "cells", "k", lambda: X.fence(F.repeat(F.lit("`"), (_c("k") % 6).cast("int"))), "repeat('`', greatest(cast(k % 6 AS int) + 1, 3))")
scalar("f165_markdown_escape", "cells", "k", lambda: X.markdown_escape(F.concat(_c("ref_cell"), F.lit("*_|"))), r"regexp_replace(ref_cell || '*_|', '([\\`*_\[\]<>#|])', '\\\1', 'g')")
scalar("f165_table_cell", "documents", "doc_id", lambda: F.md5(X.table_cell(_c("text"))), r"md5(regexp_replace(replace(trim(text), '|', '\|'), '\r\n|\r|\n', '<br>', 'g'))")
scalar("f166_yaml_quote", "documents", "doc_id", lambda: F.md5(X.yaml_quote(_c("text"))), r"""md5('"' || replace(replace(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') || '"')""")
scalar("f167_boolean", "cells", "k", lambda: V.boolean(_c("bool_cell")), "CASE lower(trim(bool_cell)) WHEN 'true' THEN true WHEN 't' THEN true WHEN 'y' THEN true WHEN 'no' THEN false WHEN '0' THEN false END")
scalar("f167_whole_count", "cells", "k", lambda: V.whole_count(_c("count_cell")), "CASE WHEN try_cast(replace(trim(count_cell), ',', '') AS double) >= 0 AND try_cast(replace(trim(count_cell), ',', '') AS double) % 1 = 0 THEN cast(try_cast(replace(trim(count_cell), ',', '') AS double) AS int) END")
scalar("f168_enumeration", "cells", "k", lambda: V.enumeration(_c("status_cell"), ["o", "f"], "unknown"), "CASE WHEN lower(status_cell) IN ('o', 'f') THEN lower(status_cell) ELSE 'unknown' END")
scalar("f169_fold_newlines", "documents", "doc_id", lambda: F.md5(X.fold_newlines(F.replace(_c("text"), F.lit("\n"), F.lit("\r\n")))), "md5(text)")
scalar("f197_strip_inline", "pages", "page_id", lambda: F.md5(X.strip_inline(_c("html"))), "md5(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '!\\[[^\\]]*\\]\\([^)]*\\)', '', 'g'), '\\[([^\\]]*)\\]\\([^)]*\\)', '\\1', 'g'), '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'))")
scalar("f210_front_matter", "documents", "doc_id", lambda: X.front_matter(F.concat(F.lit("---\nlang: "), _c("lang"), F.lit("\n---\n"), _c("text"))), "'lang: ' || lang")
scalar("f111_word_count", "documents", "doc_id", lambda: X.word_count(_c("text")), r"len(regexp_extract_all(text, '\S+'))")
scalar("f198_cut_at_label", "documents", "doc_id", lambda: F.md5(F.array_join(L.cut_at(F.split("text", "\n"), ["of", "related topics"]), "|")), "(SELECT md5(array_to_string(list_slice(b, 1, coalesce(list_position(p, 'of') - 1, len(b))), '|')) FROM (SELECT string_split(text, chr(10)) AS b, [trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g')) FOR x IN string_split(text, chr(10))] AS p) t)")
scalar("f122_digest", "versions", "okey", lambda: L.fingerprint(_c("slug"), _c("version"), length=12), """substr(sha256('{"c0":"' || slug || '","c1":"' || version || '"}'), 1, 12)""")

# dates, numbers, versions
scalar("f170_iso_date", "cells", "k", lambda: V.iso_date(_c("date_cell")), _iso)
scalar("f171_report_date", "cells", "k", lambda: V.report_date(_c("date_cell")), "coalesce(strftime(try_strptime(trim(date_cell), '%m-%d-%Y'), '%Y-%m-%d'), trim(date_cell))")
scalar("f172_release_year", "cells", "k", lambda: V.release_year(_c("date_cell")), f"coalesce(cast(year({_released}) AS string), '')")
scalar("f173_release_month", "cells", "k", lambda: V.release_month(_c("date_cell")), f"coalesce(strftime({_released}, '%b %Y'), '')")
scalar("f174_listed_title", "cells", "k", lambda: V.listed_title(_c("version_cell"), _c("date_cell")), f"version_cell || coalesce(' (' || strftime({_released}, '%b %Y') || ')', '')")
scalar("f175_natural_key", "cells", "k", lambda: F.array_join(F.transform(V.natural_key(_c("version_cell")), lambda p: F.concat(p["rank"].cast("string"), F.lit(":"), p["number"].cast("string"), F.lit(":"), p["text"])), " "), r"array_to_string([CASE WHEN regexp_matches(p, '^\d') THEN '0:' || cast(cast(p AS bigint) AS string) || ':' ELSE '1:0:' || p END FOR p IN regexp_extract_all(lower(version_cell), '\d+|[^\d.]+')], ' ')")
scalar("f176_percent", "cells", "k", lambda: V.percent(_c("k") % 17, _c("k") % 23), "CASE WHEN k % 23 = 0 THEN 100.0 ELSE round_even((k % 17) * 100.0::double / (k % 23), 1) END")
scalar("f177_translation_share", "cells", "k", lambda: L.share(_c("k") % 19, F.when(_c("k") % 11 == 0, 0).otherwise(_c("k") % 7 + 19)), "CASE WHEN k % 11 = 0 THEN 0 ELSE cast(round_even(100.0::double * (k % 19) / (k % 7 + 19), 0) AS int) END")
scalar("f043_numeric_version", "cells", "k", lambda: V.is_numeric_version(_c("version_cell")), r"regexp_matches(version_cell, '^\d+(\.\d+)*$')")

# predicates
scalar("f041_listed", "versions", "okey", lambda: L.listed(_c("is_archived"), F.when(_c("okey") % 7 != 0, _c("convert_eligible"))), "NOT is_archived OR (okey % 7 <> 0 AND convert_eligible)")
scalar("f042_visible", "cells", "k", lambda: F.coalesce(V.boolean(_c("bool_cell")), F.lit(True)), "CASE lower(trim(bool_cell)) WHEN 'no' THEN false WHEN '0' THEN false ELSE true END")
scalar("f044_unfiled", "files", "fid", lambda: L.is_unfiled(F.concat(F.element_at(F.array(F.lit("unfiled/"), F.lit("unfiled\\"), F.lit("unfiled-not/"), F.lit("")), (_c("fid") % 4 + 1).cast("int")), "path")), "fid % 4 < 2")
scalar("f045_asset_target", "cells", "k", lambda: L.is_asset_target(F.concat(F.when(_c("k") % 3 == 0, "/content/dam/").otherwise("/content/"), "ref_cell")), "starts_with(CASE WHEN k % 3 = 0 THEN '/content/dam/' ELSE '/content/' END || ref_cell, '/content/dam/')")
scalar("f047_unpublishable", "files", "fid", lambda: P.unpublishable(F.replace(_c("path"), F.lit(".png"), F.lit(".exe")), _c("bytes") * 3000), "CASE WHEN path LIKE '%.png' THEN 'type' WHEN bytes * 3000 >= 104857600 THEN 'size' ELSE '' END")
scalar("f048_unsafe_name", "cells", "k", lambda: P.is_unsafe(_c("ref_cell")), r"""starts_with(ref_cell, '/') OR len(list_filter(string_split(replace(ref_cell, '\', '/'), '/'), lambda p: p = '..' OR regexp_matches(p, '[:*?"<>|]') OR regexp_matches(p, '[. ]$') OR regexp_matches(lower(p), '^(con|prn|aux|nul|com[1-9]|lpt[1-9])(\..*)?$'))) > 0""")
scalar("f050_skin_path", "files", "fid", lambda: L.is_skin(_c("path"), F.when(_c("fid") % 2 == 0, "flare").when(_c("fid") % 3 == 0, "dita"), {"flare": ["GUIDE1/", "guide2/red"], "dita": ["guide3/"]}), "CASE WHEN fid % 2 = 0 THEN starts_with(path, 'guide1/') OR starts_with(path, 'guide2/red') WHEN fid % 3 = 0 THEN starts_with(path, 'guide3/') ELSE false END")
scalar("f051_support_label", "cells", "k", lambda: X.is_label(_c("label_cell"), ["note", "attention"]), "trim(regexp_replace(lower(label_cell), '[^a-z0-9]+', ' ', 'g')) IN ('note', 'attention')")
scalar("f052_outcome", "findings", "id", lambda: L.outcome((_c("severity") == "error").cast("int"), (_c("severity") == "warning").cast("int"), _c("n").isNotNull().cast("int")), "CASE WHEN severity = 'error' THEN 'lost' WHEN severity = 'warning' THEN 'issues' WHEN n IS NOT NULL THEN 'explained' ELSE 'clean' END")

# URLs and paths
_decode = "coalesce(url_decode(ref_cell), ref_cell)"
scalar("f178_reference_kind", "cells", "k", lambda: P.reference_kind(_c("ref_cell")), "CASE WHEN trim(ref_cell) = '' THEN 'empty' WHEN regexp_matches(ref_cell, '^(//|[A-Za-z][A-Za-z0-9+.\\-]*:)') THEN 'absolute' WHEN starts_with(ref_cell, '#') THEN 'fragment' WHEN starts_with(ref_cell, '/') THEN 'rooted' ELSE 'relative' END")
scalar("f178_reference_path", "cells", "k", lambda: P.split_reference(_c("ref_cell"))["path"], "url_decode(split_part(split_part(ref_cell, '#', 1), '?', 1))")
scalar("f178_reference_fragment", "cells", "k", lambda: P.split_reference(_c("ref_cell"))["fragment"], "split_part(ref_cell, '#', 2)")
scalar("f179_resolve", "cells", "k", lambda: P.resolve(F.lit("base/dir"), _c("path_cell")), "CASE k % 4 WHEN 0 THEN 'base/dir/a/c.htm' WHEN 1 THEN 'base/' || substr(path_cell, 4) WHEN 2 THEN 'base/dir/x.htm/y/z.HTML' ELSE 'base/dir/' || path_cell END")
scalar("f180_escapes", "cells", "k", lambda: P.escapes(P.normal_path(_c("path_cell"))), "k % 4 = 1")
scalar("f181_without_page_folders", "cells", "k", lambda: P.without_page_folders(_c("path_cell")), "CASE WHEN k % 4 = 2 THEN 'y/./z.HTML' ELSE path_cell END")
scalar("f182_to_markdown", "files", "fid", lambda: P.to_markdown(_c("path")), r"regexp_replace(path, '\.x?html?$', '.md', 'i')")
scalar("f183_relative_to", "files", "fid", lambda: P.relative_to(F.lit("guide1/x"), _c("path")), "CASE WHEN starts_with(path, 'guide1/') THEN '../' || substr(path, 8) ELSE '../../' || path END")
scalar("f184_percent_encode", "files", "fid", lambda: P.percent_encode(F.concat(_c("brand"), F.lit(" +/~"), _c("path"))), "replace(replace(brand, ' ', '%20'), '#', '%23') || '%20%2B/~' || path")
scalar("f185_is_topic", "files", "fid", lambda: P.is_topic(_c("path")), r"regexp_matches(lower(path), '\.x?html?$')")
scalar("f186_page_key", "pages", "page_id", lambda: P.page_key(_c("url")), "url_decode(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '^/+', ''))")
scalar("f187_origin_url", "files", "fid", lambda: P.origin_url(F.lit("http://old/{folder}/{path}"), _c("path"), _c("slug")), "'http://old/' || slug || '/' || path")
scalar("f188_package_folder", "versions", "okey", lambda: P.package_folder(_c("zip_url")), "CASE WHEN zip_url IS NOT NULL THEN slug END")
scalar("f189_asset_path", "products", "slug", lambda: P.asset_path(_c("bu"), F.lit("us"), F.lit("en"), _c("display_name")), "'/content/dam/' || bu || '/us/en/' || display_name")
scalar("f190_rooted", "cells", "k", lambda: F.concat_ws(" ", P.rooted(_c("ref_cell")), P.unrooted(_c("ref_cell"))), "(CASE WHEN starts_with(ref_cell, '/') THEN ref_cell ELSE '/' || ref_cell END) || ' ' || regexp_replace(ref_cell, '^/+', '')")
scalar("f191_served_url", "files", "fid", lambda: P.served_url(F.lit("http://host"), F.concat(F.lit("en-us/"), P.to_markdown(_c("path")))), r"'http://host/us/en/' || regexp_replace(regexp_replace(path, '\.x?html?$', '.md', 'i'), '\.md$', '.html')")
scalar("f192_staging_url", "versions", "okey", lambda: F.concat(F.lit("https://stage/"), "slug", F.lit("/"), X.version_segment(_c("version"))), "'https://stage/' || slug || '/' || lower(replace(version, '.', '-'))")
scalar("f193_identifier_split", "cells", "k", lambda: F.to_json(L.split_identifier(F.concat("ref_cell", F.lit("#b")))), """'{"path":"' || split_part(ref_cell, '#', 1) || '","anchor":"' || regexp_extract(ref_cell || '#b', '(?s)#(.*)$', 1) || '"}'""")
