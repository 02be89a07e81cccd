import collections
import hashlib
import math
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from tessella.llm import bag_minhash, bpe_automaton, chat_format, decontamination, language_id, line_dedup, ppm, quality_additive, token_files, vantage_points  # noqa: E402
from tessella.llm.components import components  # noqa: E402
from tessella.llm.queries import tokenizer  # noqa: E402

DOCS = "doc_id long, text string, score string, n_words string"  # with columns whose names clash


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS)


def sample(n=60, seed=1):
    """Texts with copies, edits, shared passages, empty, very long and odd ones; all ids distinct."""
    r = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("the", "on", "er", "ti", "é", "X") for b in ("", "an", "st", "ou", "7")]
    say = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    passage, texts = say(60), []
    for i in range(n):
        if i % 5 == 1:
            texts.append(texts[-1])
        elif i % 5 == 2:
            w = texts[-1].split(" ")
            w[r.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
        elif i % 5 == 3:
            texts.append("\n".join([say(9), passage, say(5)]))
        else:
            texts.append("\n".join(say(r.randrange(1, 40)) for _ in range(r.randrange(1, 5))))
    texts += ["", "!!! ???", "a b", say(12000), "日本 語 \x1c ΣΑΣ it's <|endoftext|> x"]
    return list(enumerate(texts))


def test_decontamination(spark):
    rows = sample()
    items = [(1, rows[0][1]), (20, "a b"), (3, ""), (4, None), (5, "!!"), (1, rows[3][1])]
    docs = [*rows, (900, None), rows[2], (None, rows[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(repr, brute.contamination(docs, items)))
    for block in (decontamination.BLOCK_BYTES, 40):  # a set that is broadcast, and a join
        got = decontamination.report(frame(spark, docs), bench, block_bytes=block).collect()
        assert sorted(repr(tuple(r)) for r in got) == want
    dirty = {x[0] for x in brute.contamination(docs, items) if x[5]}
    kept = decontamination.clean(frame(spark, docs), bench)
    assert kept.columns == ["doc_id", "text", "score", "n_words"]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((d for d, _ in docs if d not in dirty), key=repr)
    assert sorted(map(repr, decontamination.clean(frame(spark, docs), bench, block_bytes=40).collect())) == sorted(map(repr, kept.collect()))
    spans = {r.doc_id: r.text for r in decontamination.clean(frame(spark, docs), bench, remove="spans").collect()}
    assert {r.doc_id: r.text for r in decontamination.clean(frame(spark, docs), bench, remove="spans", block_bytes=40).collect()} == spans
    assert spans[900] is None and not any(x[5] for x in brute.contamination([(d, t) for d, t in spans.items()], items) if x[0] == 0)
    assert decontamination.report(frame(spark, []), bench).count() == 0
    assert not any(r.contaminated for r in decontamination.report(frame(spark, docs), bench.limit(0)).collect())


def test_bpe_automaton_matches_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = tokenizer("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    docs = [*sample(), (900, None), (901, "x" * 3000), sample()[2]]
    got = bpe_automaton.report(frame(spark, docs), path).collect()
    want = []
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(want)
    back = bpe_automaton.decode(bpe_automaton.encode(frame(spark, docs[:5]), path), path).collect()
    assert {r.decoded for r in back} == {library.decode(library.encode(t, add_special_tokens=False).ids, skip_special_tokens=False) for _, t in docs[:5]}
    assert bpe_automaton.report(frame(spark, []), path).count() == 0


def test_bpe_tables_are_bounded_and_released():
    spec = bpe_automaton._spec(tokenizer("word_bpe_49k.json"))
    texts = [t for _, t in sample()]
    with bpe_automaton._encoder(spec) as encoder:
        want = [encoder.encode(t) for t in texts]
        assert encoder.known and encoder.automaton.steps
    kept = next(iter(bpe_automaton._compiled.values()))
    assert not kept.known and not kept.before and len(kept.automaton.steps) <= bpe_automaton.MAX_STEPS
    limits = bpe_automaton.MAX_STEPS, bpe_automaton.MAX_PIECES
    bpe_automaton.MAX_STEPS, bpe_automaton.MAX_PIECES = 50, 7
    try:
        with bpe_automaton._encoder(spec) as encoder:
            assert [encoder.encode(t) for t in texts] == want
            assert len(encoder.known) <= 7 and len(encoder.before) <= 7 and len(encoder.automaton.steps) <= 50 + 600
    finally:
        bpe_automaton.MAX_STEPS, bpe_automaton.MAX_PIECES = limits


def test_token_files(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    path = tokenizer("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    docs = [*sample(), (900, None), (-3, "first  \n\n x")]
    got = {r.doc_id: tuple(r)[1:] for r in token_files.report(frame(spark, docs), path, file_ids=1000, parts=3).collect()}
    start = 0
    for i, t in sorted(docs):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        assert got[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    odd = [(None, "n"), (5, "b"), (5, "a"), (5, "a")]
    rows = token_files.report(frame(spark, odd), path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 5, 5, 5] and [r.start for r in rows] == [0, 2, 4, 6]
    assert token_files.report(frame(spark, []), path).count() == 0


def test_patched_blocks_round_trip():
    g = np.random.default_rng(1)
    for n in (0, 1, 127, 128, 129, 3000):
        ids = g.integers(0, 50257, n).astype(np.uint32)
        ids[::37] = 4_000_000_000
        file = token_files.TokenFile(token_files.to_bytes(ids, np.array([n]), [7]))
        assert (file.ids(0, n) == ids).all() and (file.ids(n // 3, n // 2) == ids[n // 3 : n // 2]).all()


def test_language_id(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scored = language_id.report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in scored if r.held_out]
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in scored)
    odd = spark.createDataFrame([(1, None, "en"), (2, "123 !", "en"), (3, "", None), (None, "the of and", None), (4, "abc", "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.report(odd).collect()}
    assert got[1] == got[2] == got[3] == "und"
    assert language_id.report(odd.limit(0)).count() == 0


def test_language_id_against_brute_force(spark):
    r = random.Random(6)
    words = {"x": ["der", "die", "größe", "und", "ist"], "y": ["the", "of", "and", "is", "İt's"], "z": ["日本", "語は", "の"]}
    rows = [(i, " ".join(r.choice(words[lang]) for _ in range(r.randrange(1, 60))) + r.choice(["", " 12", "!\n?"]), lang) for i in range(60) for lang in [r.choice("xyz")]]
    rows += [(100, "the und " * 9000, "y"), (101, None, "x"), (102, "", None), (103, " 7 !", "z"), (None, "der of", None), (5, "die und", "x"), (5, "die und", "x")]
    df = spark.createDataFrame([(*x, 1, "q") for x in rows], "doc_id long, text string, lang string, rank int, gram string")
    taught = [(t, lang) for i, t, lang in rows if lang and t is not None and (i is None or zlib.crc32(str(i).encode()) % 3 != 1)]
    want = sorted(((i, p, round(v, 9)) for i, p, v in brute.language([x[:2] for x in rows], taught)), key=repr)
    got = language_id.report(df).collect()
    assert sorted(((x.doc_id, x.lang_pred, round(x.score, 9)) for x in got), key=repr) == want
    assert all(x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in got)


def test_out_of_place_distance():
    profiles = language_id.Profiles([("a", 5, 0), ("a", 9, 1), ("b", 9, 0)], size=300)
    d = profiles.distances(np.array([9, 5], dtype=np.uint64))
    assert d.tolist() == [(1 + 1) / 600, (0 + 300) / 600]


def test_vantage_points(spark):
    g = np.random.default_rng(0)
    x = g.normal(size=(400, 6)).round(2)
    x[50:120] = x[0]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(1000, None, 1), (1100, [0.0] * 6, 1), (1200, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (1300, [float("nan")] * 6, 1), (1400, [1.0, 2.0], 1), (None, [1.0] * 6, 1), (7, x[7].tolist(), 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = collections.defaultdict(list)
    for r in vantage_points.report(df, shard_rows=64).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for q in range(0, 400, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        want = sorted((d[i], i) for i in range(400) if i != q)[:10]
        assert [i for i, _ in got[q]] == [i for _, i in want] and np.allclose([s for _, s in got[q]], [s for s, _ in want])
    assert set(got) == {0, 100, 200, 300}
    want = {(q, i) for q, found in got.items() for i, _ in found}
    near = {(r.query_id, r.vec_id) for r in vantage_points.report(df, factor=0.6, shard_rows=64).collect()}
    assert len(near & want) >= 0.9 * len(want)
    assert vantage_points.report(df.limit(0)).count() == 0


@pytest.mark.parametrize("own", (1, 2, 3, 4))
def test_vantage_points_with_several_vectors_of_one_id(spark, own):
    g = np.random.default_rng(own)
    x = g.normal(size=(300, 5))
    rows = [(i if i >= own else 0, v.tolist()) for i, v in enumerate(x)]
    got = [(r.vec_id, r.score) for r in vantage_points.report(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=1000, shard_rows=100).orderBy("rank").collect()]
    q = min(range(own), key=lambda i: x[i].tolist())
    d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    want = sorted((d[i], rows[i][0]) for i in range(300) if i != q)[:10]
    assert [i for i, _ in got] == [i for _, i in want] and np.allclose([s for _, s in got], [s for s, _ in want])


def test_vantage_points_recall_when_relaxed():
    g = np.random.default_rng(1)
    x = g.normal(size=(6000, 24))
    tree = vantage_points.Tree(np.arange(6000), x)
    q = np.arange(0, 6000, 60)
    exact = tree.search(q, x[q], 10)[0]
    brute_force = np.argsort(((x[q][:, None] - x[None]) ** 2).sum(axis=2), axis=1)[:, 1:11]
    assert (np.sort(exact) == np.sort(brute_force)).all()
    for factor in (0.9, 0.6):
        found = tree.search(q, x[q], 10, factor)[0]
        assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found, exact)]) >= 0.9


def test_quality_additive(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_additive.report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert scored and sum(r.predicted == r.quality for r in scored) >= 0.9 * len(scored)
    odd = frame(spark, [(1, None), (2, ""), (None, "x"), (3, "a " * 20000), (3, "a")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_additive.report(odd, none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (1, None), (2, 7), (None, 0)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality_additive.report(odd, one).collect())
    assert quality_additive.report(odd.limit(0), labels).count() == 0
    assert all(r.held_out is not None for r in quality_additive.report(odd, one).collect())


def test_quality_additive_against_brute_force(spark):
    """The features, the sample and the sum of table entries, restated a document at a time."""
    rows = [*sample(), (900, None), (901, "One two.\nOne two.\nTHREE 4x é!"), (902, "same text"), (902, "same text"), (902, "other text 7")]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows if i is not None and i % 5], "doc_id long, quality int")
    model = quality_additive.train(frame(spark, rows), labels)

    def features(t):
        raw, words = t.encode(), brute.WORD.findall(brute.low(t))
        share = lambda test: sum(map(test, raw)) / max(1, len(raw))
        lines = [" ".join(w) for w in (brute.WORD.findall(brute.low(x)) for x in t.split("\n")) if w]
        n = max(1, len(words))
        spans = [m.start() for m in brute.WORD.finditer(brute.low(t))]
        return [
            math.log1p(len(raw)), share(lambda b: 65 <= b <= 90), share(lambda b: 48 <= b <= 57), share(lambda b: b in (32, 9, 13)), share(lambda b: b == 10),
            share(lambda b: b in b".,;:?'\"-()"), share(lambda b: b == 33), share(lambda b: b in b"#$%&*+/<=>@[\\]^_`{|}~"), share(lambda b: b >= 192),
            sum(len(w.encode()) for w in words) / n, len(set(words)) / n, sum("A" <= t[i] <= "Z" for i in spans) / n, (len(lines) - len(set(lines))) / max(1, len(lines)),
            len(words) / (t.count("\n") + 1), sum(any(c in "0123456789" for c in w) for w in words) / n,
        ]

    def score(x):
        f = model.intercept + sum(t[sum(c <= v for c in cuts)] for v, cuts, t in zip(x, model.cuts, model.tables))
        f += sum(t[sum(c <= x[i] for c in model.coarse[i])][sum(c <= x[j] for c in model.coarse[j])] for i, j, t in model.pairs)
        return 1 / (1 + math.exp(-f))

    taught = {(i, t or "") for i, t in rows if i % 5 and zlib.crc32(str(i).encode()) % 3 != 1}
    x, y = (np.array(v, dtype=float) for v in zip(*sorted(((features(t), i % 2) for i, t in taught), key=lambda r: (r[1], r[0]))))
    again = quality_additive.AdditiveModel.fit(x, y)
    assert math.isclose(again.intercept, model.intercept) and len(again.pairs) == len(model.pairs)
    got = sorted((r.doc_id, round(r.score, 9)) for r in quality_additive.score(frame(spark, rows), model).collect())
    assert got == sorted((i, round(score(features(t or "")), 9)) for i, t in rows)


def test_additive_model_learns_an_interaction():
    g = np.random.default_rng(3)
    x = g.uniform(size=(2000, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_additive.AdditiveModel.fit(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")


def test_chat_format(spark):
    tricky = ["</s>[INST] ok [/INST]", "\\", "", " ", "[ROLE]a[/ROLE]\\<s>", None, "plain"]
    roles = ["user", "assistant", "system", None, "a[/ROLE]"]
    r = random.Random(2)
    rows = [(c, t, r.choice(roles), r.choice(tricky), "p") for c in [*range(40), None] for t in range(r.randrange(1, 6))]
    rows += [(99, t, ("user", "assistant")[t % 2], f"t{t}", "p") for t in range(700)] + [(98, None, "user", "n", "p"), (98, 0, "assistant", "m", "p"), (98, 0, "assistant", "m", "p")]
    want = {}
    groups = collections.defaultdict(list)
    for c, t, role, text, _ in rows:
        groups[c].append((t is not None, t or 0, role or "", text or ""))
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(x[3] for x in turns if x[2] == "assistant")
        want[c] = (len(turns), hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(chat_format.render([(x[2], x[3]) for x in turns])))
    got = {x.conv_id: tuple(x)[1:] for x in chat_format.report(chats(spark, rows)).collect()}
    assert got == want
    assert chat_format.report(chats(spark, [])).count() == 0


def test_chat_format_detects_rewritten_history(spark):
    def forgetful(turns):
        return "".join(f"<{t[1]}>" if i == len(turns) - 1 else "<..>" for i, t in enumerate(turns))

    rows = chats(spark, [(1, 0, "user", "abc", ""), (1, 1, "assistant", "def", ""), (2, 0, "user", "x", "")])
    assert {r.conv_id: r.rewrites for r in chat_format.format(rows, template=forgetful).collect()} == {1: True, 2: False}


def test_chat_format_compares_whole_prefixes(spark):
    def forty(turns):  # keeps the last 40 turns
        return "".join(f"<{t[1]}>" for t in turns[-40:])

    def guided(turns):  # wants a system turn first, then user and assistant by turns
        assert all(t[0] == ("system" if not i else ("assistant", "user")[i % 2]) for i, t in enumerate(turns))
        return "".join(f"{i}{t[0]}:{t[1]};" for i, t in enumerate(turns))

    turns = [("system" if not i else ("assistant", "user")[i % 2], f"t{i}") for i in range(60)]
    rows = chats(spark, [(1, i, *t, "") for i, t in enumerate(turns)] + [(2, i, *t, "") for i, t in enumerate(turns[:40])])
    assert {r.conv_id: r.rewrites for r in chat_format.format(rows, template=forty).collect()} == {1: True, 2: False}
    got = {r.conv_id: r for r in chat_format.format(rows, template=guided).collect()}
    assert got[1].formatted == guided(turns) and not got[1].rewrites
    assert [got[1].formatted[s.text_start : s.text_end] for s in got[1].spans] == [t[1] for t in turns]


def test_line_dedup(spark):
    rows = sample()
    docs = [*rows, (900, None), (901, rows[3][1] + "\n" + rows[3][1])]
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.report(frame(spark, docs)).collect()}
    assert got[900] == (None, 0)
    want = brute.without_repeats([d for d in docs if d[1] is not None])
    assert {d: got[d] for d, _, _ in want} == {d: (t, n) for d, t, n in want}
    assert sum(n for _, _, n in want) > 10
    cleaned = line_dedup.clean(frame(spark, docs))
    assert cleaned.columns == ["doc_id", "text", "score", "n_words"]
    assert sorted(r.doc_id for r in cleaned.collect()) == sorted(d for d, t in got.items() if t[0] != "" or dict(docs)[d] == "")
    twice = [(5, rows[3][1]), (5, rows[3][1]), (None, rows[3][1])]
    assert line_dedup.report(frame(spark, twice)).count() == 3
    assert line_dedup.report(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_line_dedup_against_brute_force(spark, seed):
    """Few distinct lines, so that runs overlap and nest; stretches of blank lines; odd word counts."""
    r = random.Random(seed)
    pool = ["", " ", "a", "b c", "d e f g", *(" ".join(r.choice("uvwxyz") for _ in range(r.randrange(5, 30))) for _ in range(5))]
    docs = []
    for i in range(40):
        lines = [r.choice(pool) for _ in range(r.randrange(1, 30))]
        if i % 4 == 3:
            old = docs[r.randrange(i)][1].split("\n")
            lines[2:2] = old[r.randrange(len(old)) :]
        if i % 7 == 6:
            lines[1:1] = [""] * r.randrange(40)
        docs.append((i, "\n".join(lines)))
    for least in (3, 50):
        got = {x.doc_id: (x.text, x.n_removed) for x in line_dedup.report(frame(spark, docs), min_words=least).collect()}
        assert got == {d: (t, n) for d, t, n in brute.without_repeats(docs, least)}


def test_line_dedup_settles_intervals_across_partitions(spark):
    shown = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        r = random.Random(8)
        block = [f"{i} x y z" for i in range(20)]
        docs = [(i, "\n".join([*block[: r.randrange(12, 20)], r.choice(["p q", "r s", "t"])])) for i in range(60)]
        got = {x.doc_id: (x.text, x.n_removed) for x in line_dedup.report(frame(spark, docs)).collect()}
        assert got == {d: (t, n) for d, t, n in brute.without_repeats(docs)}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", shown)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_line_dedup_takes_long_blank_stretches(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    text = passage + "\n" * 20_000 + passage
    got = {x.doc_id: (x.n_lines, x.n_removed) for x in line_dedup.report(frame(spark, [(1, text), (2, text), (3, "own\n" * 5)])).collect()}
    assert got == {1: (20_001, 1), 2: (20_001, 20_001), 3: (6, 0)}


def test_bag_minhash(spark):
    rows = sample(80, seed=4)
    docs = [*rows, (900, rows[0][1]), (901, None), (902, None), (903, ""), (900, rows[0][1])]
    got = bag_minhash.classes(frame(spark, docs)).collect()
    want = brute.near_classes(docs)
    assert sorted((r.doc_id, r.class_id) for r in got) == sorted(want)
    kept = bag_minhash.keep_one(frame(spark, docs))
    assert kept.columns == ["doc_id", "text", "score", "n_words"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want})
    lone = bag_minhash.classes(frame(spark, [(None, "a b c"), (None, "a b c"), (None, "x y"), (1, "d e f"), (None, "d e f")])).collect()
    assert sorted((r.doc_id for r in lone), key=repr) == [1, None, None, None, None] and len({r.class_id for r in lone}) == 3
    assert len(bag_minhash.keep_one(frame(spark, [(None, "a b c"), (None, "a b c"), (None, "x y"), (1, "d e f"), (None, "d e f")])).collect()) == 3
    assert bag_minhash.classes(frame(spark, [])).count() == 0


def test_bag_minhash_large_buckets_need_no_leader(spark):
    """More near copies than a small bucket holds, many of them unlike the least one."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(2000)]
    base, docs = [r.choice(words) for _ in range(120)], []
    for i in range(150):
        w = list(base)
        for _ in range(r.choice([1, 3, 6, 9])):
            w[r.randrange(len(w))] = r.choice(words)
        docs.append((i, " ".join(w)))
    got = sorted((x.doc_id, x.class_id) for x in bag_minhash.classes(frame(spark, docs)).collect())
    assert got == sorted(brute.near_classes(docs))


def test_bag_minhash_finds_every_link_near_the_threshold(spark):
    """Link recall: 400 pairs of texts whose similarity is 0.8 to 0.86."""
    r, docs, linked = random.Random(11), [], 0
    for i in range(400):
        words = [f"{i}w{k}" for k in range(140)]
        other = list(words)
        for k in sorted(r.sample(range(27), r.choice([2, 3]))):
            other[k * 5 + r.randrange(5)] = f"{i}c{k}"
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
        linked += brute.overlap(brute.shingles(docs[-2][1]), brute.shingles(docs[-1][1])) >= 0.8
    found = {x.doc_id: x.class_id for x in bag_minhash.classes(frame(spark, docs)).collect()}
    links = sum(brute.overlap(brute.shingles(docs[2 * i][1]), brute.shingles(docs[2 * i + 1][1])) >= 0.8 and found[2 * i] == found[2 * i + 1] for i in range(400))
    assert linked > 200 and links == linked


def test_bag_minhash_refuses_thresholds_it_would_not_honour(spark):
    with pytest.raises(ValueError):
        bag_minhash.classes(frame(spark, [(1, "a b c")]), threshold=0.5)


def test_bag_minhash_tells_rows_of_one_id_apart_by_text(spark):
    words = [f"w{i}" for i in range(200)]
    first, near, other = " ".join(words), " ".join([*words[:-1], "x"]), " ".join(reversed(words))
    docs = [(1, first), (5, near), (5, other), (6, other + " y"), (7, "lone words")]
    kept = bag_minhash.keep_one(frame(spark, docs)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(1, first), (5, other), (7, "lone words")])


def test_components_in_one_partition_and_many(spark):
    r = random.Random(9)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 430)]
    df = spark.createDataFrame(links, "a long, b long")
    got = []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for united in (1000, 20):
        got.append(sorted(map(tuple, components(df, united=united).collect())))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got[0] == got[1] and dict(got[0])[430] == 400
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert dict(got[0]) == {x: root(x) for a, b in links if a != b for x in (a, b)}
    assert components(df.limit(0)).count() == 0


def test_signatures_estimate_weighted_overlap():
    g = np.random.default_rng(2)
    keys = g.integers(1, 1 << 62, 300).astype(np.uint64)
    a, b = g.integers(0, 7, 300), g.integers(0, 7, 300)
    sig = []
    for c in (a, b):
        on = np.flatnonzero(c)
        sig.append(bag_minhash.signatures(np.zeros(len(on), np.int64), keys[on], c[on], 1, registers=4096)[0])
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 0.03


def test_signature_is_the_same_alone_and_among_others():
    g = np.random.default_rng(3)
    docs, size = 120, 60
    doc = np.repeat(np.arange(docs), size)
    keys, counts = g.integers(1, 1 << 62, docs * size).astype(np.uint64), g.integers(1, 4, docs * size)
    for registers in (bag_minhash.REGISTERS, bag_minhash.FINE_REGISTERS):
        together = bag_minhash.signatures(doc, keys, counts, docs, registers)
        for d in (0, 57, docs - 1):
            own = slice(d * size, (d + 1) * size)
            assert (bag_minhash.signatures(np.zeros(size, np.int64), keys[own], counts[own], 1, registers)[0] == together[d]).all()


def test_ppm(spark):
    rows = sample(40)[:-2]
    docs = [*rows, (900, None), (901, "zz\x01 never ÿ")]
    got = {r.doc_id: r for r in ppm.report(frame(spark, docs), order=3).collect()}
    train = [t or "" for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = collections.Counter(w for t in train for w in brute.TOKEN.findall(brute.low(t)))
    counts[None] = len(train)
    n, v = sum(counts.values()), len(counts)
    for i, t in docs:
        words = [*brute.TOKEN.findall(brute.low(t)), None]
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(words), sum(counts[w] > 0 for w in words), n, zlib.crc32(str(i).encode()) % 7 == 2)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
        if len(t or "") < 600:
            assert math.isclose(r.score, brute.ppm(train, t, 3), rel_tol=1e-9)
    odd = [(5, "a b"), (5, "a b"), (None, "c"), (5, "d")]
    assert ppm.report(frame(spark, odd)).count() == 4
    assert ppm.report(frame(spark, [])).count() == 0


def test_ppm_joins_what_the_head_lacks(spark):
    rows = sample(20)
    counts = ppm.count(frame(spark, rows), order=2)
    trie = ppm.train(counts, order=2)
    full, none = (sorted(map(tuple, ppm.score(frame(spark, rows), counts, trie, head=h).select("doc_id", "n_known", "base_score").collect())) for h in (1 << 20, 1))
    assert [(a, b) for a, b, _ in full] == [(a, b) for a, b, _ in none] and np.allclose([x[2] for x in full], [x[2] for x in none])


def test_ppm_keeps_rare_ngrams_of_a_large_corpus(spark):
    rows = [(0, "0" * 2_200_000), (1, "abc abd"), (3, "abd abc"), (4, "été")]
    held = [(5, "abc abd abc"), (6, "abx"), (7, "été 00")]
    counts = ppm.count(frame(spark, rows), order=2)
    for options in ({}, {"frequent": 4}):
        got = {r.doc_id: r.score for r in ppm.score(frame(spark, held), counts, ppm.train(counts, order=2), **options).collect()}
        assert all(math.isclose(got[i], brute.ppm([x for _, x in rows], t, 2), rel_tol=1e-9) for i, t in held)


def test_ppm_grades_in_shards(spark):
    rows = sample(25)[:-2]
    for order in (0, 1, 4):
        counts = ppm.count(frame(spark, rows[:15]), order=order)
        low = ppm.train(counts, order=order)
        want = {i: brute.ppm([x for _, x in rows[:15]], t, order) for i, t in rows}
        for frequent in (1 << 19, 1):
            got = {r.doc_id: r.score for r in ppm.score(frame(spark, rows), counts, low, frequent=frequent).collect()}
            assert all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in want)


def test_chat_format_query_renders_whole_prefixes(spark):
    """The template of the query declares nothing: each turn is rendered after all turns before it."""
    seen = spark.sparkContext.accumulator(0)
    turns, roles = 30, ("user", "assistant")

    def counted(given):
        seen.add(len(given))
        return chat_format.render(given)

    vars(counted).update(vars(chat_format.render))
    rows = [(1, i, roles[i % 2], f"t{i}", "") for i in range(turns)]
    got = chat_format.format(chats(spark, rows), template=counted).collect()
    assert seen.value >= 3 * sum(range(1, turns + 1))
    assert "".join(r.formatted for r in got) == chat_format.render([r[2:4] for r in rows]) and not any(r.rewrites for r in got)
