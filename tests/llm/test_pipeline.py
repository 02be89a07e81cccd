import collections
import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline
from tessella.llm import quality_additive
from tessella.llm.queries import QUERIES, tokenizer


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    rows = out.collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows) and all(len(r.ids) == r.n_tokens for r in rows)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of small tables: copies, near copies, benchmark passages, nulls, repeated rows and ids, a long text, clashing names."""
    r = random.Random(12)
    say = lambda n: " ".join(r.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()) + r.choice(["", "s", "ing"]) for _ in range(n))
    passage, secret, rows = say(70), say(30), []
    for i in range(60):
        text = "\n".join(say(r.randrange(4, 40)) for _ in range(r.randrange(1, 5)))
        if i % 6 == 1:
            text = rows[-1][1]
        elif i % 6 == 2:
            text = rows[-1][1] + " tail"
        elif i % 6 == 3:
            text += "\n" + passage
        elif i % 6 == 4:
            text += " " + secret + " end"
        elif i % 6 == 5:
            text = "!!! $$$ " * r.randrange(3, 30)
        rows.append((i, text))
    rows += [(90, None), (91, None), (None, None), (92, ""), (93, ""), (None, say(30)), (94, say(20_000)), rows[0], rows[0], (95, "a b c")]
    folder = f"file://{tmp_path_factory.mktemp('sf')}"
    docs = spark.createDataFrame([(i, t, "s", None if t is None else len(t), 1, "x", "y") for i, t in rows], "doc_id long, text string, source string, n_chars long, node int, class_id string, score string")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 6 != 5)) for i in range(60)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, secret), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    stages, want = [f for _, f in corpus_pipeline.STAGES], pairs(docs)
    model = quality_additive.train(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    bad = {t for t, s in ((r.text, r.score) for r in docs.select("text").distinct().select(F.col("text").alias("doc_id"), "text").transform(lambda d: quality_additive.score(d, model)).select(F.col("doc_id").alias("text"), "score").collect()) if s < 0.5}
    assert 5 <= len([1 for _, t in want if t in bad]) < len(want) / 2

    def expect(out, rows):
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert sorted(pairs(out), key=repr) == sorted(rows, key=repr)
        return spark.createDataFrame(out.collect(), out.schema)

    want = [(i, t) for i, t in want if t not in bad]
    now = expect(stages[0](spark, docs, tables), want)

    with_id = sorted({(i, t) for i, t in want if i is not None and t is not None})
    cleaned = {(i, t): kept for (i, t), (_, kept, _) in zip(with_id, brute.without_repeats(with_id))}
    want = [(i, cleaned.get((i, t), t)) for i, t in want]
    emptied = {i for (i, t), kept in cleaned.items() if kept == "" and t != ""}
    want = [(i, t) for i, t in want if i not in emptied]
    now = expect(stages[1](spark, now, tables), want)
    assert emptied and all(r.n_chars is None or r.n_chars == len(r.text) for r in now.collect())

    order = sorted(set(want), key=lambda x: (x[0] is None, x[0] or 0))
    classes = brute.near_classes([(n, t) for n, (_, t) in enumerate(order)])
    want = [order[n] for n, least in classes if n == least]
    now = expect(stages[2](spark, now, tables), want)

    hit = {n for n, *_, dirty in brute.contamination(list(enumerate(t for _, t in want)), [(1, spark.read.parquet(f"{tables}/benchmark.parquet").where("item_id = 1").first().text)]) if dirty}
    want = [x for n, x in enumerate(want) if n not in hit]
    assert hit
    now = expect(stages[3](spark, now, tables), want)

    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    got = collections.Counter((r.doc_id, tuple(r.ids)) for r in stages[4](spark, now, tables).collect())
    assert got == collections.Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in want)


def test_stages_take_an_empty_table(spark, tables):
    empty = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, tables).count() == 0
