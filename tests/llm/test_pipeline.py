"""The stages against plain versions, on a small corpus with nulls, copies, passages, leaks and junk."""

import random

import public_tokenizers
import pytest

import brute
import corpus_pipeline
from vantage.llm import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(8)
    texts = brute.near_texts(3, n=150, size=150, vocabulary=3000)
    junk = [" ".join(["same"] * 60) if i % 2 else " ".join(f"W{rng.randrange(99)}!!" for _ in range(50)) for i in range(50)]
    items = [(i, " ".join(f"q{rng.randrange(500)}" for _ in range(25))) for i in range(6)]
    items += [(9, None), (None, " ".join(f"n{i}" for i in range(12)))]
    leaks = [f"{texts[-i - 1]} {items[i][1].upper()} the end" for i in range(5)] + [items[7][1]]
    docs = [(i, t) for i, t in enumerate(texts + junk + leaks)]
    labels = [(i, 0 if len(texts) <= i < len(texts) + len(junk) else 1, 0) for i, _ in docs]
    docs += [(900, None), (901, ""), (902, " \n"), (903, "x" * 9000), (None, texts[5]), (None, leaks[0]), (7, texts[7])]
    folder = f"file://{tmp_path_factory.mktemp('corpus')}"
    rows = [(i, t, "en", f"src{k % 3}", len(t or "")) for k, (i, t) in enumerate(docs)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items, {i for i, q, _ in labels if q == 0}


def plain(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_match_brute_force(spark, corpus):
    from tokenizers import Tokenizer
    folder, items, junk = corpus
    stage = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = []

    def through(name):
        nonlocal docs
        out = corpus_pipeline.materialize(stage[name](spark, docs, folder), name)
        before, docs = plain(docs), out
        if name != "tokens":
            assert out.columns == COLUMNS
            held.append(out.count())
        return before, plain(out) if name != "tokens" else out.collect()

    before, after = through("quality")
    assert not {i for i, _ in after} & junk and len(after) >= len(before) - len(junk) - 3

    before, after = through("near_duplicates")
    label = brute.similar_groups(before, 5, 80, 100)
    assert sorted(after, key=repr) == sorted(((i, t) for i, t in before if i is None or label[i] == i), key=repr)
    assert len(after) < len(before)

    before, after = through("substrings")
    want = [(i, kept if gone else t) for (i, t), (_, _, gone, kept) in zip(before, brute.cut_repeats(before, 20))]
    assert sorted(after, key=repr) == sorted(want, key=repr) and sorted(after, key=repr) != sorted(before, key=repr)
    assert all(r.n_chars == len(r.text or "") for r in docs.collect())

    before, after = through("decontaminate")
    hit = brute.leaks(before, items, 10)
    assert sorted(after, key=repr) == sorted((d for d, h in zip(before, hit) if not h[2]), key=repr)
    assert len(after) < len(before)

    before, after = through("tokens")
    library = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    ids = sorted(((i, library.encode(t or "", add_special_tokens=False).ids) for i, t in before), key=repr)
    assert sorted(((r.doc_id, list(r.ids)) for r in after), key=repr) == ids
    assert held == sorted(held, reverse=True)


def test_run_and_registry(spark, corpus):
    import __spark_entry__ as entry
    folder, _, junk = corpus
    got = entry.queries()["pipeline"](spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    rows = got.collect()
    assert rows and all(r.n_tokens == len(r.ids) for r in rows) and not {r.doc_id for r in rows} & junk
    assert "pipeline" not in entry.oracle_sql()
    assert [n for n in entry.queries() if n.startswith("op")] == [n for n in queries.REGISTRY if n.startswith("op")]
    assert {int(n[2:].split("_")[0]) for n in queries.REGISTRY} == set(range(1, 14))
    assert [f for _, f in corpus_pipeline.STAGES] == [
        corpus_pipeline.quality, corpus_pipeline.near_duplicates, corpus_pipeline.substrings,
        corpus_pipeline.decontaminate, corpus_pipeline.tokens]


def test_empty_corpus(spark, corpus, tmp_path):
    folder = f"file://{tmp_path}"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus[0]}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_extra_columns_whose_names_clash(spark, corpus):
    from pyspark.sql import functions as F
    folder = corpus[0]
    more = ["score", "predicted", "held_out", "leak", "row", "kept", "id", "text_hash"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(
        "*", *(F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in more))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), name)
        assert docs.columns == COLUMNS + more and 0 < docs.count() <= before
        wrong = F.lit(False)
        for c in more:
            wrong = wrong | (F.col(c) != F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
        assert docs.where(wrong).count() == 0
