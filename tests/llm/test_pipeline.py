import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from .test_classify_match import brute_matches, prose
from .test_substring_simhash import brute_repeats, classes, fingerprint


@pytest.fixture(scope="module")
def folder(spark, corpus, docs, tmp_path_factory):
    """A table folder: the corpus, two leaked benchmark items, the benchmark."""
    import random

    rng = random.Random(8)
    items = [(k, prose(rng, "en", 30)) for k in range(4)]
    more = [(1000 + k, prose(rng, "en", 50) + "\n" + items[k][1] + " end", "en", "src0", 1) for k in range(2)]
    path = tmp_path_factory.mktemp("sf")
    docs.union(spark.createDataFrame(more, docs.schema)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), [*corpus, *more], items


def test_stages_equal_brute_force(spark, folder, clashing):
    path, rows, items = folder
    docs = clashing(spark.read.parquet(f"{path}/documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "sentencepiece"]

    def step(name):
        out = corpus_pipeline.written(stages[name](spark, docs, path), name)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        return out, {r["doc_id"]: r for r in out.collect()}

    texts = {r[0]: r[1] for r in rows}
    docs, got = step("language_id")
    assert set(got) == {d for d, t in texts.items() if any(c.isalpha() for c in t or "")}
    texts = {d: texts[d] for d in got}

    docs, got = step("simhash_near_dedup")
    prints = {d: fingerprint(t) for d, t in texts.items()}
    root = classes(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    assert set(got) == {d for d in root if root[d] == d}
    texts = {d: texts[d] for d in got}

    docs, got = step("substring_dedup")
    want = brute_repeats(texts.items(), 13)
    assert set(got) == {d for d, w in want.items() if w[1] < w[0] or not w[0]}
    assert all(got[d]["text"].encode().split() == want[d][3] and got[d]["n_chars"] == len(got[d]["text"]) for d in got)
    texts = {d: got[d]["text"] for d in got}

    docs, got = step("benchmark_decontamination")
    leaks = {d for d, _ in brute_matches(texts.items(), items)}
    assert leaks == {1000, 1001} and set(got) == set(texts) - leaks

    docs, got = step("sentencepiece")
    assert all(r["lossless"] and r["n_pieces"] == len(r["pieces"]) for r in got.values())
    assert {d: r["text"] for d, r in got.items()} == {d: t for d, t in texts.items() if d not in leaks}


def test_run_and_registration(spark, folder):
    import __spark_entry__

    path, rows, _ = folder
    out = __spark_entry__.queries()["pipeline"](spark, path)
    assert 0 < out.count() < len(rows)
    names = [q for q in __spark_entry__.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))


def test_stages_on_empty_tables(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, path), name)
        assert docs.count() == 0


def test_without_labels_texts_with_letters_stay(spark, folder):
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    got = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, path).collect()}
    assert got == {r[0] for r in rows if any(c.isalpha() for c in r[1] or "")}
