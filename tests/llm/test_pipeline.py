"""Each stage of the pipeline against a brute-force version of what its predecessor kept."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terravane.llm import mixing, quality
from tests.llm.test_operators import brute_components


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('sf')}"
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefgh"), int(rng.integers(2, 7))))
    texts = [" ".join(word() for _ in range(int(rng.integers(30, 80)))) for _ in range(60)]
    texts += [texts[0], texts[0].replace(" ", "  "), texts[1] + " x", texts[2], "$$ !! ## " * 30, "|| %% || " * 40, *["!! ## %% " * n for n in range(20, 40)]]
    rows = [(i, t, "en", f"s{i % 3}" if i % 11 else None, len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int("#" not in t and "|" not in t), 0) for i, t in enumerate(texts)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        seen[name] = (docs, spark.read.parquet(f"{tmp_path}/{k}"))
        docs = seen[name][1]
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    assert list(seen) == ["quality classifier", "exact dedup", "simhash near-dedup", "source mixing", "best-fit packing"]
    ids = lambda df: collections.Counter(r.doc_id for r in df.select("doc_id").collect())

    before, after = seen["quality classifier"]
    model = quality.train(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert ids(after) == ids(quality.score(before, model).where("predicted = 1"))
    assert all("#" not in r.text for r in after.collect()) and after.count() >= 60

    before, after = seen["exact dedup"]
    first: dict[str, int] = {}
    for r in sorted(before.collect()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r.doc_id)
    assert ids(after) == collections.Counter(first.values())

    before, after = seen["simhash near-dedup"]
    assert ids(after) == collections.Counter({c for _, c in brute_components([tuple(r) for r in before.collect()]).values()})

    before, after = seen["source mixing"]
    want = collections.Counter({r.doc_id: r.copies for r in mixing.counted(before, mixing.plan_mix(before)).select("row.doc_id", "mix.copies").collect() if r.copies})
    assert ids(after) == want and max(want.values()) <= 3

    before, after = seen["best-fit packing"]
    assert ids(after.where("piece = 0")) == ids(before)
    sizes = after.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert sizes.where("n <> end or n > 2048").count() == 0


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and corpus_pipeline.ORACLE_SQL is None
