"""Work of a task that must not grow with sources or repeated ids."""
import random

from starloom.llm import quality, source_mix
from test_documents_ops import brute_targets


def test_targets_of_many_sources_without_one_task(spark):
    rng = random.Random(3)
    sizes = {f"s{i}": int(rng.paretovariate(0.4)) for i in range(3000)} | {None: 7, "none": 0}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = source_mix.source_targets(table)
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    want = brute_targets(sizes)
    assert len(got.collect()) == len(want)
    assert all(abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) for r in got.collect())
    assert source_mix.source_targets(table.limit(0)).collect() == []


def test_training_takes_an_id_once(spark, monkeypatch):
    seen = {}

    def stored(df, name, rows=None, keep=quality.materialise):
        out = keep(df, name, rows)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(quality, "materialise", stored)
    ids = [i for i in range(200) for _ in range(5)]
    docs = spark.createDataFrame([(i, f"some text {i} {n}") for n, i in enumerate(ids)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int")
    quality.train(docs, labels)
    outside = labels.filter(~quality.in_test_fold("doc_id")).select("doc_id").distinct().count()
    assert seen["labels"] == seen["features"] == outside > 0
