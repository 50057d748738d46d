"""The secret scanner's network, calibration and threshold come from all labelled windows."""

import random

from pyspark.sql import functions as F

from lanecast.llm import secrets


def _docs(spark, n):
    rng = random.Random(4)
    run = lambda kind, k: "".join(rng.choice(kind) for _ in range(k))
    texts = [f"password={run('abcdef012345', 20)}" for _ in range(n)]
    texts += [f"see {run('GHIJK6789', 20)} here" for _ in range(n)] + [f"so {run('lmnopqr', 18)} it is" for _ in range(n)]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def test_every_window_teaches_or_judges(spark, monkeypatch):
    docs, seen = _docs(spark, 2500), {}
    real, rows_of = secrets.judge, secrets.train_rows
    monkeypatch.setattr(secrets, "judge", lambda m, z, t, n, net: (seen.update(judged=n.sum()), real(m, z, t, n, net)))
    monkeypatch.setattr(secrets, "train_rows", lambda m, rows, total, net: (seen.update(taught=rows.count()), rows_of(m, rows, total, net)))
    net = secrets.Net(steps=40, rounds=2, shard_rows=2000)
    model = secrets.train(docs, net)
    windows = secrets.labelled(docs).distinct().count()
    assert windows == 7500 and seen["taught"] + seen["judged"] == windows  # 2,500 of a label, letters included: no sample
    assert model.recall >= 0.98 and model.precision > 0.9
    again = secrets.train(docs.repartition(7).withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))), net)
    assert (again.weights() == model.weights()).all() and again.threshold == model.threshold


def test_few_windows_teach_and_judge(spark):
    docs = _docs(spark, 2)
    model = secrets.train(docs, secrets.Net(steps=200))
    assert model.recall == 1.0 and model.threshold <= 1
    one = secrets.train(docs.filter("text LIKE 'password%'"))
    assert one.recall is None and one.threshold > 1
