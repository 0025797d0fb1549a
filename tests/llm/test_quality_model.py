import numpy as np
from helpers import messy, texts

from snapledger.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_documents_are_told_apart(spark):
    from snapledger.llm.queries import op8_quality

    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = op8_quality(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    good, bad = (np.array([r.score for r in rows if r.quality == q]) for q in (1, 0))
    wins = (good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()
    assert len(bad) > 5 and wins > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_statistics_are_finite_for_any_text():
    for t in texts():
        assert len(quality.statistics(t)) == len(quality.NAMES) and np.isfinite(quality.statistics(t)).all()
    assert quality.statistics("Ab 1 !\n") != quality.statistics("ab 1 !\n")


def test_scores_are_the_posterior_of_two_gaussians(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k % 2), (rng.standard_normal(len(quality.NAMES)) + k % 2).tolist()) for k in range(400)]
    table = spark.createDataFrame(rows, "label int, stats array<double>")
    model = quality.fit(table)
    x = np.array([r[1] for r in rows])
    logs = []
    for label in (0, 1):
        own = x[[r[0] == label for r in rows]]
        cov = np.cov(own.T, bias=True)
        pooled = sum(np.var(x[[r[0] == k for r in rows]], axis=0) / 2 for k in (0, 1))
        cov = (1 - quality.SHRINKAGE) * cov + quality.SHRINKAGE * np.diag(np.diag(cov)) + np.diag(quality.RIDGE * pooled)
        gap = x - own.mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap) - 0.5 * np.linalg.slogdet(cov)[1] + np.log(len(own) / len(x)))
    want = 1 / (1 + np.exp((logs[0] - logs[1]) / quality.TEMPERATURE))
    assert np.allclose(model.scores(x), want)


def test_without_labels_every_score_is_a_half(spark):
    _, docs = messy(spark)
    stats = quality.with_statistics(docs)
    none = spark.createDataFrame([(None, [0.0] * len(quality.NAMES))], "label int, stats array<double>")
    scored = quality.score(stats, quality.fit(none)).collect()
    assert {r.score for r in scored} == {0.5} and {r.predicted for r in scored} == {0} and len(scored) == docs.count()
    assert quality.score(stats.filter("false"), quality.fit(none)).collect() == []
