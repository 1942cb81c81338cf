"""The co-trained classifier: held-out accuracy and odd rows."""

from __future__ import annotations

import numpy as np

from forecourt.llm import quality
from forecourt.llm.stages import written

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("doc_id % 3 <> 0")
    scored = quality.score(documents, labels).select("doc_id", "score", "keep")
    held = spark.read.parquet(f"{FOLDER}/labels.parquet").where("doc_id % 3 = 0")
    rows = [(r.quality, r.keep, r.score) for r in scored.join(held, "doc_id").collect()]
    good, bad = [k for q, k, _ in rows if q == 1], [k for q, k, _ in rows if q == 0]
    assert len(good) > 300 and len(bad) > 50
    assert np.mean(good) > 0.98 and 1 - np.mean(bad) > 0.95
    assert scored.count() == documents.count()


def views(n=4000, seed=1):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, 2, n)
    return label, rng.normal(size=(n, 4)) + 2.0 * label[:, None] * [1, 1, 0, 0], rng.normal(size=(n, 3)) + 2.0 * label[:, None] * [1, 1, 0]


def test_views_teach_each_other():
    label, content, page = views()
    given, rest = np.arange(4000) < 80, np.arange(4000) >= 80
    model = quality.co_train(content[given], page[given], label[given], np.arange(80) % 2 == 0,
                             lambda teacher: quality.taught(teacher, content[rest], page[rest]))
    a, b, both = model.scores(content, page)
    right = [np.mean((s > 0.5) == label) for s in (a, b, both)]
    assert min(right[:2]) > 0.88 and right[2] > 0.95
    alone = quality.co_train(content[given], page[given], label[given], np.arange(80) % 2 == 0, lambda teacher: {})
    assert np.abs(alone.views[0]["weights"] - model.views[0]["weights"]).max() > 1e-3


def test_taught_sums_as_plain_loops():
    label, content, page = views(300, 5)
    teacher = quality.co_train(content[:100], page[:100], label[:100], np.arange(100) % 2 == 0, lambda teacher: {})
    got = quality.taught(teacher, content, page)
    for mine, (x, theirs, other) in enumerate(((content, page, teacher.views[1]), (page, content, teacher.views[0]))):
        own = teacher.views[mine]
        for value in (0, 1):
            rows = []
            for row, their in zip(x, theirs):
                z = ((their - other["mean"]) / other["scale"]) @ other["weights"][:-1] + other["weights"][-1]
                p = 1 / (1 + np.exp(-(other["platt"][0] * z + other["platt"][1] + teacher.prior)))
                if (p if value else 1 - p) >= quality.SURE:
                    rows.append(np.append((row - own["mean"]) / own["scale"], 1))
            z = got[mine, value]
            assert 0 < len(rows) == z[-1, -1] and np.allclose(z[-1], sum(rows)) and np.allclose(z[:-1], sum(np.outer(r, r) for r in rows))


def test_separation_is_the_least_squares_fit():
    label, content, _ = views(400, 2)
    x, y = np.column_stack((content, np.ones(400))), 2.0 * label - 1
    share = np.where(label == 1, 0.5 / label.sum(), 0.5 / (1 - label).sum())
    w = quality._separated(*(quality._sums(content[label == v]) for v in (0, 1)))
    loss = lambda v: share @ (x @ v - y) ** 2 + quality.RIDGE * v @ v
    assert all(loss(w) < loss(w + d) for d in 1e-3 * np.random.default_rng(0).normal(size=(50, 5)))


def test_all_unlabelled_rows_teach(spark, monkeypatch):
    """The fit over Spark is the fit over all rows at once."""
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 2500").repartition(7)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    made, real = {}, quality.co_train

    def kept(content, page, label, held, others):
        made.update(content=content, page=page, label=label, held=held)
        made["model"] = real(content, page, label, held, others)
        return made["model"]

    def stage(name, frame, real=written(spark, "t")):
        made["features"] = real(name, frame)
        return made["features"]

    monkeypatch.setattr(quality, "co_train", kept)
    quality.fit(documents.select("doc_id", "text", "lang", "source", "n_chars"), labels, stage)
    rest = np.array([r.x for r in made["features"].where("label < 0").collect()], float)
    assert len(rest) + len(made["label"]) == documents.count() and len(rest) > 1000
    whole = real(made["content"], made["page"], made["label"], made["held"],
                 lambda teacher: quality.taught(teacher, rest[:, :quality.GRAMS], rest[:, quality.GRAMS:]))
    for a, b in zip(made["model"].views, whole.views):
        assert np.allclose(a["weights"], b["weights"], rtol=1e-6, atol=1e-8) and np.allclose(a["platt"], b["platt"], rtol=1e-6)
    assert np.isclose(made["model"].threshold, whole.threshold, rtol=1e-6)


def test_odd_rows(spark):
    columns = "doc_id bigint, text string, lang string, source string, n_chars int, keep string"
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "s", -4, "x"), (2, "", "en", "s", -4, "x"), (None, "a " * 50_000, "en", "s", 9, "x")]
    frame = spark.createDataFrame(rows, columns)
    no_labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = quality.score(frame, no_labels)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "content_score", "page_score", "score", "keep"]
    assert [(r.score, r.keep) for r in out.collect()] == [(None, True)] * 4
    assert quality.score(frame.limit(0), no_labels).count() == 0
    many = spark.createDataFrame([(i, ("fine words here " if i % 2 else "B@D!! ") * 20, "en", "s", 9, "x") for i in range(200)], columns)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(1, None, 0), (5000, 7, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.score(many.union(frame), labels).collect()
    assert len(got) == 204 and all(r.score is not None for r in got)
    assert all(r.keep == bool(r.doc_id % 2) for r in got if r.doc_id is not None and r.text and len(r.text) < 1000)
