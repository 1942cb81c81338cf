"""Quality classifier by co-training a text-content view and a page-metadata view.

The content view sees hashed character trigrams; the metadata view sees language, source, length
and page statistics (lines, words, repetition, character classes). Both are linear classifiers by
ridge regression, fitted first on a bounded sample of labelled rows. In each of some rounds every
unlabelled row of the corpus that a view is sure of becomes a training row of the other view,
with the label that the view gives it, and the other view is fitted to all of them and its
labelled rows.
At the end each view is calibrated on labelled rows that neither has seen, the calibrated views
are combined, and every document is scored with whole text.

Features are computed once and written. A round is one scan of them: tasks add up products of
features by class, which is all that the fit needs, and these are added over tasks while they
stream by. Only the sums, a few squares of the feature count, and the bounded labelled sample
reach the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.stages import Stage, added_up, raw_bytes, released, sliced, written

LABELLED, ROUNDS, SURE, RIDGE = 8_000, 3, 0.95, 0.1
GRAMS, PLACES = 256, 32
GOOD_LOST = 0.005  # the threshold may reject at most this share of the good calibration rows


def content_features(raw: np.ndarray) -> np.ndarray:
    """Square roots of trigram shares, hashed to ``GRAMS`` cells."""
    if len(raw) < 3:
        return np.zeros(GRAMS)
    count = np.zeros(GRAMS, np.int64)
    for at in range(0, len(raw) - 2, 1 << 20):
        part = raw[at:at + (1 << 20) + 2].astype(np.uint32)
        code = part[:-2] << np.uint32(16) | part[1:-1] << np.uint32(8) | part[2:]
        count += np.bincount((code * np.uint32(2654435761)) >> np.uint32(24), minlength=GRAMS)
    return np.sqrt(count / count.sum())


_CLASSES = np.zeros((256, 7))
for _i in range(256):
    _c = chr(_i)
    _CLASSES[_i] = [_c == "\n", _c in " \t\r", "a" <= _c <= "z", "A" <= _c <= "Z", _c.isascii() and _c.isdigit(),
                    _c in ".,;:'\"?-()", _i >= 128]


def page_features(text: str, raw: np.ndarray, lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Statistics of the page, its length, and its language and source as hashed places."""
    shares = np.bincount(raw, minlength=256) @ _CLASSES / max(1, len(raw))
    words = text.split()
    distinct = len(set(words)) / max(1, len(words))
    length = len(text) if n_chars is None else max(0, n_chars)
    other = 1 - shares.sum() if len(raw) else 0.0
    out = np.zeros(11 + PLACES)
    out[:11] = [*shares, other, distinct, len(raw) / (1 + len(words)) / 10, np.log1p(length) / 10]
    for kind, value in (("lang", lang), ("source", source)):
        out[11 + zlib.crc32(f"{kind}={value}".encode()) % PLACES] += 1
    return out


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    content, page = [], []
    for text, lang, source, n_chars in zip(batch.column("text"), batch.column("lang").to_pylist(),
                                           batch.column("source").to_pylist(), batch.column("n_chars").to_pylist()):
        given = raw_bytes(text)
        value, raw = given.decode(errors="replace"), np.frombuffer(given, np.uint8)
        content.append(content_features(raw))
        page.append(page_features(value, raw, lang, source, n_chars))
    if not content:
        return np.empty((0, GRAMS)), np.empty((0, 11 + PLACES))
    return np.array(content), np.array(page)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Class-balanced logistic regression by Newton steps; the last weight is the bias."""
    x = np.column_stack((x, np.ones(len(x))))
    share = y.mean()
    importance = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(y)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (importance * (p - y)) + ridge * w
        curve = (x * (importance * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _margin(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _calibrated(margin: np.ndarray, y: np.ndarray) -> list[float]:
    """Slope and shift of a Platt fit."""
    return _logistic(margin[:, None], y, 1e-4).tolist()


@dataclass(frozen=True)
class Model:
    """Scale, weights and calibration of each view, the weights that combine them, and the threshold."""

    views: tuple[dict, dict]
    combine: tuple[float, ...] = ()
    threshold: float = 0.5
    prior: float = 0.0  # log-odds of good among the labelled rows; calibration weighs the classes the same

    def logits(self, content: np.ndarray, page: np.ndarray) -> list[np.ndarray]:
        """The calibrated log-odds that each view gives."""
        out = []
        for x, view in zip((content, page), self.views):
            margin = _margin((x - view["mean"]) / view["scale"], view["weights"])
            out.append(np.clip(view["platt"][0] * margin + view["platt"][1], -30, 30))
        return out

    def scores(self, content: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        logits = self.logits(content, page)
        both = self.combine[0] * logits[0] + self.combine[1] * logits[1] + self.combine[2]
        return _sigmoid(logits[0]), _sigmoid(logits[1]), _sigmoid(both)


def _sums(x: np.ndarray) -> np.ndarray:
    """Products, sums and number of the rows of one class, as one matrix; the last column is the bias."""
    z = np.column_stack((x, np.ones(len(x))))
    return np.vstack((z.T @ z, z.sum(axis=0)))


def _separated(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Weights of the ridge regression to -1 and 1 in which both classes weigh the same, from their sums."""
    bad, good = bad / bad[-1, -1] / 2, good / good[-1, -1] / 2
    return np.linalg.solve(bad[:-1] + good[:-1] + RIDGE * np.eye(len(bad) - 1), good[-1] - bad[-1])


def taught(teacher: Model, content: np.ndarray, page: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    """By (view, class), the sums over the rows that the other view is sure of."""
    out, logits = {}, teacher.logits(content, page)
    sure = np.log(SURE / (1 - SURE))
    for mine, (x, view) in enumerate(zip((content, page), teacher.views)):
        theirs = logits[1 - mine] + teacher.prior
        for value, rows in ((0, theirs <= -sure), (1, theirs >= sure)):
            if rows.any():
                out[mine, value] = _sums((x[rows] - view["mean"]) / view["scale"])
    return out


Taught = Callable[[Model], dict[tuple[int, int], np.ndarray]]


def co_train(content: np.ndarray, page: np.ndarray, label: np.ndarray, held: np.ndarray, others: Taught) -> Model | None:
    """Fit on labelled rows, of which ``held`` ones calibrate, and on what ``others`` adds up over the unlabelled rows.

    None without both classes in each part. Taught rows of a class weigh as much as labelled ones,
    but together no more than all labelled ones of it.
    """
    fit = ~held
    if any(len(np.unique(label[part])) < 2 for part in (fit, held)):
        return None
    views, own, scaled = [], [], []
    for x in (content, page):
        mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3
        scaled.append((x - mean) / scale)
        own.append([_sums(scaled[-1][fit & (label == value)]) for value in (0, 1)])
        views.append({"mean": mean, "scale": scale})
    weights, prior = [_separated(*sums) for sums in own], float(np.log((label == 1).sum() / (label == 0).sum()))

    def judged() -> Model:
        return Model(tuple({**v, "weights": w, "platt": _calibrated(_margin(x[held], w), label[held])}
                           for v, w, x in zip(views, weights, scaled)), prior=prior)

    for _ in range(ROUNDS):
        sums = others(judged())
        for mine in (0, 1):
            more = [min(1.0, own[mine][v][-1, -1] / z[-1, -1]) * z if (z := sums.get((mine, v))) is not None else 0 for v in (0, 1)]
            weights[mine] = _separated(*(a + b for a, b in zip(own[mine], more)))
    model = judged()
    logits = model.logits(content[held], page[held])
    combine = _logistic(np.column_stack(logits), label[held], 1e-3)
    score = _sigmoid(np.column_stack((*logits, np.ones(held.sum()))) @ combine)
    good, bad = np.sort(score[label[held] == 1]), score[label[held] == 0]
    highest = good[int(GOOD_LOST * len(good))]
    cuts = np.concatenate((good, bad))
    cuts = cuts[cuts <= highest]
    lost = np.searchsorted(good, cuts) / len(good)
    kept = np.searchsorted(np.sort(bad), cuts) / len(bad)
    return Model(model.views, tuple(combine.tolist()), float(min(0.5, cuts[np.argmax(kept - lost)])), prior)


def _matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    parts = [c.flatten().to_numpy() for c in getattr(column, "chunks", [column])]
    return (np.concatenate(parts) if parts else np.empty(0)).reshape(n, -1).astype(float)


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(sliced(batches)):
        content, page = _features(batch)
        both = np.hstack((content, page)).astype(np.float32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(both) + 1) * (GRAMS + 11 + PLACES), pa.int32()), pa.array(both.ravel()))
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "label": batch.column("label"), "x": lists})


def fit(documents: DataFrame, labels: DataFrame, stage: Stage) -> Model | None:
    """Co-train on at most ``LABELLED`` labelled documents, chosen by hash, and all unlabelled ones."""
    sample = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    marked = documents.join(F.broadcast(sample), "doc_id", "left").select(
        "doc_id", "text", "lang", "source", F.col("n_chars").cast("bigint").alias("n_chars"), F.coalesce("quality", F.lit(-1)).cast("int").alias("label"))
    features = stage("features", marked.mapInArrow(_seen, "doc_id bigint, label int, x array<float>"))
    # One row of each labelled document, however often it is repeated.
    known = features.where("label >= 0").groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("x").alias("h"), "label", "x")).alias("r")) \
        .select(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(4)).alias("part"), "doc_id", "r.label", "r.x").orderBy("doc_id").toArrow()
    if not known.num_rows:
        return None
    x, label, part = _matrix(known.column("x"), known.num_rows), known.column("label").to_numpy(), known.column("part").to_numpy()
    unlabelled = features.where("label < 0").select("x")

    def others(teacher: Model) -> dict[tuple[int, int], np.ndarray]:
        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for batch in released(sliced(batches)):
                rows = _matrix(batch.column("x"), batch.num_rows)
                for key, z in taught(teacher, rows[:, :GRAMS], rows[:, GRAMS:]).items():
                    total[key] = total[key] + z if key in total else z
            task = TaskContext.get().partitionId()
            for (view, value), z in total.items():
                n = len(z)
                yield pa.record_batch({"view": pa.array([view] * n, pa.int32()), "value": pa.array([value] * n, pa.int32()),
                                       "pos": pa.array(range(n), pa.int32()), "task": pa.array([task] * n, pa.int32()),
                                       "z": pa.array(list(z), pa.list_(pa.float64()))})

        sent = unlabelled.mapInArrow(added, "view int, value int, pos int, task int, z array<double>")
        out: dict[tuple[int, int], list] = {}
        for r in sorted(added_up(sent, "view", "value", "pos").collect(), key=lambda r: (r.view, r.value, r.pos)):
            out.setdefault((r.view, r.value), []).append(r.z)
        return {key: np.array(z) for key, z in out.items()}

    return co_train(x[:, :GRAMS], x[:, GRAMS:], label, part == 0, others)


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with ``content_score``, ``page_score``, ``score`` (probability of quality 1) and ``keep``.

    Null or blank texts are scored as the empty text, a null language or source as a value of
    its own, a null length as the length of the text. Labels other than 0 and 1 are ignored and
    of several labels for one document the lowest counts. Where the sample lacks a class, or
    there are no labels, scores are null and every row is kept. Repeated rows get equal scores;
    other columns pass through, columns with the names above are replaced.
    """
    model = fit(documents.select("doc_id", "text", "lang", "source", "n_chars"), labels, written(documents.sparkSession, "quality"))
    kind = "struct<content_score:double,page_score:double,score:double,keep:boolean>"
    if model is None:
        scored = F.from_json(F.lit('{"keep":true}'), kind)
    else:
        @F.arrow_udf(kind)
        def judged(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for text, lang, source, n_chars in released(batches):
                content, page = _features(pa.record_batch(
                    {"text": text, "lang": lang, "source": source, "n_chars": n_chars}))
                a, b, c = model.scores(content, page)
                yield pa.StructArray.from_arrays([pa.array(a), pa.array(b), pa.array(c), pa.array(c >= model.threshold)],
                                                 ["content_score", "page_score", "score", "keep"])

        scored = judged("text", "lang", "source", F.col("n_chars").cast("bigint"))
    names = ("content_score", "page_score", "score", "keep")
    passed = [F.col(f"`{c}`") for c in documents.columns if c.lower() not in names]
    return documents.select(*passed, scored.alias("_judged")).select(*passed, "_judged.*")
