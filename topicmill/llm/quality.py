"""Quality scores by co-training of two views of a document.

One classifier sees the text's content (hashed words), the other its metadata and
layout (language, source, length, lines, kinds of characters). Both start from
labelled documents; in each round either one labels the unlabelled documents that
it is surest of, for the other one to learn from. Both are then calibrated and combined
on scores of labelled documents by models that have not seen them, and score every
document.

Features are computed from whole texts where the text is read. Only samples of
bounded size reach the driver: by default `LABELLED` labelled and `UNLABELLED` other
documents, chosen by a hash of the id, each as some hundred numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from topicmill.llm.common import RollingHash, Words, slices

# Documents that training may use, whatever the table's size.
LABELLED, UNLABELLED = 9000, 9000
BUCKETS = 192
ROUNDS = 4
# Share of the unlabelled sample that one view labels in a round.
GIVEN = 0.05
PENALTY = 1e-3
# The least weight of the penalty, whatever the number of rows.
LEAST_PENALTY = 0.3
# Share of good documents that the threshold may cost on the held-out ones.
LOST = 0.002
# Parts of the labelled sample that are scored by models of the others.
FOLDS = 4
SEED = 41

_WORD_HASH = RollingHash(41)
# Shares of words that differ from the one before, below which a text repeats.
REPEAT_STEPS = (0.95, 0.9, 0.8, 0.6)
_CONTENT = BUCKETS + 1 + len(REPEAT_STEPS)
_LAYOUT = 17
_NAMED = 24


def _classes() -> np.ndarray:
    """Kind of each byte: lower, upper, digit, space, line end, sentence mark,
    other ASCII, other."""
    kind = np.full(256, 7)
    kind[:128] = 6
    kind[97:123], kind[65:91], kind[48:58] = 0, 1, 2
    kind[[9, 11, 12, 13, 32]], kind[10] = 3, 4
    kind[[ord(c) for c in ".,;:?!'\"()-"]] = 5
    return kind


_KIND = _classes()


def content_view(texts: pa.Array) -> np.ndarray:
    """Square roots of the shares of hashed words, and the share of words that
    differ from the one before, also in steps; zeros for a text without words."""
    words = Words(texts, lower=True)
    hashes = words.hashes(_WORD_HASH)
    n = len(texts)
    counts = np.diff(words.first)
    row = np.repeat(np.arange(n), counts)
    cells = np.bincount(row * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=n * BUCKETS)
    total = np.maximum(counts, 1)[:, None]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    differ = np.bincount(row[fresh], minlength=n)[:, None] / total
    steps = (differ < np.array(REPEAT_STEPS)) & (counts[:, None] >= 8)
    return np.hstack([np.sqrt(cells.reshape(n, BUCKETS) / total), differ, steps]).astype(np.float32)


def _text_hash(value: str | None, size: int) -> int:
    hashed = 0
    for byte in (value or "").encode("utf-8", "surrogatepass"):
        hashed = (hashed * 257 + byte + 1) % 1_000_003
    return hashed % size


def metadata_view(texts: pa.Array, langs: pa.Array, sources: pa.Array) -> np.ndarray:
    """Kinds of characters, lines, lengths, hashed language and source."""
    words = Words(texts)
    binary = texts.cast(pa.large_binary())
    offsets = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(texts) + 1]
    offsets = offsets - offsets[0]
    size = np.diff(offsets)
    n = len(texts)
    row = np.repeat(np.arange(n), size)
    kinds = np.bincount(row * 8 + _KIND[words.data], minlength=n * 8).reshape(n, 8)
    counts = np.diff(words.first)
    lines = kinds[:, 4] + 1
    out = np.zeros((n, _LAYOUT + _NAMED), np.float32)
    # Capped: one number or mark fills a good part of a short text.
    out[:, :8] = np.minimum(kinds / np.maximum(size, 1)[:, None], np.array([1, 1, 0.05, 0.3, 0.3, 0.1, 0.3, 1]))
    out[:, 8] = np.log1p(size) / 10
    out[:, 9] = np.log1p(lines) / 5
    out[:, 10] = np.log1p(counts / lines) / 5
    out[:, 11] = np.log1p(size / np.maximum(counts, 1)) / 3
    # Marks per word, in steps: the shares alone are too close together.
    per_word = kinds[:, 6] / np.maximum(counts, 1)
    for i, step in enumerate((0.02, 0.1, 0.5, 1.0)):
        out[:, 12 + i] = per_word > step
    out[:, 16] = kinds[:, 1] > kinds[:, 0]
    for i, (lang, source) in enumerate(zip(langs, sources)):
        out[i, _LAYOUT + _text_hash(lang.as_py(), 8)] = 1
        out[i, _LAYOUT + 8 + _text_hash(source.as_py(), 16)] = 1
    return out


class Logistic:
    """Logistic regression with a quadratic penalty, by Newton steps."""

    def __init__(self, dims: int):
        self.weights = np.zeros(dims + 1)

    @staticmethod
    def _with_one(x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.ones((len(x), 1), x.dtype)])

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 12) -> Logistic:
        x = self._with_one(x.astype(np.float64))
        ridge = np.full(x.shape[1], max(PENALTY * len(x), LEAST_PENALTY))
        ridge[-1] = 1e-6

        def loss(weights: np.ndarray) -> float:
            z = x @ weights
            return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * (ridge * weights) @ weights)

        now = loss(self.weights)
        for _ in range(steps):
            p = _sigmoid(np.clip(x @ self.weights, -30, 30))
            slope = x.T @ (y - p) - ridge * self.weights
            curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(ridge)
            move = np.linalg.solve(curve, slope)
            # A whole step may overshoot where there are few rows.
            while (then := loss(self.weights + move)) > now and np.abs(move).max() > 1e-6:
                move = move / 2
            self.weights, gain, now = self.weights + move, now - then, then
            if gain < 1e-6 * (1 + abs(now)):
                break
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x.astype(np.float64) @ self.weights[:-1] + self.weights[-1], -30, 30)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class QualityModel:
    """Two views, their calibration (slope and offset), how they are combined,
    and the score from which on a document is kept."""

    views: tuple[np.ndarray, np.ndarray]
    calibration: np.ndarray
    combined: np.ndarray
    threshold: float
    held_out: dict

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of good quality: content, metadata, both."""
        raw = [np.clip(x.astype(np.float64) @ w[:-1] + w[-1], -30, 30) for x, w in zip((content, metadata), self.views)]
        own = np.stack([a * r + b for (a, b), r in zip(self.calibration, raw)], axis=1)
        both = own @ self.combined[:-1] + self.combined[-1]
        return _sigmoid(np.clip(np.column_stack([own, both]), -30, 30))


def _co_trained(
    views: tuple[np.ndarray, np.ndarray], labels: np.ndarray, more: tuple[np.ndarray, np.ndarray], rounds: int
) -> list[Logistic]:
    """The two views' classifiers after `rounds` of labelling for each other."""
    known = [[v] for v in views]
    given = [[labels.astype(np.float64)] for _ in views]
    left = [np.arange(len(more[0])) for _ in views]
    models = [Logistic(v.shape[1]) for v in views]
    good_share = float(labels.mean())
    for step in range(rounds + 1):
        for m, xs, ys in zip(models, known, given):
            m.fit(np.vstack(xs), np.concatenate(ys))
        if step == rounds or not len(more[0]):
            break
        for teacher, pupil in ((0, 1), (1, 0)):
            pool = left[pupil]
            sure = models[teacher].logit(more[teacher][pool])
            order = np.argsort(sure, kind="stable")
            most = int(GIVEN * len(more[0]))
            bad = order[: int(round(most * (1 - good_share)))]
            good = order[::-1][: int(round(most * good_share))]
            # Confident ones only.
            bad, good = bad[sure[bad] < -2.0], good[sure[good] > 2.0]
            taken = np.concatenate([bad, good])
            known[pupil].append(more[pupil][pool[taken]])
            given[pupil].append(np.concatenate([np.zeros(len(bad)), np.ones(len(good))]))
            left[pupil] = np.delete(pool, taken)
    return models


def _smoothed(labels: np.ndarray) -> np.ndarray:
    """Targets a little inside 0 and 1, the more so the fewer rows a class has, so
    that a calibration on few rows stays finite."""
    n_good, n_bad = (labels == 1).sum(), (labels == 0).sum()
    return np.where(labels == 1, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))


def _calibrated(logits: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope and offset of each view, and how both are combined."""
    targets = _smoothed(labels)
    calibration = np.array([Logistic(1).fit(z[:, None], targets).weights for z in logits.T])
    own = np.stack([a * z + b for (a, b), z in zip(calibration, logits.T)], axis=1)
    return calibration, Logistic(2).fit(own, targets).weights


def _combined(logits: np.ndarray, calibration: np.ndarray, combined: np.ndarray) -> np.ndarray:
    own = np.stack([a * z + b for (a, b), z in zip(calibration, logits.T)], axis=1)
    return _sigmoid(np.clip(own @ combined[:-1] + combined[-1], -30, 30))


def _threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The score that costs about `LOST` of the good rows, half at most. One good row
    may be lost besides: of few rows, the lowest says nothing about the others."""
    good = np.sort(scores[labels == 1])
    return float(min(0.5, good[min(len(good) - 1, int(LOST * len(good)) + 1)]))


def co_train(
    content: np.ndarray, metadata: np.ndarray, labels: np.ndarray, more: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS
) -> QualityModel:
    """Train on labelled rows (`labels` 0 or 1) and unlabelled ones (`more`).

    Calibration, combination and threshold are fitted on scores that models of the
    other folds give to each labelled row, so all labelled rows serve them and none
    is scored by a model that has seen it. The figures in `held_out` use a
    calibration and a threshold of the other folds as well.
    """
    views = (content, metadata)
    fold = np.empty(len(labels), np.int64)
    for label in (0, 1):  # rows come in hash order; each fold gets its share of either label
        fold[labels == label] = np.arange((labels == label).sum()) % FOLDS
    fewest = min((labels == label).sum() for label in (0, 1))
    if fewest == 0 or len(labels) < 2 * FOLDS or fewest < 2:
        # Too little to tell good from bad: every document gets the commoner label.
        sure = 30.0 if len(labels) == 0 or labels.mean() >= 0.5 else -30.0
        flat = tuple(np.append(np.zeros(v.shape[1]), sure) for v in views)
        return QualityModel(flat, np.array([[1.0, 0.0]] * 2), np.array([0.5, 0.5, 0.0]), 0.5, {})
    logits = np.zeros((len(labels), 2))
    for k in range(FOLDS):
        others = _co_trained(tuple(v[fold != k] for v in views), labels[fold != k], more, rounds)
        for i, (m, v) in enumerate(zip(others, views)):
            logits[fold == k, i] = m.logit(v[fold == k])
    calibration, combined = _calibrated(logits, labels)
    threshold = _threshold(_combined(logits, calibration, combined), labels)

    wrong = np.zeros(len(labels), bool)
    for k in range(FOLDS):
        here = fold == k
        fitted = _calibrated(logits[~here], labels[~here])
        least = _threshold(_combined(logits[~here], *fitted), labels[~here])
        wrong[here] = (_combined(logits[here], *fitted) >= least) != (labels[here] == 1)
    held_out = {
        "rows": len(labels),
        "accuracy": float(1 - wrong.mean()),
        "good_kept": float(1 - wrong[labels == 1].mean()),
        "bad_rejected": float(1 - wrong[labels == 0].mean()),
    }
    models = _co_trained(views, labels, more, rounds)
    return QualityModel(tuple(m.weights for m in models), calibration, combined, threshold, held_out)


def _features(rows: DataFrame) -> DataFrame:
    """(doc_id, quality, content, metadata) of (doc_id, quality, text, lang, source)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                one, two = content_view(part.column(2)), metadata_view(*(part.column(i) for i in (2, 3, 4)))
                columns = [pa.array([x.tobytes() for x in view], pa.binary()) for view in (one, two)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], ["doc_id", "quality", "content", "metadata"])

    return rows.mapInArrow(run, "doc_id long, quality int, content binary, metadata binary")


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED) -> QualityModel:
    """Fit on samples of `docs` (doc_id, text, lang, source) and `labels`: at most
    `labelled` documents with a label, and `unlabelled` ones without to label each other.

    Labels: quality 0 or 1 per doc_id, others are ignored; of several for one
    document the lowest counts. Rows without id aren't used.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    rank = F.xxhash64("doc_id", F.lit(SEED))
    some = known.orderBy(rank, "doc_id").limit(labelled)
    rest = docs.select("doc_id").where("doc_id is not null").distinct().join(known, "doc_id", "left_anti")
    other = rest.orderBy(rank, "doc_id").limit(unlabelled).select("doc_id", F.lit(None).cast("int").alias("quality"))
    chosen = some.union(other)  # at most labelled + unlabelled rows
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source").join(F.broadcast(chosen), "doc_id")
    found = _features(wanted.select("doc_id", "quality", "text", "lang", "source"))
    # A bounded number of rows; repeated ids count once.
    rows = found.withColumn("_r", rank).dropDuplicates(["doc_id"]).orderBy("_r", "doc_id").drop("_r").collect()
    matrix = lambda name, part: np.array([np.frombuffer(r[name], np.float32) for r in part])
    with_label = [r for r in rows if r.quality is not None]
    without = [r for r in rows if r.quality is None]
    dims = {"content": _CONTENT, "metadata": _LAYOUT + _NAMED}
    views = [matrix(n, with_label).reshape(-1, d) for n, d in dims.items()]
    more = tuple(matrix(n, without).reshape(-1, d) for n, d in dims.items())
    return co_train(*views, np.array([r.quality for r in with_label], np.int64), more)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """`docs` with p_content, p_metadata, p_quality and keep.

    A null text or one without words has no content: it scores 0 and isn't kept.
    Null languages and sources are a value of their own. Repeated rows get equal
    scores. Other columns pass through; columns named like an output are replaced.
    """
    made = ["p_content", "p_metadata", "p_quality", "keep"]
    kept = [c for c in docs.columns if c not in made]
    place = {c: kept.index(c) for c in ("text", "lang", "source")}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column(place["text"])
                found = shared.value.scores(content_view(texts), metadata_view(texts, part.column(place["lang"]), part.column(place["source"])))
                found[np.diff(Words(texts).first) == 0] = 0.0
                keep = found[:, 2] >= max(shared.value.threshold, 1e-12)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(found[:, i]) for i in range(3)), pa.array(keep)], [*part.schema.names, *made]
                )

    source = docs.select(*kept)
    fields = [StructField(c, DoubleType()) for c in made[:3]] + [StructField("keep", BooleanType())]
    return source.mapInArrow(run, StructType([*source.schema.fields, *fields]))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without the documents that the classifier rejects."""
    return score(docs, train(docs, labels)).where("keep").select(*docs.columns)
