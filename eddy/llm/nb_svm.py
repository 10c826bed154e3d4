"""Document quality by naive Bayes support vectors.

Features are indicators: which hashed n-grams a text has, of its bytes
(``ORDERS``, case kept) and of its words' shapes (the kinds of the first
and the last byte, or "same as the word before"; 1 to 3 in a row).  Each is scaled by its class log-count ratio, as in
multinomial naive Bayes over indicators, and a linear hinge-loss model is
fitted on the scaled features by dual coordinate descent.

The counts behind the ratios cover all training rows (summed by feature
block in Spark; ``2 * DIM`` numbers reach the driver).  The support
vectors are fitted on a bounded sample: about
``SAMPLE`` training rows of each class, drawn by a hash of their doc_id.  Margins become
probabilities by a logistic curve fitted on the same sample, weighted back
to the training rows' share of classes.

Training rows are labelled rows whose crc32(doc_id as text) mod ``FOLDS``
is not 0.  Only the text feeds a score.

Defined cases: a null or empty text has no features and scores by the
intercept; a null doc_id is not held out and has no label; labels that are
null or contradict each other for one doc_id are left out; without any
training rows of both classes every score is the share of label 1 (0.5 if
there are no labels); repeated rows each give a row; extra columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddy.llm.graph import written
from eddy.llm.textarrays import Words, mix, utf8

ORDERS = (2, 4)
SHAPES = (1, 2, 3)
BITS = 18
DIM = 1 << BITS
BLOCK = 1 << 13
FOLDS = 5
SAMPLE = 1500
ALPHA, COST, PASSES = 1.0, 1.0, 30
THRESHOLD = 0.3
PIECE_BYTES = 1 << 20

_U = np.uint64


_KIND = np.full(256, 4, np.uint64)             # other bytes of longer characters
_KIND[:128] = 3
_KIND[48:58], _KIND[65:91], _KIND[97:123] = 2, 1, 0
_SAME = _U(31)


def _hashed(symbols: np.ndarray, n: int, bits: int, salt: int) -> np.ndarray:
    """Feature numbers of the n-grams of small symbols."""
    if len(symbols) < n:
        return np.empty(0, np.int32)
    h = np.full(len(symbols) - n + 1, salt, np.uint64)
    for k in range(n):
        h = h << _U(bits) | symbols[k:k + len(h)]
    return (mix(h) >> _U(64 - BITS)).astype(np.int32)


def features(text: np.ndarray) -> np.ndarray:
    """Sorted distinct feature numbers of a text's bytes."""
    found = []
    for a in range(0, len(text), PIECE_BYTES):
        x = text[a:a + PIECE_BYTES + max(ORDERS) - 1].astype(np.uint64)
        found += [_hashed(x, n, 8, n) for n in ORDERS]
    words = Words(text, np.array([0, len(text)]))
    if len(words.starts):
        shape = _KIND[text[words.starts]] * _U(5) + _KIND[text[words.ends - 1]]
        h = words.hashes()
        shape[1:][h[1:] == h[:-1]] = _SAME
        found += [_hashed(shape, n, 5, 100 + n) for n in SHAPES]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int32)


def held_out(doc_id: Column) -> Column:
    crc = F.crc32(doc_id.cast("bigint").cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(FOLDS)) == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray        # per feature: weight times ratio
    squares: np.ndarray        # per feature: ratio squared (for the length of a text's vector)
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        length = max(1e-12, float(np.sqrt(self.squares[found].sum())))
        return float(self.weights[found].sum()) / length + self.bias

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -500, 500))))


def log_count_ratios(counts: np.ndarray) -> np.ndarray:
    """counts[label, feature] -> smoothed log ratio of label 1 to label 0."""
    p, q = (ALPHA + counts[1], ALPHA + counts[0])
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias minimising |w|^2/2 + sum cost_i * hinge_i, one dual variable at a time.

    Row i holds the features ``rows[i]`` with the values ``ratios``, scaled
    to length one.
    """
    values = [ratios[r] for r in rows]
    values = [v / max(1e-12, float(np.sqrt((v * v).sum()))) for v in values]
    y = np.where(labels > 0, 1.0, -1.0)
    w, bias, alpha = np.zeros(len(ratios)), 0.0, np.zeros(len(rows))
    rng = np.random.Generator(np.random.PCG64(5))
    for _ in range(PASSES):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            r, v = rows[i], values[i]
            gradient = y[i] * (float(w[r] @ v) + bias) - 1
            new = min(max(alpha[i] - gradient / 2.0, 0.0), cost[i])     # |x|^2 = 1, and 1 for the bias
            step = new - alpha[i]
            if step:
                worst = max(worst, abs(step))
                alpha[i] = new
                w[r] += step * y[i] * v
                bias += step * y[i]
        if worst < 1e-3:
            break
    return w, bias


def fit(counts: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, share: float) -> Model:
    """share: of label 1 among all training rows."""
    if not len(labels) or labels.min() == labels.max():
        odds = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Model(np.zeros(DIM), np.zeros(DIM), 0.0, 1.0, float(odds))
    ratios = log_count_ratios(counts)
    w, bias = dual_descent(rows, labels, ratios, np.full(len(rows), COST))
    model = Model(w * ratios, ratios * ratios, bias, 1.0, 0.0)
    weight = np.where(labels > 0, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    slope, shift = _logistic(np.array([model.margin(r) for r in rows]), labels, weight)
    return replace(model, slope=slope, shift=shift)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic curve by Newton steps, slightly regularised."""
    # softened targets, so that a separable sample keeps a finite slope
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z = np.stack([x, np.ones_like(x)], axis=1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        grad = z.T @ (weight * (p - target)) + 1e-3 * b
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        b -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


# -- in Spark ------------------------------------------------------------------

_GATHERED = "kind string, block int, label int, part int, data binary"
#: Tasks' counts of one block that are added up in one group.
FAN_IN = 256


def _gather(batches):
    """Feature counts of a task's training rows by block, and its sampled rows."""
    counts = np.zeros((2, DIM), np.int64)
    part = TaskContext.get().partitionId()
    for batch in batches:
        data, off = utf8(batch.column("text"))
        sampled, of = [], []
        for i, (label, pick) in enumerate(zip(batch.column("label").to_pylist(), batch.column("pick").to_pylist())):
            found = features(data[off[i]:off[i + 1]])
            counts[label, found] += 1
            if pick:
                sampled.append(found.tobytes())
                of.append(label)
        if of:
            yield _gathered("row", [0] * len(of), of, part, sampled)
    for label in (0, 1):
        rows = counts[label].reshape(-1, BLOCK)
        used = np.flatnonzero(rows.any(axis=1))
        if len(used):
            yield _gathered("count", used, [label] * len(used), part, [rows[k].tobytes() for k in used])


def _gathered(kind, blocks, labels, part, data):
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(labels)), pa.array(blocks, pa.int32()), pa.array(labels, pa.int32()),
                                       pa.array([part] * len(labels), pa.int32()), pa.array(data, pa.binary())],
                                      names=["kind", "block", "label", "part", "data"])


def _total(table: pa.Table) -> pa.Table:
    total = np.zeros(BLOCK, np.int64)
    for x in table.column("data"):
        total += np.frombuffer(x.as_buffer(), np.int64)
    first = {c: table.column(c)[:1] for c in ("block", "label", "part")}
    return pa.table(first | {"data": pa.array([total.tobytes()], pa.binary())})


def _totals(counts: DataFrame) -> DataFrame:
    """Sums of (block, label, part, data) over the parts, ``FAN_IN`` at a time."""
    parts = (counts.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        parts = -(-parts // FAN_IN)
        counts = counts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")) \
            .groupBy("block", "label", "part").applyInArrow(_total, "block int, label int, part int, data binary")
        if parts <= 1:
            return counts
        counts = written(counts, "totals")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the labelled rows that are not held out."""
    known = labels.groupBy(F.col("doc_id").cast("bigint").alias("id")) \
        .agg(F.min("quality").alias("label"), F.max("quality").alias("most"), F.count("quality").alias("n"), F.count(F.lit(1)).alias("all")) \
        .where(F.col("id").isNotNull() & (F.col("label") == F.col("most")) & (F.col("n") == F.col("all"))
               & F.col("label").isin(0, 1) & ~held_out(F.col("id"))).select("id", F.col("label").cast("int").alias("label"))
    classes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}    # two rows
    draw = F.pmod(F.xxhash64(F.lit(29), "id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    chance = F.when(F.col("label") == 1, F.lit(sample / max(1, classes.get(1, 0)))).otherwise(F.lit(sample / max(1, classes.get(0, 0))))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text") \
        .join(known.withColumn("pick", draw < chance).hint("merge"), F.col("doc_id") == F.col("id")).select("text", "label", "pick")
    gathered = written(rows.mapInArrow(_gather, _GATHERED), "gathered")
    counts = np.zeros((2, DIM))
    totals = _totals(gathered.where("kind = 'count'").select("block", "label", "part", "data"))
    for r in totals.collect():                           # 2 * DIM / BLOCK rows
        counts[r["label"], r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = np.frombuffer(r["data"], np.int64)
    drawn = gathered.where("kind = 'row'").select("label", "data").collect()        # about 2 * sample rows
    drawn.sort(key=lambda r: (r["label"], bytes(r["data"])))        # the same model whatever the order of tasks
    found = [np.frombuffer(r["data"], np.int32) for r in drawn]
    share = classes.get(1, 0) / sum(classes.values()) if classes else 0.5
    return fit(counts, found, np.array([r["label"] for r in drawn], np.int64), share)


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)         # 4 MB whatever the input

    def run(batches):
        for batch in batches:
            data, off = utf8(batch.column("text"))
            score = [shared.value.score(features(data[off[i]:off[i + 1]])) for i in range(len(off) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64())],
                                             names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("held_out", held_out(F.col("doc_id")))
    scored = rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= F.lit(threshold)).cast("int"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (with a column text) that score ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            data, off = utf8(batch.column("text"))
            good = [shared.value.score(features(data[off[i]:off[i + 1]])) >= threshold for i in range(len(off) - 1)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
