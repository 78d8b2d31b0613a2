"""Quality classifier: Naive Bayes support vectors.

A text's features are indicators of its byte n-grams (orders 1 to 3, hashed into 2**BITS places). Each is
scaled by the log ratio of its smoothed class frequencies, rows are brought to unit length, and a linear
hinge-loss model is fitted by dual coordinate descent. Margins become scores by a logistic curve fitted on
rows that the model itself hasn't seen.

The model is fitted in one task on a bounded sample of labelled rows, at most `per_class` of each label
(chosen by hash, so reruns agree); scoring reads every whole text and is one pass without a shuffle.

Defined results: a null or empty text has no n-grams and gets the score of a zero margin; a null label is no label;
of several labels of one document the lowest counts; without labels of both kinds every score is the share
of label 1 (0.5 without any); repeated rows are scored one by one; an empty table gives an empty result;
other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.llm.common import table
from claimlens.llm.hashing import slices

BITS = 18
ORDERS = (1, 2, 3)
#: At most so many rows of each label are used to fit; every other row is only scored.
PER_CLASS = 6000
COST = 10.0
EPOCHS = 15
#: Numbers in one piece of memory, which goes back to the system as a whole.
BLOCK = 1 << 23
THRESHOLD = 0.3


class Grams:
    """Distinct hashed n-grams of texts; keeps one table of marks for all of them."""

    def __init__(self, bits: int = BITS, orders: tuple[int, ...] = ORDERS) -> None:
        self.marks, self.bits, self.orders = np.zeros(1 << bits, bool), np.uint64(64 - bits), orders

    def __call__(self, text: str | None, piece: int = 1 << 20) -> np.ndarray:
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        reach = max(self.orders) - 1
        for at in range(0, len(data), piece):  # very long texts go in pieces that overlap
            b = data[at : at + piece + reach].astype(np.uint64)
            code = b
            for n in range(1, max(self.orders) + 1):
                if n > 1:
                    code = code[:-1] << np.uint64(8) | b[n - 1 :]
                if not len(code):
                    break
                if n in self.orders:
                    self.marks[(code + np.uint64(n << 56)) * np.uint64(0x9E3779B97F4A7C15) >> self.bits] = True
        found = np.flatnonzero(self.marks)
        self.marks[found] = False
        return found.astype(np.int32)


def packed(arrays: Iterable[np.ndarray], block: int = BLOCK) -> list[np.ndarray]:
    """The same arrays as views of a few long ones."""
    out: list[np.ndarray] = []
    held: list[np.ndarray] = []

    def close() -> None:
        if held:
            out.extend(np.split(np.concatenate(held), np.cumsum([len(a) for a in held[:-1]])) if len(held) > 1 else held)
            held.clear()

    size = 0
    for a in arrays:
        held.append(a)
        size += len(a)
        if size >= block:
            close()
            size = 0
    close()
    return out


def log_ratios(rows: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """log of (smoothed share of each feature in class 1) / (in class 0)."""
    share = []
    for c in (1, 0):
        count = np.ones(size)
        for r, y in zip(rows, labels, strict=True):
            if y == c:
                count[r] += 1  # a row's features are distinct
        share.append(np.log(count / count.sum()))
    return share[0] - share[1]


def scaled(row: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    v = ratios[row]
    return v / max(float(np.sqrt(v @ v)), 1e-9)


def descend(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, cost: float = COST, epochs: int = EPOCHS, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2/2 + cost * sum of hinge losses, by dual coordinate descent."""
    w, bias, alpha = np.zeros(len(ratios)), 0.0, np.zeros(len(rows))
    sign = np.where(labels == 1, 1.0, -1.0)
    values = packed(scaled(r, ratios) for r in rows)
    square = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            slope = sign[i] * (w[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), cost)
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                worst = max(worst, abs(step))
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
        if worst < 1e-3:
            break
    return w, bias


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of least log loss, by Newton steps on smoothed labels."""
    n1 = float(labels.sum())
    goal = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (len(labels) - n1 + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (p - goal) + 1e-6 * beta
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2), slope)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> dict:
    """The model of rows of features: per feature weight * ratio and ratio squared, the bias, and the logistic curve."""
    if len(set(labels.tolist())) < 2:
        return {"prior": float(labels.mean()) if len(labels) else 0.5}
    # a curve for the margins, from models that haven't seen the rows they are judged on
    folds, margins = np.arange(len(rows)) % 2, np.zeros(len(rows))
    for f in (0, 1):
        seen = np.flatnonzero(folds != f)
        if len(set(labels[seen].tolist())) == 2:
            r = log_ratios([rows[i] for i in seen], labels[seen], 1 << BITS)
            w, bias = descend([rows[i] for i in seen], labels[seen], r)
            for i in np.flatnonzero(folds == f):
                margins[i] = w[rows[i]] @ scaled(rows[i], r) + bias
    ratios = log_ratios(rows, labels, 1 << BITS)
    w, bias = descend(rows, labels, ratios)
    return {"weights": (w * ratios).astype(np.float32), "squares": (ratios * ratios).astype(np.float32), "bias": bias, "curve": logistic(margins, labels)}


def score(model: dict, row: np.ndarray) -> float:
    if "prior" in model:
        return model["prior"]
    length = max(float(np.sqrt(model["squares"][row].sum(dtype=np.float64))), 1e-9)
    margin = float(model["weights"][row].sum(dtype=np.float64)) / length + model["bias"] if len(row) else 0.0
    slope, offset = model["curve"]
    return float(1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30))))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict:
    """A model of labels (doc_id, quality) that aren't held out."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("_y"))
    order = F.xxhash64(F.lit(11), "doc_id")
    some = [known.where(F.col("_y") == c).orderBy(order, "doc_id").limit(per_class) for c in (0, 1)]
    rows = docs.select("doc_id", "text").join(F.broadcast(some[0].unionByName(some[1])), "doc_id")

    def work(batches):
        grams, known = Grams(), []

        def features():
            for batch in slices(batches):
                known.extend(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True))
                yield from map(grams, batch.column(1).to_pylist())

        own = packed(features())
        order = sorted(range(len(own)), key=known.__getitem__)
        model = fit([own[i] for i in order], np.array([known[i][1] for i in order], np.int64))
        slope, offset = model.get("curve", (None, None))
        parts = [model[k].tobytes() if k in model else None for k in ("weights", "squares")]
        cols = [*(pa.array([x], pa.float64()) for x in (model.get("prior"), model.get("bias"), slope, offset)), *(pa.array([x], pa.binary()) for x in parts)]
        yield pa.RecordBatch.from_arrays(cols, names=["prior", "bias", "slope", "offset", "weights", "squares"])

    few = rows.select(F.xxhash64(F.lit(13), "doc_id", F.coalesce("text", F.lit(""))).alias("_h"), "text", "_y").repartition(1)
    got = few.mapInArrow(work, "prior double, bias double, slope double, offset double, weights binary, squares binary").collect()
    if not got or got[0]["prior"] is not None:  # without rows there may be no task
        return {"prior": got[0]["prior"] if got else 0.5}
    r = got[0]
    return {"weights": np.frombuffer(r["weights"], np.float32), "squares": np.frombuffer(r["squares"], np.float32), "bias": r["bias"], "curve": (r["slope"], r["offset"])}


def scored(docs: DataFrame, model: dict, within: str | None = None) -> DataFrame:
    """docs with a column `_score`; the text is a column, or a field of the struct `within`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(within or "text")

    def work(batches):
        grams = Grams()
        for batch in slices(batches):
            own = batch.column(at)
            texts = pc.struct_field(own, "text") if within else own
            s = pa.array([score(shared.value, grams(t)) for t in texts.to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, s], names=[*batch.schema.names, "_score"])

    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())]))


def op1(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
