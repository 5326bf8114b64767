"""Quality classifier: random-indexing word vectors and a two-layer network.

A word's index vector is a few signed units at places its hash names; its
context vector is the sum of the index vectors of its neighbours over the whole
corpus. Words share a fixed number of rows by hash, so the vectors have a fixed
size whatever the corpus. A document is pooled from the context vectors of its
words; a two-layer network scores it, and a temperature fitted on rows it has
not seen calibrates the probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import LOWER, SPACE, groups, mix, range_hashes
from tidemark.llm.common import arrow_map, packed, ship
from tidemark.session import materialize

ROWS, DIM, UNITS, WINDOW = 4096, 32, 2, 2
HIDDEN, STEPS, RATE, DECAY = 32, 600, 0.01, 1e-4
# Bound on the labelled rows a model is fitted on, and the share that calibrates.
SAMPLE, HOLD = 20_000, 0.2
THRESHOLD = 0.7
SEED = 17
# Classes of bytes: runs of letters, digits and marks are tokens of their own.
KIND = np.full(256, 3, dtype=np.uint8)
KIND[SPACE] = 0
KIND[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = 1
KIND[[*range(ord("0"), ord("9") + 1)]] = 2


def tokens(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, shape, offsets) of the tokens of all texts.

    A token is a run of letters, of digits or of marks. Its hash is that of the
    lower-cased bytes; its shape tells capital, mixed and small letters apart
    and how it touches its neighbour.
    """
    given = np.frombuffer(b" ".join(raws) + b" ", dtype=np.uint8)
    low = LOWER[given]
    kind = KIND[low]
    n = len(low)
    edge = np.ones(n, dtype=bool)
    edge[1:] = kind[1:] != kind[:-1]
    first = np.flatnonzero(edge & (kind > 0))
    stop = np.flatnonzero(edge)
    last = np.append(stop, n)[np.searchsorted(stop, first) + 1]
    hashes = range_hashes(low, first, last)
    capital = np.concatenate(([0], np.cumsum(given != low)))
    capitals = capital[last] - capital[first]
    shape = np.where(capitals == 0, 0, np.where((capitals == last - first) & (last - first > 1), 2, 1))
    shape = shape + 3 * (kind[first] - 1)
    ends = np.cumsum([len(r) + 1 for r in raws])
    return hashes, shape, np.concatenate(([0], np.searchsorted(first, ends)))


def word_rows(hashes: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Row of each token in the table of vectors."""
    return (mix(hashes + shape.astype(np.uint64), 3) % np.uint64(ROWS)).astype(np.int64)


def _index(rows: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Places and signs of the units of each row's index vector."""
    places, signs = [], []
    for unit in range(UNITS):
        h = mix(rows.astype(np.uint64), 101 + unit)
        places.append((h % np.uint64(DIM)).astype(np.int64))
        signs.append(np.where((h >> np.uint64(32)) & np.uint64(1), 1.0, -1.0))
    return places, signs


def context_sums(texts: list[str]) -> np.ndarray:
    """Sum of the neighbours' index vectors, by row of the word."""
    out = np.zeros(ROWS * (DIM + 1))
    places, signs = _index(np.arange(ROWS))
    for raws in groups(texts):
        hashes, shape, offsets = tokens(raws)
        if not len(hashes):
            continue
        rows = word_rows(hashes, shape)
        text = np.repeat(np.arange(len(raws)), np.diff(offsets))
        out += np.bincount(rows * (DIM + 1) + DIM, minlength=len(out))
        for gap in range(1, WINDOW + 1):
            if len(rows) <= gap:
                break
            near = text[gap:] == text[:-gap]
            left, right = rows[:-gap][near], rows[gap:][near]
            for word, other in ((left, right), (right, left)):
                for place, sign in zip(places, signs):
                    cell = word * (DIM + 1) + place[other]
                    out += np.bincount(cell, weights=sign[other], minlength=len(out))
    return out.reshape(ROWS, DIM + 1)


def word_vectors(df: DataFrame, text: str = "text") -> np.ndarray:
    """Context vectors over all rows, of unit length, ROWS by DIM.

    Tasks send their sums as blocks of rows and these are added by block while
    they stream in, so the driver gets ROWS * (DIM + 1) numbers.
    """
    block = 256

    def count(batches):
        total = np.zeros((ROWS, DIM + 1))
        for batch in batches:
            total += context_sums(batch.column(0).to_pylist())
        yield from sent({i: total[i : i + block] for i in range(0, ROWS, block) if total[i : i + block].any()})

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(raw, dtype="<f8").reshape(-1, DIM + 1)
                totals[at] = totals[at] + part if at in totals else part
        yield from sent(totals)

    def sent(parts):
        if parts:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(parts), pa.int32()),
                    pa.array([p.astype("<f8").tobytes() for p in parts.values()], pa.binary()),
                ],
                names=["block", "sums"],
            )

    parts = arrow_map(df.select(F.col(text).cast("string")), count, "block int, sums binary")
    total = np.zeros((ROWS, DIM + 1))
    for row in arrow_map(parts.repartition("block"), add, "block int, sums binary").collect():
        part = np.frombuffer(row["sums"], dtype="<f8").reshape(-1, DIM + 1)
        total[row["block"] : row["block"] + block] += part
    # All sums are whole numbers: their order does not matter, reruns agree.
    vectors = total[:, :DIM]
    norm = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    return (vectors / np.where(norm > 0, norm, 1)).astype(np.float32)


def features(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """Per text: mean and spread of its word vectors, shares of token shapes, length."""
    out = []
    for raws in groups(texts):
        hashes, shape, offsets = tokens(raws)
        rows = word_rows(hashes, shape)
        sizes = np.diff(offsets)
        text = np.repeat(np.arange(len(raws)), sizes)
        n = np.maximum(sizes, 1)[:, None]
        # Counts of rows per text, then one product with the vectors.
        pairs, times = np.unique(text * ROWS + rows, return_counts=True)
        owner, row = pairs // ROWS, pairs % ROWS
        pooled = np.zeros((len(raws), 2 * DIM))
        weighted = vectors[row] * times[:, None]
        squares = vectors[row] ** 2 * times[:, None]
        starts = np.searchsorted(owner, np.arange(len(raws)))
        has = sizes > 0
        if has.any():
            pooled[has, :DIM] = np.add.reduceat(weighted, starts[has], axis=0)
            pooled[has, DIM:] = np.add.reduceat(squares, starts[has], axis=0)
        pooled /= n
        pooled[:, DIM:] = np.sqrt(np.maximum(pooled[:, DIM:] - pooled[:, :DIM] ** 2, 0))
        shapes = np.zeros((len(raws), 9))
        np.add.at(shapes, (text, shape), 1.0)
        variety = np.bincount(owner, minlength=len(raws))[:, None] / n
        out.append(np.hstack([pooled, shapes / n, variety, np.log1p(sizes)[:, None]]))
    return np.vstack(out) if out else np.zeros((0, 2 * DIM + 11))


@dataclass
class Network:
    """Two layers on standardised features, and the temperature of the output."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z)) if len(y) else 0.0


def fit(x: np.ndarray, y: np.ndarray, calibrate: np.ndarray) -> Network:
    """Full-batch Adam on the rows that do not calibrate; then the temperature.

    With one label only, the score is its smoothed share, whatever the text.
    """
    width = x.shape[1]
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Network(
            np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1),
            float(np.log(share / (1 - share))),
        )
    train = ~calibrate if 0 < y[~calibrate].sum() < (~calibrate).sum() else np.ones(len(y), bool)
    xt, yt = x[train], y[train]
    mean, scale = xt.mean(axis=0), xt.std(axis=0)
    scale[scale < 1e-9] = 1.0
    rng = np.random.default_rng(SEED)
    params = [
        rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1),
    ]
    moment = [np.zeros_like(p) for p in params]
    square = [np.zeros_like(p) for p in params]
    z = (xt - mean) / scale
    # Both labels weigh the same in sum, up to a factor of four.
    poor = np.clip(yt.mean() / max(1 - yt.mean(), 1e-9), 0.25, 4.0)
    weight = np.where(yt == 1, 1.0, poor)
    weight /= weight.sum()
    for step in range(1, STEPS + 1):
        w1, b1, w2, b2 = params
        hidden = np.tanh(z @ w1 + b1)
        p = 1 / (1 + np.exp(-np.clip(hidden @ w2 + b2[0], -500, 500)))
        delta = (p - yt) * weight
        back = np.outer(delta, w2) * (1 - hidden**2)
        grads = [z.T @ back + DECAY * w1, back.sum(axis=0), hidden.T @ delta + DECAY * w2, np.array([delta.sum()])]
        for i, g in enumerate(grads):
            moment[i] = 0.9 * moment[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            up = moment[i] / (1 - 0.9**step)
            params[i] = params[i] - RATE * up / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]))
    held = calibrate if calibrate.any() else np.ones(len(y), bool)
    raw = net.logits(x[held])
    choices = np.exp(np.linspace(np.log(0.25), np.log(8.0), 61))
    net.temperature = float(min(choices, key=lambda t: _loss(raw / t, y[held])))
    return net


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2


def train(
    df: DataFrame, labels: DataFrame, vectors: np.ndarray, key: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> Network:
    """A network fitted on at most about `sample` labelled rows that are not held out.

    The keys are drawn by a hash, so reruns agree; of several rows with one key
    the one with the least features counts. So at most `sample` rows of features
    reach the driver.
    """
    known = (
        labels.filter(F.col("quality").isNotNull() & F.col(key).isNotNull() & ~held_out(key))
        .groupBy(F.col(key).alias("_id"))
        .agg(F.max("quality").cast("int").alias("_label"))
    )
    spot = F.pmod(F.xxhash64("_id", F.lit(SEED)), F.lit(1_000_000))
    known = materialize(known.withColumn("_spot", spot), "labels")
    share = min(1.0, sample / max(known.count(), 1))
    while (chosen := known.filter(F.col("_spot") < int(share * 1_000_000))).count() > sample:
        share *= 0.95
    docs = df.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text"))
    # At most `sample` keys are sent around, so the texts stay where they are.
    rows = docs.join(F.broadcast(chosen), "_id").select("_id", "_text", "_label", "_spot")

    def work(batches):
        for batch in batches:
            x = features(batch.column(1).to_pylist(), vectors)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.string()),
                    batch.column(2),
                    batch.column(3).cast(pa.int64()),
                    pa.array([v.astype("<f4").tobytes() for v in x], pa.binary()),
                ],
                names=["id", "label", "spot", "x"],
            )

    found = arrow_map(rows, work, "id string, label int, spot bigint, x binary")
    one = found.groupBy("id").agg(F.min(F.struct("spot", "label", "x")).alias("_m")).select("id", "_m.*")
    got = one.toPandas().sort_values(["spot", "id"])
    width = 2 * DIM + 11
    x = np.frombuffer(b"".join(got["x"]), dtype="<f4").reshape(-1, width).astype(np.float64)
    y = got["label"].to_numpy(dtype=np.float64)
    calibrate = (mix(got["spot"].to_numpy(dtype=np.uint64), 5) % np.uint64(1000)) < np.uint64(1000 * HOLD)
    return fit(x, y, calibrate)


def scored(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per input row: key, held_out, score, predicted.

    Word vectors come from the texts of all rows; labels only from rows that are
    not held out, at most `sample` of them, and of several labels of one key the
    best. Scores depend on the text alone: null is the empty text, which has a
    score like any other, and repeated texts have equal scores. Without labels
    every score is 0.5. A null key is not held out. Other columns are ignored;
    an empty table gives no rows. `carry` names columns returned as `_doc`.
    """
    vectors = word_vectors(df, text)
    net = train(df, labels, vectors, key, text, sample)
    ship(df.sparkSession)

    def score(texts: pa.Array) -> pa.Array:
        return pa.array(net.scores(features(texts.to_pylist(), vectors)), pa.float64())

    # Called once a row: a filter on the score must not be moved below it. Only
    # the text goes to Python, the other columns wait in the executor.
    once = F.arrow_udf(score, "double").asNondeterministic()
    rows = df.select(
        F.col(key).alias("_key"),
        F.coalesce(held_out(key), F.lit(False)).alias("_held"),
        once(F.col(text).cast("string")).alias("_score"),
        *([packed(df, carry).alias("_doc")] if carry is not None else []),
    )
    return rows.select(
        F.col("_key").alias(key),
        F.col("_held").alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"),
        *(["_doc"] if carry is not None else []),
    )


def good(df: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows predicted to be of quality, with the columns of the input."""
    return scored(df, labels, carry=df.columns, **options).filter("predicted = 1").select("_doc.*")
