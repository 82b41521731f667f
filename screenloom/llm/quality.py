"""Operator 11: document quality by a regularised quadratic discriminant over statistics of whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, free_name, release, table
from .textbytes import LOWER, ROOTS, buffer_of, mixed, range_hashes, slices, word_hashes, word_ranges

LOWER_CASE, UPPER_CASE, DIGIT, BLANK, LINE, STOP, SYMBOL, LEAD, TRAIL = range(9)
KIND = np.full(256, SYMBOL, np.uint8)
KIND[97:123], KIND[65:91], KIND[48:58] = LOWER_CASE, UPPER_CASE, DIGIT
KIND[[0x20, 0x09]], KIND[0x0A:0x0E] = BLANK, LINE
KIND[[*b".,;:!?"]] = STOP
KIND[0x80:0xC0], KIND[0xC0:] = TRAIL, LEAD
SMALL = 0.01  # what shares are raised by before their logarithm
WIDTH = 22
LEAST_SCORE = 0.3


def per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of the values of each text, whose values begin at `at`."""
    sums = np.zeros(len(values) + 1)
    np.cumsum(values, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def repeats(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of n texts how many different keys it has, and how often it has its most frequent one."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])]))
    most = np.zeros(n)
    np.maximum.at(most, o[first], np.diff(np.concatenate([first, [len(k)]])))
    return np.bincount(o[first], minlength=n).astype(float), most


def statistics(texts: pa.Array) -> np.ndarray:
    """WIDTH transformed statistics of each whole text: logarithms of counts, lengths and shares. Null is the empty text."""
    body, at = buffer_of(texts)
    n = len(at) - 1
    owner = np.repeat(np.arange(n), np.diff(at))
    kind = KIND[body]
    count = np.bincount(owner * 9 + kind, minlength=n * 9).reshape(n, 9).astype(float)
    chars = np.diff(at) - count[:, TRAIL]
    starts, ends, words = word_ranges(body, at)
    total = np.diff(words).astype(float)
    home = np.repeat(np.arange(n), np.diff(words))
    trail = np.concatenate([[0], np.cumsum(kind == TRAIL)])
    symbol = np.concatenate([[0], np.cumsum((kind == SYMBOL) | (kind == DIGIT))])
    length = (ends - starts - (trail[ends] - trail[starts])).astype(float)
    hashes = word_hashes(LOWER[body], starts, ends, ROOTS[0])
    pair = home[1:] == home[:-1]
    distinct, most = repeats(hashes, home, n)
    pairs = mixed(hashes[:-1] * ROOTS[1] + hashes[1:])[pair]
    two, _ = repeats(pairs, home[1:][pair], n)
    again = np.bincount(home[1:][pair & (hashes[1:] == hashes[:-1])], minlength=n)
    signed = np.bincount(home[(symbol[ends] - symbol[starts]) > 0], minlength=n)
    # lines: ranges between line ends, the text's own ends included
    cuts = np.flatnonzero(kind == LINE)
    begins, stops = np.sort(np.concatenate([at[:-1], cuts + 1])), np.sort(np.concatenate([cuts, at[1:]]))
    filled = stops > begins
    begins, stops = begins[filled], stops[filled]
    line_home = np.searchsorted(at, begins, side="right") - 1
    lines = np.bincount(line_home, minlength=n).astype(float)
    letters = mixed(np.arange(1, 257, dtype=np.uint64) * ROOTS[1])
    own_lines, _ = repeats(range_hashes(letters[body], begins, stops, ROOTS[1]), line_home, n)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.log(SMALL + part / np.maximum(whole, 1))

    mean = per_text(length, words) / np.maximum(total, 1)
    spread = np.sqrt(np.maximum(per_text(length * length, words) / np.maximum(total, 1) - mean * mean, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, home, length)
    grams = np.maximum(total - 1, 0)
    found = [
        np.log1p(chars), np.log1p(total), np.log1p(mean), np.log1p(spread), np.log1p(longest), np.log1p(total / np.maximum(lines, 1)), np.log1p(lines),
        share(count[:, LOWER_CASE] + count[:, LEAD], chars), share(count[:, UPPER_CASE], chars), share(count[:, DIGIT], chars), share(count[:, BLANK], chars),
        share(count[:, LINE], chars), share(count[:, STOP], chars), share(count[:, SYMBOL], chars), share(count[:, LEAD], chars),
        share(distinct, total), share(most, total), share(two, grams), share(again, grams), share(signed, total), share(own_lines, lines), share(count[:, STOP], total),
    ]
    return np.stack(found, axis=1)


def measured(docs: DataFrame, name: str = "statistics") -> DataFrame:
    """docs with a column `name`, the statistics of each whole text as array<float>. A column that has the name already is an error."""
    if free_name(docs, name) != name:
        raise ValueError(f"there is a column {name} already")
    arrow_batches(docs.sparkSession)

    @F.arrow_udf("array<float>")
    def measure(texts: pa.Array) -> pa.Array:
        made = [statistics(texts.slice(first, count)) for first, count in slices(texts)]
        rows = np.concatenate(made) if made else np.empty((0, WIDTH))
        release()
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * WIDTH, pa.int32()), pa.array(rows.ravel(), pa.float32()))

    return docs.withColumn(name, measure(F.col("text")))


def vectors(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def shrunk(n: float, mean: np.ndarray, outer: np.ndarray, fourth: float) -> np.ndarray:
    """Covariance of n standardised rows, pulled towards its mean variance by the share that loses least (Ledoit and Wolf).

    outer is the mean outer product about `mean`, fourth the mean fourth power of the rows' distance from it. One row or none has the unit covariance.
    """
    unit = np.eye(len(mean))
    if n < 2:
        return unit
    level = np.trace(outer) / len(mean)
    apart = ((outer - level * unit) ** 2).sum()
    noise = max(fourth - (outer**2).sum(), 0) / n
    share = min(1.0, noise / apart) if apart > 0 else 1.0
    return (1 - share) * outer + share * max(level, 1e-3) * unit + 1e-6 * unit


class Discriminant:
    """Two Gaussians over standardised statistics, each kept as its mean and the Cholesky factor of its covariance."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, counts: list[float], means: list[np.ndarray], covariances: list[np.ndarray]):
        self.centre, self.scale, self.means = centre, scale, means
        self.inverse = [np.linalg.inv(np.linalg.cholesky(c)) for c in covariances]
        # log-density at the mean, and the label's share
        self.level = [float(np.log(np.diag(w)).sum() + np.log(n + 1)) for w, n in zip(self.inverse, counts)]
        self.known = [n > 0 for n in counts]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Posterior of label 1: the logistic function of the difference of the labels' log-densities, each from a Mahalanobis distance."""
        if not all(self.known):
            return np.full(len(rows), 1 / (1 + np.exp(self.level[0] - self.level[1])))
        z = (rows - self.centre) / self.scale
        far = [(((z - m) @ w.T) ** 2).sum(axis=1) for m, w in zip(self.means, self.inverse)]
        odds = self.level[1] - self.level[0] + (far[0] - far[1]) / 2
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def moments(rows: DataFrame, parts, width: int) -> dict[int, np.ndarray]:
    """{label: sums} over all rows (label, statistics): parts(array of rows, label) gives the `width` sums of some rows."""

    def run(batches):
        held = {}
        for batch in batches:
            label, x = np.asarray(batch.column(0)), vectors(batch.column(1))
            for one in np.unique(label).tolist():
                held[one] = held.get(one, 0) + parts(x[label == one], one)
        labels = pa.array(list(held), pa.int32())
        sums = pa.array(np.concatenate([*held.values(), np.empty(0)]), pa.float64())
        yield pa.RecordBatch.from_arrays([labels, pa.ListArray.from_arrays(pa.array(np.arange(len(held) + 1) * width, pa.int32()), sums)], names=["label", "sums"])

    made = rows.select("label", "statistics").mapInArrow(run, "label int, sums array<double>")
    added = made.select("label", F.posexplode("sums").alias("place", "value")).groupBy("label", "place").agg(F.sum("value").alias("value")).collect()  # 2 * width rows
    out = {}
    for r in added:
        out.setdefault(r.label, np.zeros(width))[r.place] = r.value
    return out


def train(rows: DataFrame) -> Discriminant:
    """Fit on all rows (label 0 or 1, statistics): Spark sums each label's moments, the driver gets two labels' sums and no row.

    A label without rows leaves nothing to compare: every score is then the share of label 1 among the rows (one more of each counted).
    """

    def simple(x: np.ndarray, _: int) -> np.ndarray:
        return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])

    first = moments(rows, simple, 1 + 2 * WIDTH)
    none = np.zeros(1 + 2 * WIDTH)
    sums = [first.get(k, none) for k in (0, 1)]
    n = max(1.0, sums[0][0] + sums[1][0])
    centre = (sums[0] + sums[1])[1 : 1 + WIDTH] / n
    scale = np.sqrt(np.maximum((sums[0] + sums[1])[1 + WIDTH :] / n - centre**2, 1e-6))
    means = [(s[1 : 1 + WIDTH] / max(1.0, s[0]) - centre) / scale for s in sums]

    def second(x: np.ndarray, label: int) -> np.ndarray:
        z = (x - centre) / scale - means[label]
        return np.concatenate([[(((z * z).sum(axis=1)) ** 2).sum()], (z.T @ z).ravel()])

    squares = moments(rows, second, 1 + WIDTH * WIDTH) if all(s[0] for s in sums) else {}
    covariances = []
    for k in (0, 1):
        count, own = max(1.0, sums[k][0]), squares.get(k, np.zeros(1 + WIDTH * WIDTH))
        covariances.append(shrunk(sums[k][0], means[k], own[1:].reshape(WIDTH, WIDTH) / count, own[0] / count))
    return Discriminant(centre, scale, [s[0] for s in sums], means, covariances)


def scored(rows: DataFrame, model: Discriminant, statistics: str = "statistics", name: str = "score") -> DataFrame:
    """rows with a column `name`, the posterior of label 1 from the column `statistics`."""
    if free_name(rows, name) != name:
        raise ValueError(f"there is a column {name} already")

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array(model.score(vectors(column)), pa.float64())

    return rows.withColumn(name, score(F.col(statistics)))


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row.

    The statistics of every text are written once (WIDTH floats a row); those of rows that aren't held out and have a label of 0 or 1 train the
    discriminant, all of them. A document with both labels counts for both, a repeated label once. Rows with a null doc_id are
    scored and never trained on; a null or empty text has the statistics of no characters. No rows give no rows.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out())
    known = table(measured(own).select("doc_id", "held_out", "statistics"), "statistics")
    marks = labels.where("quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).distinct()
    model = train(known.where(~F.col("held_out")).join(marks.hint("merge"), "doc_id").select("label", "statistics"))
    return scored(known, model).select("doc_id", "held_out", "score", F.when(F.col("score") >= LEAST_SCORE, 1).otherwise(0).alias("predicted"))
