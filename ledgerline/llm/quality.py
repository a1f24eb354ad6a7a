"""Quality classifier: random Fourier features, ridge, isotonic calibration.

Each whole text becomes a dozen statistics (lengths, repeats, character
kinds). Random Fourier features, cosines of random projections drawn from a
fixed seed, approximate a Gaussian kernel over the standardised statistics.
Ridge regression on them needs only sums over rows, so every task adds up its
normal equations and the sums meet in two rounds. Rows fall in folds; the
equations without a fold score that fold, and these out-of-fold scores give
the isotonic curve (pool adjacent violators over score bins).

Scale: the text is read once; only numbers are shuffled. The fit uses all
labelled rows, its state is ``FEATURES`` squared numbers per fold.

Defined cases: a null or empty text has zeros for statistics and is scored
like any other. A null id is held out and never learned from. A repeated label
counts once (the largest), a repeated row gets a repeated score. Without
labelled rows every score is 0.5, with one kind of label it is that label.
Ties of the isotonic curve are ordered by the raw score, which adds at most
``TIE`` to a score. Columns other than the named ones are ignored.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import annotate, as_bytes, prepare

FEATURES = 160
BANDWIDTH = 2.0
RIDGE = 0.1
FOLDS = 4
BINS = 1000
TIE = 0.01
THRESHOLD = 0.3
SEED = 11

STATS = ["words", "chars_per_word", "upper", "digits", "punctuation", "symbols", "distinct_words", "repeats",
         "distinct_pairs", "top_word", "distinct_lines", "words_per_line", "exclamations", "bars"]

#: Kinds of bytes: upper case, digit, sentence punctuation, other sign, anything else.
_KIND = bytes(85 if 65 <= b <= 90 else 68 if 48 <= b <= 57 else 80 if chr(b) in ".,;:?!'\"()-" else
              83 if 33 <= b <= 126 and not chr(b).isalnum() else 32 for b in range(256))


def statistics(text: str | None) -> tuple[float, ...]:
    """The values of ``STATS`` for one whole text."""
    t = text or ""
    w = t.lower().split()
    n = len(w)
    if not n:
        return (0.0,) * len(STATS)
    kinds = as_bytes(t).translate(_KIND)
    c = len(kinds)
    lines = [x for x in t.split("\n") if x]
    counts = Counter(w)
    pairs = len(set(zip(w, w[1:]))) / (n - 1) if n > 1 else 1.0
    return (float(np.log1p(n)), float(np.log1p(len(t) / n)), kinds.count(b"U") / c, kinds.count(b"D") / c, kinds.count(b"P") / n,
            float(np.log1p(kinds.count(b"S") / n)), len(counts) / n, sum(map(eq, w, w[1:])) / n, pairs, max(counts.values()) / n,
            len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), min(t.count("!") / n, 2.0), min(t.count("|") / n, 1.0))


def _projection():
    rng = np.random.default_rng(SEED)
    return rng.normal(0, 1 / BANDWIDTH, (len(STATS), FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES)


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Features of rows of statistics, with a constant in front."""
    w, b = _projection()
    z = np.clip((x - mean) / scale, -8, 8)
    return np.hstack([np.ones((len(x), 1)), np.sqrt(2 / FEATURES) * np.cos(z @ w + b)])


def _matrix(batch, first: int) -> np.ndarray:
    return np.stack([batch.column(first + i).to_numpy(zero_copy_only=False) for i in range(len(STATS))], axis=1)


def normal_equations(rows: DataFrame, mean, scale) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Per fold the sums of f f' and f y and the row count; ``rows`` has y,
    fold and the statistics. Tasks add up their rows, groups of about the
    square root of the number of tasks add up those, the driver the rest."""
    size = FEATURES + 1
    fan = max(1, int(rows.rdd.getNumPartitions() ** 0.5))

    def add(batches):
        sums: dict[int, list] = {}
        for b in batches:
            y, fold = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            f = fourier(_matrix(b, 2), mean, scale)
            for k in np.unique(fold):
                m = fold == k
                s = sums.setdefault(int(k), [np.zeros((size, size)), np.zeros(size), 0])
                s[0] += f[m].T @ f[m]
                s[1] += f[m].T @ y[m]
                s[2] += int(m.sum())
        part = TaskContext.get().partitionId() % fan
        for k, (a, c, n) in sums.items():
            yield pa.RecordBatch.from_pydict({"fold": pa.array([k], pa.int32()), "part": pa.array([part], pa.int32()),
                                              "n": pa.array([n], pa.int64()), "a": pa.array([a.tobytes()], pa.binary()),
                                              "c": pa.array([c.tobytes()], pa.binary())})

    def meet(pdf):
        return pd.DataFrame({"fold": pdf.fold[:1], "n": [pdf.n.sum()], "a": [sum(np.frombuffer(x) for x in pdf.a).tobytes()],
                             "c": [sum(np.frombuffer(x) for x in pdf.c).tobytes()]})

    kinds = "n long, a binary, c binary"
    parts = rows.mapInArrow(add, f"fold int, part int, {kinds}")
    met = parts.groupBy("fold", "part").applyInPandas(meet, f"fold int, {kinds}")
    out = [(np.zeros((size, size)), np.zeros(size), 0) for _ in range(FOLDS)]
    for r in met.toLocalIterator():
        a, c, n = out[r.fold]
        out[r.fold] = (a + np.frombuffer(bytes(r.a)).reshape(size, size), c + np.frombuffer(bytes(r.c)), n + r.n)
    return out


def solve(equations, ridge: float = RIDGE) -> np.ndarray:
    a, c = sum(e[0] for e in equations), sum(e[1] for e in equations)
    pen = np.eye(len(c)) * ridge
    pen[0, 0] = 1e-9
    return np.linalg.solve(a + pen, c)


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising values for ascending ``x``, where ``y``
    are sums of labels and ``n`` counts. Gives block ends and values."""
    blocks: list[list] = []  # first x, last x, sum, count
    for a, s, k in zip(x, y, n):
        blocks.append([a, a, s, k])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, last, s2, k2 = blocks.pop()
            blocks[-1][1:] = [last, blocks[-1][2] + s2, blocks[-1][3] + k2]
    at = [v for b in blocks for v in (b[0], b[1])]
    value = [b[2] / b[3] for b in blocks for _ in (0, 1)]
    return np.array(at, float), np.array(value, float)


def measure(docs: DataFrame, *, text_col: str = "text", keep: list[str]) -> DataFrame:
    """The columns in ``keep`` and the statistics of each row's whole text."""
    ddl = ", ".join(f"s_{s} double" for s in STATS)
    return annotate(docs, text_col, ddl, lambda: lambda texts: [statistics(t) for t in texts], keep)


def fit(measured: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality") -> dict:
    """Model from ``measured`` rows whose id has a label."""
    given = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col)
             .agg(F.max(F.col(label_col).cast("double")).alias("__y")))
    stats = [f"s_{s}" for s in STATS]
    rows = measured.join(given, id_col).select(
        "__y", F.pmod(F.xxhash64(F.col(id_col), F.lit(SEED)), F.lit(FOLDS)).cast("int").alias("__fold"), *stats).checkpoint()
    got = rows.agg(F.count("*"), F.avg("__y"), *[F.avg(s) for s in stats], *[F.stddev_pop(s) for s in stats]).first()
    count, share = got[0], got[1]
    if not count or share in (0.0, 1.0):
        return {"constant": 0.5 if not count else share}
    mean, scale = np.array(got[2:2 + len(stats)]), np.maximum(np.array(got[2 + len(stats):]), 1e-3)
    equations = normal_equations(rows, mean, scale)
    without = np.stack([solve(equations[:k] + equations[k + 1:]) for k in range(FOLDS)])

    def out_of_fold(batches):
        for b in batches:
            y, fold = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            raw = (fourier(_matrix(b, 2), mean, scale) * without[fold.astype(int)]).sum(axis=1)
            spot = np.clip(np.rint((raw + 0.5) * BINS / 2), 0, BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(spot), pa.array(y)], names=["bin", "y"])

    bins = (rows.mapInArrow(out_of_fold, "bin int, y double").groupBy("bin").agg(F.sum("y").alias("y"), F.count("*").alias("n"))
            .orderBy("bin").collect())  # at most BINS + 1 rows
    x, v = isotonic(np.array([b.bin * 2 / BINS - 0.5 for b in bins]), np.array([b.y for b in bins]), np.array([b.n for b in bins]))
    return {"mean": mean, "scale": scale, "weights": solve(equations), "x": x, "v": v}


def score(measured: DataFrame, model: dict, *, keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """The columns in ``keep`` with score, predicted and raw."""
    rows = measured.select(*keep, *[f"s_{s}" for s in STATS])
    first = len(keep)

    def run(batches):
        for b in batches:
            if "constant" in model:
                raw = np.full(b.num_rows, model["constant"])
                p = raw
            else:
                raw = fourier(_matrix(b, first), model["mean"], model["scale"]) @ model["weights"]
                p = (1 - TIE) * np.interp(raw, model["x"], model["v"]) + TIE * np.clip((raw + 0.5) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays([*b.columns[:first], pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array(raw)],
                                             names=[*keep, "score", "predicted", "raw"])

    kept = ", ".join(f"`{c}` {t}" for c, t in rows.select(*keep).dtypes)
    return rows.mapInArrow(run, f"{kept}, score double, predicted int, raw double")


def classify(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             held_out: str | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Measure, fit and score: id, (held_out,) score, predicted, raw for each
    row. ``labels`` are those to learn from."""
    prepare(docs.sparkSession)
    keep = [id_col] + ([held_out] if held_out else [])
    measured = measure(docs.select(*keep, text_col), text_col=text_col, keep=keep).checkpoint()
    return score(measured, fit(measured, labels, id_col=id_col, label_col=label_col), keep=keep, threshold=threshold)
