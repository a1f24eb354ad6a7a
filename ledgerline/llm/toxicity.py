"""Toxicity: a weighted lexicon matched by Aho-Corasick after folding.

Folding: Unicode lower case and compatibility forms, look-alike letters of
other scripts to Latin ones, digits and signs that stand for letters inside a
word (``1d10t``) to those letters, everything but letters to blanks.

The lexicon is a set of word beginnings with weights, learned from labelled
rows: beginnings frequent in toxic documents, weighted by the log odds of
their document frequencies. Exception phrases are words (or given phrases)
that contain a lexicon entry but stand in clean documents; a match inside one
does not count. All entries and exceptions form one automaton that scans each
whole text once. Match weights are normalised by the text's length and turned
into a probability by a logistic curve fitted on the labelled rows.

Labelled rows: at most about ``FIT_ROWS`` of those offered, chosen by a hash of
the id (documented bound of the fit). The lexicon's candidates occur in at
least ``MIN_SHARE`` of the toxic ones, so their number is bounded. Everything
else covers all rows, with no shuffle of texts.

Defined cases: null and empty texts have no matches and get the curve's lowest
score. A null id is held out. A repeated label counts once (toxic wins), a
repeated document row is scored like the first. Without labelled rows of both
kinds the lexicon is empty and every score is 0. Columns of the input that are
named like a result column give way; other columns are carried.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import annotate, prepare

FIT_ROWS = 20_000
MIN_SHARE = 0.01
MIN_DOCS = 3
PREFIX = (4, 12)
MIN_LOG_ODDS = 1.5
THRESHOLD = 0.7

# Letters of other scripts that look like Latin ones, and signs used for letters.
LOOKALIKES = dict(zip("асԁеһіјӏорԛѕԝхуαεικνορτυχ", "acdehijlopqswxyaeikvoptux"))
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}

_ODD = re.compile(r"[ -¿̀-ԯ -⿿　＀-￯]")
_SIGN = re.compile(r"(?<=[^\W\d_])[013457@$8]+(?=[^\W\d_])|(?<!\w)[013457@$8](?=[^\W\d_])")
_HAS_SIGN = re.compile(r"[013457@$8]")
_LOOK = str.maketrans(LOOKALIKES)
_SIGNS = str.maketrans(SIGNS)
#: After UTF-8: ASCII letters in lower case and non-ASCII bytes stay, the rest become blanks.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def fold(text: str | None) -> str:
    """Folded words between single or more blanks, as UTF-8 bytes in a str
    (one character a byte), with a blank at both ends."""
    t = (text or "").lower()
    if _ODD.search(t):
        t = unicodedata.normalize("NFKC", t).lower().translate(_LOOK)
        t = "".join(c if c.isalnum() or c in "@$" else " " for c in t if unicodedata.category(c) not in ("Cf", "Mn"))
    if _HAS_SIGN.search(t):
        t = _SIGN.sub(lambda m: m[0].translate(_SIGNS), t)
    return " " + t.encode("utf-8", "replace").translate(_LETTERS).decode("latin-1") + " "


def beginnings(words) -> set[str]:
    """All beginnings of the words within the lengths of ``PREFIX``, and the
    whole words of at least three letters with a blank after them."""
    lo, hi = PREFIX
    return {w[:k] for w in words for k in range(lo, min(hi, len(w)) + 1)} | {w + " " for w in words if len(w) >= lo - 1}


def choose(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Lexicon from candidates' document counts (toxic, clean): of a chain of
    ever longer beginnings with nearly the same toxic count the longest, and
    none that a shorter entry of about the same odds covers."""
    weight = {p: float(np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (clean + 1))) for p, (a, b) in counts.items()}
    longer = Counter()
    for p in counts:
        if p[-1] != " ":  # a whole word does not replace the beginning that also covers its other forms
            longer[p[:-1]] = max(longer[p[:-1]], counts[p][0])
    kept: dict[str, float] = {}
    for p in sorted(counts, key=lambda p: (len(p), p)):
        if weight[p] < MIN_LOG_ODDS or longer[p] >= 0.95 * counts[p][0]:
            continue
        above = [kept[p[:k]] for k in range(1, len(p)) if p[:k] in kept]
        if above and max(above) >= weight[p] - 1.0:
            continue
        kept[p] = weight[p]
    return kept


class Matcher:
    """One automaton of lexicon entries (" beginning" or " word ") and exceptions
    (" phrase ")."""

    def __init__(self, lexicon: dict[str, float], exceptions: list[str]):
        self.auto = ahocorasick.Automaton()
        for p, w in lexicon.items():
            self.auto.add_word(" " + p, (len(p) + 1, w, p))
        for e in exceptions:
            self.auto.add_word(f" {e} ", (len(e) + 2, None, e))
        if len(self.auto):
            self.auto.make_automaton()

    def features(self, text: str | None) -> tuple[int, int, int, float]:
        """(words, matches, distinct entries, weight) of a whole text."""
        words = fold(text).split()
        n, s = len(words), f" {' '.join(words)} "
        if not n or not len(self.auto):
            return n, 0, 0, 0.0
        hits, shields = [], []
        for end, (size, w, p) in self.auto.iter(s):
            (shields if w is None else hits).append((end - size + 1, end, w, p))
        if shields:
            shields.sort()
            at, reach = [x[0] for x in shields], list(np.maximum.accumulate([x[1] for x in shields]))
            place = np.searchsorted(at, [h[0] for h in hits], side="right") - 1
            hits = [h for h, i in zip(hits, place) if i < 0 or reach[i] < h[1]]
        return n, len(hits), len({h[3] for h in hits}), float(sum(h[2] for h in hits))


def curve_inputs(n, k, d, w):
    """Length-normalised inputs of the logistic curve."""
    n, k, d, w = (np.asarray(x, float) for x in (n, k, d, w))
    return np.stack([np.ones_like(n), np.log1p(100 * w / np.maximum(n, 1)), np.log1p(w), np.log1p(k), np.log1p(d)], axis=1)


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    b = np.zeros(x.shape[1])
    pen = np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pen + 1e-9 * np.eye(len(b)), x.T @ (y - p) - pen @ b)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return b


def _counts(rows: DataFrame, candidates: set[str] | None) -> DataFrame:
    """(term, toxic, n): document frequencies, summed in each task first."""
    def run(batches):
        sums = (Counter(), Counter())
        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                terms = beginnings(set(fold(text).split()))
                sums[toxic].update(terms if candidates is None else terms & candidates)
        for y in (0, 1):
            items = list(sums[y].items())
            for at in range(0, len(items), 10_000):
                part = items[at:at + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in part], pa.string()), pa.array([y] * len(part), pa.int32()),
                                                  pa.array([c for _, c in part], pa.int64())], names=["term", "toxic", "n"])
    import pyarrow as pa

    return rows.select("text", "toxic").mapInArrow(run, "term string, toxic int, n long").groupBy("term").pivot("toxic", [0, 1]).sum("n")


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        fit_rows: int = FIT_ROWS, exceptions: tuple[str, ...] = ()) -> dict:
    """Lexicon, exceptions and curve from labelled rows (all of ``labels``)."""
    prepare(docs.sparkSession)
    given = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id"))
             .agg(F.max(F.col(label_col).cast("int")).alias("toxic")))
    offered = given.count()
    if offered > fit_rows:
        given = given.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 20)) < int((1 << 20) * fit_rows / offered))
    rows = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
            .join(F.broadcast(given), "__id").select("text", "toxic").checkpoint())  # bounded by fit_rows
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    model = {"lexicon": {}, "exceptions": [fold(e).strip() for e in exceptions], "curve": None}
    if not clean or not toxic:
        return model
    least = max(MIN_DOCS, MIN_SHARE * toxic)
    candidates = {r.term for r in _counts(rows.where("toxic = 1"), None).where(F.col("1") >= least).select("term").collect()}
    counts = {r.term: (r["1"] or 0, r["0"] or 0) for r in _counts(rows, candidates).collect()}
    model["lexicon"] = choose(counts, toxic, clean)
    model["exceptions"] += _exceptions(rows, model["lexicon"], toxic, clean)

    def make():
        return lambda texts: [matcher_of(model).features(t) for t in texts]

    got = annotate(rows, "text", "n long, k long, d long, w double", make, keep=["toxic"]).toPandas()
    model["curve"] = fit_curve(curve_inputs(got.n, got.k, got.d, got.w), got.toxic.to_numpy(float)).tolist()
    return model


def _exceptions(rows: DataFrame, lexicon: dict[str, float], toxic: int, clean: int) -> list[str]:
    """Whole words that begin with an entry but stand rather in clean documents."""
    lo, hi = min(map(len, lexicon), default=1), max(map(len, lexicon), default=0)

    def make():
        def fn(texts):
            return [([w for w in set(fold(t).split()) if any(f"{w} "[:k] in lexicon for k in range(lo, min(hi, len(w) + 1) + 1))],) for t in texts]
        return fn

    words = annotate(rows, "text", "words array<string>", make, keep=["toxic"])
    per = (words.select("toxic", F.explode("words").alias("w")).groupBy("w")
           .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")))
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (clean + 1))
    return sorted(r.w for r in per.where((F.col("b") >= MIN_DOCS) & (odds < 0)).select("w").collect())


_matchers: dict[str, Matcher] = {}


def matcher_of(model: dict) -> Matcher:
    """The model's automaton, built once per worker."""
    key = json.dumps([sorted(model["lexicon"].items()), model["exceptions"]])
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(model["lexicon"], model["exceptions"])
    return _matchers[key]


RESULT = "tox_words long, tox_matches long, tox_weight double, score double, predicted int"


def score(docs: DataFrame, model: dict, *, text_col: str = "text", threshold: float = THRESHOLD,
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the columns of ``RESULT``."""
    prepare(docs.sparkSession)

    def make():
        matcher = matcher_of(model)
        curve = None if model["curve"] is None else np.array(model["curve"])

        def fn(texts):
            rows = [matcher.features(t) for t in texts]
            if curve is None or not rows:
                p = np.zeros(len(rows))
            else:
                p = 1 / (1 + np.exp(-np.clip(curve_inputs(*zip(*rows)) @ curve, -30, 30)))
            return [(n, k, w, float(x), int(x >= threshold)) for (n, k, _, w), x in zip(rows, p)]

        return fn

    return annotate(docs, text_col, RESULT, make, keep)
