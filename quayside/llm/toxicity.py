"""A toxicity classifier that is held still under swaps of identity terms.

Features are the distinct lower-cased words of a text and the beginnings of its words, so that inflected and
compounded forms share evidence. Those associated with the label are kept; a logistic regression over
them is fitted with a penalty on the change of the score when identity terms in a labelled sentence are
swapped for others, which takes weight away from mere mentions of a group.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ROW, checkpointed, give_back, in_fold, packed

FOLDS = 5
HELD_OUT = 0
# Bounds of the fit: labelled rows (chosen by a hash of their id) and features of the model.
MAX_ROWS = 40_000
MAX_FEATURES = 20_000
MIN_ROWS = 3
# Least association (G-squared) of a feature with the label.
MIN_ASSOCIATION = 15.0
PREFIXES = (4, 5, 6)
L2 = 0.5
SWAP_PENALTY = 1.0
THRESHOLD = 0.5

# Identity terms, by language and form, that are swapped within their row.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "bisexual", "straight", "transgender"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("young", "old", "elderly", "disabled", "blind", "deaf"),
    ("femmes", "hommes", "filles", "garçons"),
    ("chrétiens", "musulmans", "juifs", "bouddhistes", "athées"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("christen", "muslime", "juden", "buddhisten", "atheisten"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("cristianos", "musulmanes", "judíos", "budistas", "ateos"),
)
_WORDS = re.compile(rb"[a-z0-9\x80-\xff]+")
_CACHE = 100_000


def _swaps() -> dict[bytes, tuple[bytes, ...]]:
    out = {}
    for row in IDENTITY_TERMS:
        terms = [t.encode() for t in row]
        for t in terms:
            out[t] = tuple(o for o in terms if o != t)
    return out


def features_of(word: bytes) -> list[bytes]:
    """A word's own feature and those of its beginnings; beginnings are marked by a trailing dash."""
    text = word.decode("utf-8", "ignore")
    return [word, *((text[:n] + "-").encode() for n in PREFIXES if len(text) >= n)]


def words_of(text: str | None) -> set[bytes]:
    return set(_WORDS.findall((text or "").encode().lower()))


def _features(words: set[bytes]) -> set[bytes]:
    return {f for w in words for f in features_of(w)}


@dataclass(frozen=True)
class ToxicityModel:
    """Weights by feature and the intercept."""

    weights: dict[bytes, float]
    bias: float

    def scorer(self):
        """Function of one text; words are looked up once and remembered, within bounds."""
        weights, bias, known = self.weights, self.bias, {}

        def score(text: str | None) -> float:
            nonlocal known
            if len(known) > _CACHE:
                known = {}
            hits: set[bytes] = set()
            for word in words_of(text):
                found = known.get(word)
                if found is None:
                    found = known[word] = tuple(f for f in features_of(word) if f in weights)
                if found:
                    hits.update(found)
            total = bias + sum(weights[f] for f in sorted(hits))
            return float(1.0 / (1.0 + np.exp(-total)))

        return score


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with each feature among the positive and the negative texts of a task; emptied when it grows."""
    sides = Counter(), Counter()

    def out():
        names = list(sides[0].keys() | sides[1].keys())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.binary()),
                pa.array([sides[1][f] for f in names], pa.int64()),
                pa.array([sides[0][f] for f in names], pa.int64()),
            ],
            names=["feature", "pos", "neg"],
        )

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sides[label].update(_features(words_of(text)))
            if len(sides[0]) + len(sides[1]) > 2_000_000:
                yield out()
                sides[0].clear()
                sides[1].clear()
    yield out()


def _association(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """G-squared of the two by two table of having a feature and the label."""
    table = np.array([[pos, neg], [n_pos - pos, n_neg - neg]], dtype=float)
    total = n_pos + n_neg
    expected = table.sum(axis=0, keepdims=True) * table.sum(axis=1, keepdims=True) / total
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * np.where(table > 0, table * np.log(table / expected), 0.0).sum(axis=(0, 1))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = FOLDS,
    held_out: int = HELD_OUT,
    max_rows: int = MAX_ROWS,
    max_features: int = MAX_FEATURES,
    swap_penalty: float = SWAP_PENALTY,
) -> ToxicityModel:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold, chosen by a hash of their id.

    What reaches the driver is bounded: the kept features, and of each row of the sample which of those it
    has. Rows with a null label or id do not count; conflicting repeats of a label give 1. Without
    a positive and a negative example the model is a constant.
    """
    spark = docs.sparkSession
    known = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .filter(~in_fold(F.col(id_col).cast("long"), folds, held_out))
        .groupBy(F.col(id_col).cast("long").alias("_qs_id"))
        .agg(F.max(label_col).cast("int").alias("_qs_label"))
        .orderBy(F.xxhash64("_qs_id"), "_qs_id")
        .limit(max_rows)
    )
    sample = checkpointed(
        docs.select(docs[id_col].cast("long").alias("_qs_doc"), docs[text_col].cast("string").alias("text"))
        .join(F.broadcast(known), F.col("_qs_doc") == F.col("_qs_id"))
        .select("text", F.col("_qs_label").alias("label"))
    )
    sides = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n_pos, n_neg = sides.get(1, 0), sides.get(0, 0)
    if not n_pos or not n_neg:
        return ToxicityModel({}, 0.0 if not sides else (4.0 if n_pos else -4.0))
    counts = (
        sample.mapInArrow(_counted, "feature binary, pos long, neg long")
        .groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .filter(F.col("pos") + F.col("neg") >= MIN_ROWS)
    )

    @F.pandas_udf("double")
    def association(pos: pd.Series, neg: pd.Series) -> pd.Series:
        return pd.Series(_association(pos.to_numpy(), neg.to_numpy(), n_pos, n_neg))

    chosen = (
        counts.withColumn("g", association("pos", "neg")).filter(F.col("g") >= MIN_ASSOCIATION)
        .orderBy(F.desc("g"), "feature").limit(max_features).select("feature").collect()
    )
    names = sorted(bytes(r["feature"]) for r in chosen)
    place = {f: i for i, f in enumerate(names)}
    swaps = _swaps()

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each text the kept features it has; of each swap in it, those before and after."""
        for batch in batches:
            on, after, ys = [], [], []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                own = sorted(place[f] for f in _features(words) if f in place)
                on.append(own)
                after.append(None)
                ys.append(label)
                for term in sorted(words & swaps.keys()):
                    for other in swaps[term]:
                        changed = _features((words - {term}) | {other})
                        on.append(own)
                        after.append(sorted(place[f] for f in changed if f in place))
                        ys.append(label)
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(on, ints), pa.array(after, ints), pa.array(ys, pa.int32())],
                names=["on", "after", "label"],
            )

    rows = sample.mapInArrow(reduced, "on array<int>, after array<int>, label int")
    seen = rows.groupBy("on", "after", "label").count().orderBy("label", "on", "after").collect()
    return _solve(names, seen, swap_penalty)


def _matrix(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ones of a sparse matrix."""
    sizes = [len(r) for r in rows]
    columns = np.fromiter((c for r in rows for c in r), np.int64, sum(sizes))
    return np.repeat(np.arange(len(rows)), sizes), columns


def _solve(names: list[bytes], seen: list, swap_penalty: float, steps: int = 500) -> ToxicityModel:
    """Minimises log loss + L2 + penalty on squared changes of the score under swaps, by accelerated
    gradient steps of a length given by the curvature."""
    plain = [r for r in seen if r["after"] is None]
    swapped = [r for r in seen if r["after"] is not None and r["after"] != r["on"]]
    d = len(names) + 1  # the intercept is the last
    r0, c0 = _matrix([[*r["on"], d - 1] for r in plain])
    y = np.array([r["label"] for r in plain], dtype=float)
    n = np.array([r["count"] for r in plain], dtype=float)
    ra, ca = _matrix([r["after"] for r in swapped])
    rb, cb = _matrix([r["on"] for r in swapped])
    m = swap_penalty * np.array([r["count"] for r in swapped], dtype=float)
    ridge = np.full(d, L2)
    ridge[-1] = 1e-3

    def scores(w):
        return np.bincount(r0, w[c0], len(y))

    def change(w):
        return np.bincount(ra, w[ca], len(m)) - np.bincount(rb, w[cb], len(m))

    def back(rows, columns, values):
        return np.bincount(columns, values[rows], d)

    def swap_back(values):
        return back(ra, ca, values) - back(rb, cb, values)

    v = np.ones(d)
    for _ in range(30):
        v /= np.linalg.norm(v)
        v = 0.25 * back(r0, c0, n * scores(v)) + ridge * v + 2 * swap_back(m * change(v))
    step = 1.0 / (1.05 * np.linalg.norm(v))
    w = np.zeros(d)
    w[-1] = np.log((n @ y + 0.5) / (n @ (1 - y) + 0.5))
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-scores(ahead)))
        slope = back(r0, c0, n * (p - y)) + ridge * ahead + 2 * swap_back(m * change(ahead))
        new = ahead - step * slope
        if slope @ (new - w) > 0:  # the momentum points uphill
            t = 1.0
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return ToxicityModel({f: float(x) for f, x in zip(names, w, strict=False)}, float(w[-1]))


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a toxicity score from 0 to 1. Null and empty texts get the score of no features."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = model.scorer()
        for texts in parts:
            yield pd.Series([one(t) for t in texts], dtype=float)
        give_back()

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    scored = F.pandas_udf(run, "double")
    return docs.withColumn(out, scored(docs[text_col].cast("string")))


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those whose score reaches ``threshold``. Columns of any name pass unchanged."""
    model = fit(docs, labels, text_col=text_col)
    scored = score(docs.select(packed(docs), docs[text_col].cast("string").alias("text")), model)
    kept = scored.filter(F.col("score") < threshold)
    return kept.select(*[F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns])
