"""Weighted logistic models, compared over feature variants."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.operators import metrics
from refrain.operators.features import Selector, representation
from refrain.operators.ranking import LinearModel
from refrain.operators.temporal import FEATURES

@dataclass(frozen=True)
class Variant:
    """Which inputs a model sees, and whether it is fitted on tracks with a whole audio profile alone."""

    name: str
    behavior: tuple[str, ...] = ()
    descriptors: bool = False
    embedding: bool = False
    matched: bool = False


def variants(descriptors: bool, embedding: bool) -> list[Variant]:
    """All variants that the inputs allow, the baselines first."""
    out = [Variant("repeat_recency_baseline", ("prior_log_play_count", "prior_recency_score")), Variant("artist_baseline", FEATURES[10:]), Variant("behavior_all", FEATURES)]
    audio = {"descriptors": (True, False)} if descriptors else {}
    audio |= {"embedding": (False, True)} if embedding else {}
    if audio:
        out.append(Variant("behavior_matched", FEATURES, matched=True))
    for kind, (d, e) in audio.items():
        out += [Variant(f"{kind}_only", (), d, e, True), Variant(f"behavior_{kind}", FEATURES, d, e, True)]
    if len(audio) == 2:
        out += [Variant("audio_full", (), True, True, True), Variant("full_combined", FEATURES, True, True, True)]
    return out


def fit_logistic(train: DataFrame, names: Sequence[str], *, label: str = "label", weight: str = "sample_weight", c: float = 1.0) -> LinearModel:
    """Minimises half the squared coefficients, the intercept among them, plus ``c``
    times the weighted log loss, on weighted-standardised features.

    Newton's method: a step takes one pass over all rows, and a task gives back the sums
    of its rows alone (the square of the features). The loss is strictly convex, so a
    step that is halved until the loss doesn't rise leads to its one minimum.
    """
    names = list(names)
    columns = [F.col(n).cast("double").alias(f"x{i}") for i, n in enumerate(names)]
    rows = train.select(*columns, F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w")).persist()
    s = metrics.weighted_scaler(rows, [f"x{i}" for i in range(len(names))], "w").first()
    mean, scale = (np.array([float(s[f"x{i}_{part}"]) for i in range(len(names))]) for part in ("mean", "scale"))
    d = len(names) + 1

    def sums(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss, slope, curve = 0.0, np.zeros(d), np.zeros((d, d))
            for b in batches:
                *x, y, w = (column.to_numpy(zero_copy_only=False) for column in b.columns)
                z = np.column_stack([*((v - m) / k for v, m, k in zip(x, mean, scale, strict=True)), np.ones(len(y))])
                score = z @ beta
                p = np.exp(-np.logaddexp(0, -score))
                loss += float((w * (np.logaddexp(0, score) - y * score)).sum())
                slope += z.T @ (w * (p - y))
                curve += (z * (w * p * (1 - p))[:, None]).T @ z
            yield pa.RecordBatch.from_arrays([pa.array([[loss, *slope, *curve.ravel()]], type=pa.list_(pa.float64()))], names=["part"])

        parts = sorted(r.part for r in rows.mapInArrow(run, "part array<double>").collect())
        total = np.sum(np.array(parts, dtype=float).reshape(-1, 1 + d + d * d), axis=0)
        return float(beta @ beta / 2 + c * total[0]), beta + c * total[1 : 1 + d], np.eye(d) + c * total[1 + d :].reshape(d, d)

    beta = np.zeros(d)
    value, slope, curve = sums(beta)
    while True:
        step = np.linalg.solve(curve, slope)
        if not np.isfinite(step).all():
            raise ValueError("a feature, label or weight is not a number")
        if np.abs(step).max() <= 1e-9 * (1 + np.abs(beta).max()):
            break
        at = sums(beta - step)
        while at[0] > value + 1e-12 * abs(value) and np.abs(step).max() > 1e-12:
            step = step / 2
            at = sums(beta - step)
        beta, (value, slope, curve) = beta - step, at
    rows.unpersist()
    *coefficients, intercept = (float(v) for v in beta)
    return LinearModel(tuple(names), tuple(mean.tolist()), tuple(scale.tolist()), tuple(coefficients), intercept)


def predict(samples: DataFrame, model: LinearModel, name: str) -> DataFrame:
    p = model.probability({n: F.col(n) for n in model.names})
    return samples.select(F.lit(name).alias("model_name"), "sample_id", "track_id", "split", "period_index", "label", p.alias("probability"))


def evaluate(predictions: DataFrame, k: int = 10) -> dict[str, Any]:
    parts = [metrics.auc(predictions), metrics.average_precision(predictions), metrics.log_loss_brier(predictions), metrics.calibration_error(predictions), metrics.ranking(predictions, k=k)]
    together = parts[0]
    for part in parts[1:]:
        together = together.crossJoin(F.broadcast(part))  # single rows
    return together.first().asDict()


@dataclass(frozen=True)
class Fitted:
    """What became of a variant: its model and metrics, or the reason why it was skipped."""

    variant: Variant
    features: tuple[str, ...]
    rows: dict[str, int]
    model: LinearModel | None = None
    validation: dict[str, Any] | None = None
    test: dict[str, Any] | None = None
    reason: str | None = None

    @property
    def merit(self) -> tuple[float, float, str]:
        v = self.validation or {}
        return (v.get("ndcg_at_k") or 0.0, v.get("average_precision") or 0.0, self.variant.name)


#: Variants in work at once: each is a chain of short jobs that leave most cores idle.
AT_ONCE = 8


def _together(f: Callable, items: Sequence) -> list:
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(f, items))


class NothingTrained(ValueError):
    """No variant could be fitted; ``found`` has each with its reason."""

    def __init__(self, found: list[Fitted]):
        super().__init__("no variant has two labels in training and rows in every split")
        self.found = found


def with_audio(samples: DataFrame, observations: DataFrame, descriptors: Sequence[Selector], embedding: Selector | None, minimum_confidence: float = 0.0) -> tuple[DataFrame, list[str], list[str]]:
    """Samples with a column for each descriptor and embedding element, null unless the
    track has all of the profile, and the names of both kinds of columns."""
    wide = representation(observations, descriptors, embedding, minimum_confidence=minimum_confidence)
    size = wide.agg(F.max(F.size("embedding")).alias("n")).first().n or 0 if embedding else 0
    d, e = [f"descriptor_{i}" for i in range(len(descriptors))], [f"embedding_{i}" for i in range(size)]
    columns = [F.col("descriptors")[i].cast("double").alias(n) for i, n in enumerate(d)] + [F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(e)]
    return samples.join(wide.select("track_id", *columns), "track_id", "left"), d, e


def train_taste_models(samples: DataFrame, *, observations: DataFrame | None = None, descriptors: Sequence[Selector] = (), embedding: Selector | None = None, minimum_confidence: float = 0.0, k: int = 10, c: float = 1.0) -> tuple[list[Fitted], Fitted, dict[str, dict[str, float]]]:
    """(every variant, the selected one, bootstrap comparisons with the best).

    Each variant is fitted on the training split and evaluated on the others. Audio
    variants, and the behaviour model they are compared with, see the tracks with the
    whole profile; one of that cohort is selected if there is a profile. Raises
    ``NothingTrained`` if no variant can be fitted.
    """
    d: list[str] = []
    e: list[str] = []
    rows = samples
    if observations is not None and (descriptors or embedding):
        rows, d, e = with_audio(samples, observations, descriptors, embedding, minimum_confidence)
    rows = rows.cache()
    rows.count()
    out = _together(lambda v: fit_variant(rows, v, d, e, k=k, c=c), variants(bool(d), bool(e)))
    trained = [f for f in out if f.model]
    if not trained:
        raise NothingTrained(out)
    cohort = [f for f in trained if f.variant.matched == bool(d or e)] or trained
    chosen, compared = select_variant(rows, cohort, k=k)
    return out, chosen, compared


def _seen(rows: DataFrame, variant: Variant, names: Sequence[str], audio: Sequence[str]) -> DataFrame:
    return rows.na.drop(subset=list(names) + (list(audio) if variant.matched else []))


def fit_variant(rows: DataFrame, variant: Variant, d: Sequence[str], e: Sequence[str], *, k: int = 10, c: float = 1.0) -> Fitted:
    names = (*variant.behavior, *(d if variant.descriptors else ()), *(e if variant.embedding else ()))
    mine = _seen(rows, variant, names, (*d, *e))
    found = {r.split: r for r in mine.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("labels")).collect()}
    counts = {s: found[s].n if s in found else 0 for s in ("train", "validation", "test")}
    reason = "a split has no covered samples" if not all(counts.values()) else "the training split has one label alone" if found["train"].labels < 2 else None
    if reason:
        return Fitted(variant, names, counts, reason=reason)
    model = fit_logistic(mine.filter("split = 'train'"), names, c=c)
    validation, test = (evaluate(predict(mine.filter(F.col("split") == s), model, variant.name), k) for s in ("validation", "test"))
    return Fitted(variant, names, counts, model, validation, test)


def select_variant(rows: DataFrame, cohort: Sequence[Fitted], *, k: int = 10) -> tuple[Fitted, dict[str, dict[str, float]]]:
    """The best on validation by NDCG, average precision and name; of those it isn't surely
    better than (the bootstrap interval of its lift reaches zero) and itself, the simplest."""
    best = max(cohort, key=lambda f: f.merit)
    audio = [c for c in rows.columns if c.startswith(("descriptor_", "embedding_"))]

    def predicted(f: Fitted) -> DataFrame:
        return predict(_seen(rows, f.variant, f.features, audio).filter("split = 'validation'"), f.model, f.variant.name)

    others = [f for f in cohort if f is not best]
    lifts = _together(lambda f: metrics.bootstrap(metrics.paired_deltas(predicted(f), predicted(best), k=k)), others)
    compared = {f.variant.name: lift for f, lift in zip(others, lifts, strict=True)}
    tied = [best, *(f for f in cohort if f is not best and compared[f.variant.name]["low"] <= 0)]
    fewest = min(len(f.features) for f in tied)
    return max((f for f in tied if len(f.features) == fewest), key=lambda f: f.merit), compared


def to_json(model: LinearModel) -> dict[str, Any]:
    """A portable form with an id that is the digest of its content."""
    body = {"schema_version": 1, "features": list(model.names), "mean": list(model.mean), "scale": list(model.scale), "coefficient": list(model.coefficient), "intercept": model.intercept}
    canonical = json.dumps(body, ensure_ascii=False, separators=(",", ":"), sort_keys=True)
    return body | {"model_id": hashlib.sha256(canonical.encode()).hexdigest()}


def from_json(payload: Mapping[str, Any]) -> LinearModel:
    model = LinearModel(tuple(payload["features"]), tuple(payload["mean"]), tuple(payload["scale"]), tuple(payload["coefficient"]), payload["intercept"])
    if to_json(model)["model_id"] != payload.get("model_id"):
        raise ValueError("the model's id isn't the digest of its content")
    return model
