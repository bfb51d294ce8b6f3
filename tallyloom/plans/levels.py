"""Named preparation presets: fit on training rows, replay on any split.

A fit takes a handful of scans whatever the width of the table, and brings back per-feature facts only. The replay is
one projection, so it fuses with the scan below it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import col, number, quoted
from ..operators.balance import oversample
from ..operators.columns import HIGH, KNOWN, LOW, MAJORITY_VALUE, MEAN, ROWS, STD, per_column, value_counts
from ..operators.encode import (
    OneHotSpec, TargetSpec, collect_one_hot, fit_one_hot, fit_target_encoding, impute_counts, one_hot_columns,
    target_encoded,
)
from ..operators.impute import CONTINUOUS_STRATEGIES, filled_text, median_fill, mode_fill
from ..operators.profile import MAJORITY
from ..operators.roles import date_or_id_features, feature_roles, override_roles
from ..operators.scale import FLAT
from ..operators.select import (
    column_print, first_pairs, low_variance_features, print_groups, settle_equals, unequal_rows, without,
)


@dataclass(frozen=True)
class Preset:
    """Settings of one preparation level."""

    missing: float = 0.5
    low_variance: float | None = 0.995
    strategy: str = "mean"
    min_count: int = 50
    max_categories: int = 50
    smoothing: float = 1.0
    deduplicate: bool = False
    oversample: float | None = None


# The named levels.
LEVELS = {
    "level0": Preset(missing=0.99, low_variance=None, min_count=0, max_categories=0),
    "level1": Preset(missing=0.80, low_variance=0.999, min_count=100, max_categories=50),
    "level2_unbalanced": Preset(missing=0.60, low_variance=0.995, min_count=50, max_categories=20),
    "level2": Preset(missing=0.60, low_variance=0.995, min_count=50, max_categories=20, oversample=0.35),
    "level3": Preset(missing=0.40, low_variance=0.990, strategy="median", min_count=20, max_categories=10,
                     smoothing=0.5, deduplicate=True, oversample=0.35),
    "level4": Preset(missing=0.60, low_variance=0.995, min_count=50, max_categories=20, smoothing=0.5,
                     deduplicate=True, oversample=0.35),
}
LEVEL5 = Preset(missing=0.50, low_variance=None, min_count=50, max_categories=50, oversample=0.35)


@dataclass
class PreparedState:
    """Everything a replay needs, keyed by feature name."""

    continuous: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    dropped: dict[str, str] = field(default_factory=dict)
    fill: dict[str, float] = field(default_factory=dict)
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)
    target: dict[str, TargetSpec] = field(default_factory=dict)
    one_hot: dict[str, OneHotSpec] = field(default_factory=dict)
    passed: list[str] = field(default_factory=list)
    global_mean: float = 0.0
    counts: tuple[int, int] = (0, 0)

    SCHEMA = "item string, position int, feature string, key double, number double, note string"

    def rows(self) -> list[tuple]:
        out = [("table", 0, None, None, self.global_mean, None), ("positives", 0, None, None, float(self.counts[0]), None),
               ("negatives", 0, None, None, float(self.counts[1]), None)]
        out += [("continuous", i, f, None, None, None) for i, f in enumerate(self.continuous)]
        out += [("categorical", i, f, None, None, None) for i, f in enumerate(self.categorical)]
        out += [("passed", i, f, None, None, None) for i, f in enumerate(self.passed)]
        out += [("dropped", i, f, None, None, why) for i, (f, why) in enumerate(self.dropped.items())]
        out += [("fill", 0, f, None, v, None) for f, v in self.fill.items()]
        out += [("scale", 0, f, m, s, None) for f, (m, s) in self.scale.items()]
        for f, t in self.target.items():
            out.append(("target_other", 0, f, None, t.other, "has_other" if t.has_other else None))
            out += [("target", i, f, k, v, None) for i, (k, v) in enumerate(t.encodings.items())]
        for f, s in self.one_hot.items():
            out.append(("one_hot_other", 0, f, None, float(s.other), None))
            out += [("one_hot", i, f, v, None, None) for i, v in enumerate(s.values)]
        return out

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), self.SCHEMA)

    @classmethod
    def from_frame(cls, frame: DataFrame) -> PreparedState:
        s, sizes = cls(), {}
        for r in sorted(frame.collect(), key=lambda r: (r["item"], r["feature"] or "", r["position"])):
            item, f, key, number = r["item"], r["feature"], r["key"], r["number"]
            if item == "table":
                s.global_mean = number
            elif item in ("positives", "negatives"):
                sizes[item] = int(number)
            elif item == "fill":
                s.fill[f] = number
            elif item == "scale":
                s.scale[f] = (key, number)
            elif item == "dropped":
                s.dropped[f] = r["note"]
            elif item == "target_other":
                t = s.target.setdefault(f, TargetSpec())
                t.other, t.has_other = number, r["note"] == "has_other"
            elif item == "target":
                s.target.setdefault(f, TargetSpec()).encodings[key] = number
            elif item == "one_hot_other":
                s.one_hot.setdefault(f, OneHotSpec()).other = bool(number)
            elif item == "one_hot":
                s.one_hot.setdefault(f, OneHotSpec()).values.append(key)
            elif item in ("continuous", "categorical", "passed"):
                getattr(s, item).append((r["position"], f))
        for item in ("continuous", "categorical", "passed"):
            setattr(s, item, [f for _, f in sorted(getattr(s, item))])
        s.counts = (sizes.get("positives", 0), sizes.get("negatives", 0))
        return s


def _facts(df: DataFrame, features: Sequence[str], label: str, extra=None) -> dict:
    """Missing counts and moments per feature with the class counts, in one scan."""
    y = quoted(label)
    facts = per_column(df, features, {"known": KNOWN, "mean": MEAN, "std": STD, **(extra or {})}, {
        "rows": ROWS, "positives": f"count_if({y} = 1)", "negatives": f"count_if({y} = -1)"})
    return {r["feature"]: r for r in facts.collect()}


def _missing_share(fact) -> float:
    return (fact["rows"] - fact["known"]) / max(1, fact["rows"])


def _filled_moments(fact, fill: float) -> tuple[float, float]:
    """Mean and deviation of a column once its missing cells hold ``fill``, from the moments of its known cells."""
    rows, known = fact["rows"], fact["known"]
    if known == 0:
        return fill, 1.0
    gone = rows - known
    mean = (known * fact["mean"] + gone * fill) / rows
    variance = (known * (fact["std"] ** 2 + (fact["mean"] - mean) ** 2) + gone * (fill - mean) ** 2) / rows
    std = variance ** 0.5
    return mean, std if std > FLAT else 1.0


def _flat_and_equal(df: DataFrame, features: Sequence[str], facts: dict, preset: Preset) -> dict[str, str]:
    """Features to drop for low variance or as duplicates; one scan confirms what the first scan's facts suggest."""
    flat: set[str] = set()
    asked, groups = [], []
    if preset.low_variance is not None:
        flat = {f for f in features if facts[f]["known"] and facts[f]["low"] == facts[f]["high"]}
        if preset.low_variance > MAJORITY:
            asked = [f for f in features if f not in flat and facts[f]["known"] and facts[f]["majority"] is not None
                     and facts[f]["known"] >= preset.low_variance * facts[f]["rows"]]
        else:
            flat |= set(low_variance_features(df, features, preset.low_variance))
    if preset.deduplicate:
        groups = print_groups({f: facts[f]["print"] for f in features if f not in flat})
    if asked or groups:
        pairs = first_pairs(groups)
        checks = ([f"count_if(CAST({quoted(f)} AS DOUBLE) = {number(facts[f]['majority'])}) AS a{i}" for i, f in enumerate(asked)]
                  + [f"{unequal_rows(a, b)} AS p{i}" for i, (a, b) in enumerate(pairs)])
        found = list(df.selectExpr(*checks).first())
        flat |= {f for f, n in zip(asked, found) if n / facts[f]["rows"] >= preset.low_variance}
        equal = settle_equals(df, groups, found[len(asked):]) if groups else {}
        # A near-constant column leaves together with its copies, so only copies of kept columns are duplicates.
        equal = {f: kept for f, kept in equal.items() if f not in flat}
        return {**{f: "low variance" for f in features if f in flat}, **{f: "duplicate" for f in equal}}
    return {f: "low variance" for f in features if f in flat}


@contextmanager
def held(train: DataFrame, columns: Sequence[str]) -> Iterator[DataFrame]:
    """The columns of a fit, computed once for all its passes and given back at its end."""
    narrow = train.select(*[col(c) for c in dict.fromkeys(columns)]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield narrow
    finally:
        narrow.unpersist()


@contextmanager
def stored_counts(counts: DataFrame) -> Iterator[DataFrame]:
    """Value counts, taken once for all their uses in a fit and given back at its end."""
    kept = counts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def fit_preset(train: DataFrame, features: Sequence[str], continuous: Sequence[str], preset: Preset,
               label: str = "y", key: str = "id") -> PreparedState:
    """Drop, impute, scale and target-encode: learn every step from the training rows.

    Features that are not continuous are categorical, binary ones included.
    """
    with held(train, [key, label, *features]) as rows:
        return _fit_preset(rows, features, continuous, preset, label, key)


def _fit_preset(train: DataFrame, features: Sequence[str], continuous: Sequence[str], preset: Preset, label: str,
                key: str) -> PreparedState:
    if preset.strategy not in CONTINUOUS_STRATEGIES:
        raise ValueError(f"unknown strategy for continuous features: {preset.strategy!r}")
    state = PreparedState()
    extra = {}
    if preset.low_variance is not None:
        extra.update({"low": LOW, "high": HIGH})
        if preset.low_variance > MAJORITY:
            extra["majority"] = MAJORITY_VALUE
    if preset.deduplicate:
        extra["print"] = column_print(key)
    facts = _facts(train, features, label, extra)
    first = facts[features[0]]
    state.counts = (first["positives"], first["negatives"])
    state.global_mean = (first["positives"] - first["negatives"]) / max(1, first["rows"])

    state.dropped = {f: "missing" for f in features if _missing_share(facts[f]) > preset.missing}
    kept = without(features, list(state.dropped))
    flat = _flat_and_equal(train, kept, facts, preset)
    state.dropped.update(flat)
    kept = without(kept, list(flat))

    wanted = set(continuous)
    state.continuous = [f for f in kept if f in wanted]
    state.categorical = [f for f in kept if f not in wanted]
    if state.continuous:
        if preset.strategy == "median":
            state.fill.update({r["feature"]: r["fill"] for r in median_fill(train, state.continuous).collect()})
        else:
            state.fill.update({f: facts[f]["mean"] if facts[f]["known"] else 0.0 for f in state.continuous})
        state.scale = {f: _filled_moments(facts[f], state.fill[f]) for f in state.continuous}
    if state.categorical:
        with stored_counts(value_counts(train, state.categorical, label)) as counts:
            modes = counts.groupBy("feature").agg(F.coalesce(F.max_by("value", F.when(
                F.col("value").isNotNull(), F.struct("n", -F.col("value")))), F.lit(0.0)).alias("fill"))
            spec = fit_target_encoding(impute_counts(counts), state.global_mean, preset.min_count, preset.max_categories,
                                       preset.smoothing)
            found = spec.join(modes, "feature").orderBy("feature", "place").collect()
        for r in found:
            state.fill[r["feature"]] = r["fill"]
            t = state.target.setdefault(r["feature"], TargetSpec())
            if r["place"] == 0:
                t.other, t.has_other = r["encoding"], r["has_other"]
            else:
                t.encodings[r["value"]] = r["encoding"]
    return state


def transform(df: DataFrame, state: PreparedState, keep: Sequence[str] = ("id",)) -> DataFrame:
    """Scaled continuous columns, then encoded categorical ones, in one projection."""
    out = []

    for f in state.continuous:
        mean, std = state.scale.get(f, (0.0, 1.0))
        out.append(F.expr(f"({filled_text(f, state.fill)} - {number(mean)}) / {number(std)} AS {quoted(f)}"))
    out += [F.expr(f"{filled_text(f, state.fill)} AS {quoted(f)}") for f in state.passed]
    for f in state.categorical:
        if f in state.one_hot:
            out += one_hot_columns(f, filled_text(f, state.fill), state.one_hot[f])
        else:
            out.append(target_encoded(filled_text(f, state.fill), state.target[f], state.global_mean).alias(f))
    return df.select(*keep, *out)


def continuous_candidates(train: DataFrame, features: Sequence[str]) -> list[str]:
    """Continuous features that look neither like dates nor like ids."""
    roles = feature_roles(train, features)
    continuous = {r["feature"] for r in roles.where(F.col("role") == "continuous").collect()}
    ordered = [f for f in features if f in continuous]
    if not ordered:
        return []
    suspects = {r["feature"] for r in date_or_id_features(train, ordered).collect()}
    return without(ordered, list(suspects))


def fit_level5(train: DataFrame, features: Sequence[str], forced_continuous: Sequence[str] = (),
               parity: str = "effective", include_binary: bool = False, label: str = "y",
               preset: Preset = LEVEL5) -> PreparedState:
    """Role-driven preset with one-hot columns.

    ``parity='effective'`` fills every missing cell outside the continuous columns with 0; ``'documented'`` uses the
    mean for binary, 0 for pseudo-binary and the mode for categorical columns. Binary columns are left out unless
    ``include_binary`` is set.
    """
    with held(train, [label, *features]) as rows:
        return _fit_level5(rows, features, forced_continuous, parity, include_binary, label, preset)


def _fit_level5(train: DataFrame, features: Sequence[str], forced_continuous: Sequence[str], parity: str,
                include_binary: bool, label: str, preset: Preset) -> PreparedState:
    if parity not in ("effective", "documented"):
        raise ValueError(f"unknown parity: {parity!r}")
    state = PreparedState()
    facts = _facts(train, features, label)
    first = facts[features[0]]
    state.counts = (first["positives"], first["negatives"])
    state.global_mean = (first["positives"] - first["negatives"]) / max(1, first["rows"])
    state.dropped = {f: "missing" for f in features if _missing_share(facts[f]) > preset.missing}
    kept = without(features, list(state.dropped))
    roles = {r["feature"]: r["role"] for r in override_roles(feature_roles(train, kept), forced_continuous).collect()}

    def having(*names: str) -> list[str]:
        return [f for f in kept if roles[f] in names]

    state.continuous, state.categorical = having("continuous"), having("categorical")
    state.fill = {f: facts[f]["mean"] if facts[f]["known"] else 0.0 for f in state.continuous}
    state.scale = {f: _filled_moments(facts[f], state.fill[f]) for f in state.continuous}
    if parity == "documented":
        state.fill.update({f: facts[f]["mean"] for f in having("binary")})
        if state.categorical:
            state.fill.update({r["feature"]: r["fill"] for r in mode_fill(train, state.categorical).collect()})
    if include_binary:
        state.passed = having("binary", "pseudo_binary")
    if state.categorical:
        filled = train.selectExpr(*[f"{filled_text(f, state.fill)} AS {quoted(f)}" for f in state.categorical])
        counts = value_counts(filled, state.categorical)
        state.one_hot = collect_one_hot(fit_one_hot(counts, preset.min_count, preset.max_categories))
    return state


def prepare(train: DataFrame, test: DataFrame, features: Sequence[str], level: str,
            continuous: Sequence[str] | None = None, balanced: bool = True, seed: int = 1, **level5_options
            ) -> tuple[DataFrame, DataFrame, PreparedState]:
    """Fit a named level on the training rows and transform both splits; training rows are then oversampled."""
    preset = LEVEL5 if level == "level5" else LEVELS[level]
    if level == "level5":
        state = fit_level5(train, features, **level5_options)
    else:
        chosen = continuous_candidates(train, features) if continuous is None else continuous
        state = fit_preset(train, features, chosen, preset)
    ready = transform(train, state, ("id", "y"))
    if balanced and preset.oversample is not None:
        ready = oversample(ready, preset.oversample, seed, counts=state.counts)
    return ready, transform(test, state), state


def variant(level: str, **changes) -> Preset:
    """A named level with some settings changed."""
    return replace(LEVELS[level], **changes)
