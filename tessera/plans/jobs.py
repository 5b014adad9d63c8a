"""End-to-end job: the reference's train entry point, Spark-first.

``train_and_score`` runs: domain columns and categorical crosses (before encoding,
so crosses see the raw categories) → preprocessing chain (impute, clip, encode,
scale; fitted on the train rows) → polynomial features → feature scoring (shadow
test, permutation importance, MI) with voting → learners (forest and boosted-tree
presets with early stopping; parameters searched when asked) → the long
prediction table → weighted or stacked ensemble → metrics → optional partitioned
sink and saved artifact. Every step is a DataFrame plan; the
driver only sees fitted statistics, scores (one row per feature) and metrics
(one row per model).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import numeric_cols, string_cols
from ..operators import clean, ensemble, evaluate, learn, scale, select
from ..operators.encode import Encoder
from ..session import cut_lineage
from ..sources import sinks
from ..operators.split import fold_of
from .artifact import Scorer, Steps
from .chain import Chain


#: Scoring methods that vote on features.
METHODS = ("Boruta", "Permutation", "Mutual Information")
# fixed values: column name patterns of the generated domain columns
DOMAIN = {"Total_Area": {"kind": "sum", "patterns": ["SF", "Area"]},
          "Quality_Score": {"kind": "mean", "patterns": ["Qual", "Cond"]},
          "House_Age": {"kind": "difference", "a": "YrSold", "b": "YearBuilt"}}


def default_chain(key: str, label: str, encoding: str = "target",
                  scaling: str = "robust") -> Chain:
    ex = [key, label]
    return Chain([
        clean.fill_absence_stage(),
        clean.Imputer("median", exclude=ex),
        clean.Imputer("most_frequent", kind="categorical", exclude=ex),
        clean.OutlierClipper("iqr", 1.5, exclude=ex),
        Encoder(encoding, label=label, exclude=ex),
        scale.Scaler(scaling, exclude=ex),
    ])


def train_and_score(train: DataFrame, score: DataFrame, key: str, label: str,
                    learners: Sequence[str] = ("random_forest", "xgboost"),
                    weights: dict | None = None, select_features: bool = True,
                    selection: Sequence[str] = METHODS, min_features: int = 20,
                    max_features: int = 200, forest_params: dict | None = None,
                    gbt_params: dict | None = None, out_dir: str | None = None,
                    seed: int = 42, domain: dict | None = None, cross_columns: int | None = 5,
                    max_crosses: int | None = 30, square_columns: int | None = 10,
                    product_columns: int | None = 8, max_interactions: int | None = 50,
                    patience: int | None = 50, stacking: int = 0, cv_folds: int = 0,
                    search_trials: int = 0, search_folds: int = 5,
                    selection_params: dict | None = None, save_to: str | None = None) -> dict[str, DataFrame]:
    """Fit everything on ``train`` and predict ``score`` (which may lack the label).

    * ``domain``: generated columns by name pattern (default ``DOMAIN``; ``{}``: none).
    * ``cross_columns`` / ``max_crosses``: crosses are made of the first so many
      categorical columns, so many at most; ``square_columns`` / ``product_columns`` /
      ``max_interactions`` limit squares and products in the same way. These are the
      declared limits of a job over a wide table: without them 79 columns become
      hundreds of thousands. ``None`` lifts one (the operators themselves have none).
    * ``selection``: scoring methods that vote (``METHODS``); ``selection_params`` holds
      keyword arguments by method.
    * ``patience``: boosted learners stop by the validation error of one row in five
      (``None``: they run all rounds).
    * ``stacking``: folds of the out-of-fold meta-learner that replaces the weighted
      average (0: none). ``cv_folds``: also cross-validate each learner.
      ``search_trials``: choose each learner's parameters by that many random trials,
      scored in ``search_folds`` folds.
    * ``save_to``: where the whole artifact goes (``plans.artifact.load_scorer``).

    Returns ``predictions`` (long: model, key, prediction), ``ensemble`` (key,
    prediction), ``train_metrics`` (per model), ``selected`` (vote table), ``cv`` and
    ``search`` if asked for and, when ``score`` carries the label, ``score_metrics`` and
    ``ranking`` (the members and the ensemble, best first). With ``out_dir`` the
    members go there and the ensemble to ``<out_dir>_ensemble``.
    """
    has_label = label in score.columns
    steps = Steps(DOMAIN if domain is None else domain, string_cols(train, [key, label])[:cross_columns], max_crosses)
    raw = steps.before(train, [key, label])
    chain = default_chain(key, label).fit(raw)
    steps.polynomial = numeric_cols(chain.transform(raw), [key, label])
    steps.limits = {"max_squares": square_columns, "max_pairs_cols": product_columns, "max_interactions": max_interactions}
    scorer = Scorer(key, label, steps, chain, [], {}, weights)
    tr = scorer.prepare(train, all_columns=True)
    feats = numeric_cols(tr, [key, label])
    tr = cut_lineage(tr.select(key, label, *feats))

    out: dict[str, DataFrame] = {}
    if select_features and len(feats) > 1:
        votes = cut_lineage(_votes(tr, key, label, feats, selection, seed, selection_params or {}))
        out["selected"] = select.vote(votes, feats, min_features, max_features)
        feats = [r["feature"] for r in out["selected"].where("selected").orderBy("rank").collect()]
    scorer.columns = feats

    ests, history, cv = {}, [], []
    for name in learners:
        params = dict((forest_params if name == "random_forest" else gbt_params) or {})
        make = (lambda **p: learn.forest(seed=seed, **p)) if name == "random_forest" else (
            lambda name=name, **p: learn.gbt(name, seed=seed, **p))
        if search_trials:
            found = cut_lineage(learn.random_search(tr, feats, label, lambda make=make, params=params, **p: make(**{**params, **p}),
                                                    learn.SEARCH_SPACES[name], key, search_trials, search_folds, seed))
            history.append(found.withColumn("model", F.lit(name)))
            params |= learn.best_params(found)
        ests[name] = make(**params)
        if cv_folds:
            cv.append(learn.cross_validate(tr, feats, label, ests[name], key, cv_folds, seed).withColumn("model", F.lit(name)))
    early = {n: e for n, e in ests.items() if patience and n != "random_forest"}
    fitted = learn.fit_many(tr, feats, label, {n: e for n, e in ests.items() if n not in early}) if len(early) < len(ests) else {}
    for name, e in early.items():
        fitted[name], _ = learn.fit_early(tr, feats, label, e, fold_of(key, 5, seed) == 0, patience)
    scorer.models = {name: fitted[name] for name in learners}
    if stacking:
        rounds = {n: e if n not in early else e.copy().setMaxIter(fitted[n].stages[-1].getNumTrees) for n, e in ests.items()}
        oof = ensemble.out_of_fold(tr, feats, label, rounds, key, stacking, seed)
        scorer.stack = ensemble.fit_ridge(oof, key, list(learners))

    train_m = [learn.train_score(m, tr, label).withColumn("model", F.lit(name)) for name, m in scorer.models.items()]
    long = cut_lineage(scorer.members(score))        # scored once; read by ensemble, metrics and sink
    ens = scorer.combined(long)
    out |= {"predictions": long.select("model", key, "prediction"), "ensemble": ens,
            "train_metrics": _union(train_m)}
    if cv:
        out["cv"] = _union(cv)
    if history:
        out["search"] = _union(history)
    if has_label:
        out["score_metrics"] = evaluate.metrics(long, label, "prediction", by=["model"])
        truth = long.where(F.col("model") == learners[0]).select(key, label)
        both = evaluate.metrics(ens.join(truth, key).withColumn("model", F.lit("ensemble")),
                                label, "prediction", by=["model"])
        out["ranking"] = evaluate.rank_models(out["score_metrics"].unionByName(both))
    if out_dir:
        sinks.write_predictions(out["predictions"], out_dir)
        sinks.write_predictions(ens.withColumn("model", F.lit("ensemble")),
                                f"{out_dir.rstrip('/')}_ensemble")
    if save_to:
        scorer.save(save_to)
    return out


def _votes(tr: DataFrame, key: str, label: str, feats: Sequence[str], selection: Sequence[str], seed: int,
           params: dict) -> DataFrame:
    """``(method, feature, score)`` of what each scoring method keeps."""
    unknown = set(selection) - set(METHODS)
    if unknown:
        raise ValueError(f"unknown selection methods: {sorted(unknown)}")
    parts = []
    if "Boruta" in selection:
        kept = select.shadow_selection(tr, key, feats, label, seed=seed, **params.get("Boruta", {}))
        # the test keeps or drops; it has no score to average
        parts.append(kept.where("selected").select(F.lit("Boruta").alias("method"), "feature", F.lit(None).cast("double").alias("score")))
    if "Permutation" in selection:
        pi = select.permutation_importance(tr, key, feats, label, seed=seed, **params.get("Permutation", {}))
        parts.append(select.threshold_select(pi.select("feature", "score"), 75).select(
            F.lit("Permutation").alias("method"), "feature", "score"))
    if "Mutual Information" in selection:
        mi = select.mutual_information(tr, label, feats, **params.get("Mutual Information", {}))
        parts.append(select.threshold_select(mi, 70).select(F.lit("Mutual Information").alias("method"), "feature", "score"))
    return _union(parts)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
