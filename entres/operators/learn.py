"""Learning on pair features: splits and folds by S1, feature selection, K-fold models, graph rounds, prediction.

Trees of Spark ML take no nulls: a feature is its value or a sentinel, and a flag that it is missing.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entres.sources.stored import stored

from . import decide, scoring
from .index import FAMILY
from .ranking_ops import auc, hash_sample

SENTINEL = -1.0
#: Shares of S1: validation, quick model, early stopping.  Rows a fold may fit at most.
VALIDATION, QUICK, EARLY, ROWS = 0.15, 0.15, 0.05, 2_500_000
COVERAGE, DUPLICATE, OVERLAP, GAIN, PROTECT, DROP, WORSE = 0.0005, 0.99, 0.90, 1e-4, 0.20, 0.25, 0.0002


def validation(s1: DataFrame, share: float = VALIDATION) -> DataFrame:
    """``s1(country, s1)`` with ``split``: about ``share`` of each country by hash; countries of fewer than four have none.

    A country whose hashes all miss gives its S1 with the least hash.
    """
    h = F.pmod(F.xxhash64("s1", F.lit(42)), F.lit(1_000_000))
    n = s1.groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(h.alias("h"), "s1")).alias("least"))
    x = s1.join(F.broadcast(n), "country")
    chosen = (F.col("n") >= 4) & ((h < int(share * 1_000_000)) | (F.col("s1") == F.col("least.s1")))
    return x.select("country", "s1", F.when(chosen, "val").otherwise("train").alias("split"))


def with_folds(pairs: DataFrame, k: int = 3) -> DataFrame:
    """Add ``fold`` and the flags ``quick`` and ``early``; all pairs of an S1 are alike."""
    u = F.pmod(F.xxhash64("s1", F.lit(7)), F.lit(10_000)) / 10_000
    return pairs.withColumns({"fold": F.pmod(F.xxhash64("s1", F.lit(42)), F.lit(k)).cast("int"), "quick": u < QUICK, "early": (u >= QUICK) & (u < QUICK + EARLY)})


def capped_rows(df: DataFrame, most: int = ROWS) -> DataFrame:
    """At most about ``most`` rows for fitting, by hash of the pair."""
    n = df.count()
    return df if n <= most else hash_sample(df, most / n, "s1", "cand")


def vectors(df: DataFrame, features: list[str], flags: bool = True) -> DataFrame:
    names = [f"__v{i}" for i in range(len(features))]
    x = df.withColumns({n: F.coalesce(F.col(f).cast("double"), F.lit(SENTINEL)) for n, f in zip(names, features, strict=True)})
    if flags:
        names += [f"__m{i}" for i in range(len(features))]
        x = x.withColumns({f"__m{i}": F.col(f).isNull().cast("double") for i, f in enumerate(features)})
    return VectorAssembler(inputCols=names, outputCol="__x").transform(x).drop(*names)


def probability(model, df: DataFrame, features: list[str], out: str) -> DataFrame:
    x = model.transform(vectors(df, features))
    return x.withColumn(out, vector_to_array("probability")[1]).drop("__x", "rawPrediction", "probability", "prediction")


def gbt(trees: int = 20, depth: int = 5, step: float = 0.1, seed: int = 42) -> GBTClassifier:
    return GBTClassifier(featuresCol="__x", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=step, seed=seed, subsamplingRate=0.8, minInstancesPerNode=5)


def fit(df: DataFrame, features: list[str], estimator: GBTClassifier | None = None, early: bool = True):
    """A boosted model; rows flagged ``early`` stop it where there are any."""
    est = estimator or gbt()
    if early and "early" in df.columns and not df.where("early").isEmpty():
        est = est.copy({est.validationIndicatorCol: "early"})
    return est.fit(vectors(capped_rows(df), features))


def gains(models: list, features: list[str]) -> dict[str, float]:
    """Importance of each feature (its value and its flag), averaged over models."""
    out = dict.fromkeys(features, 0.0)
    for m in models:
        for i, v in zip(m.featureImportances.indices, m.featureImportances.values, strict=True):
            out[features[int(i) % len(features)]] += float(v) / len(models)
    return out


def top_features(models: list, features: list[str], n: int = 20) -> list[str]:
    g = gains(models, features)
    return sorted(features, key=lambda f: (-g[f], f))[:n]


def feature_report(df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """(feature, coverage, mean1, mean0, least, most, auc): one pass for the moments, one for the ranks of all features."""
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])
    x = df.select(F.col(label).cast("int").alias("label"), F.explode(rows).alias("r")).select("label", "r.*")
    a = x.groupBy("feature").agg((F.count("v") / F.count(F.lit(1))).alias("coverage"), F.avg(F.when(F.col("label") == 1, F.col("v"))).alias("mean1"), F.avg(F.when(F.col("label") == 0, F.col("v"))).alias("mean0"), F.min("v").alias("least"), F.max("v").alias("most"))
    return a.join(auc(x, "feature", "v", "label"), "feature", "left")


def correlations(df: DataFrame, features: list[str], least: float = 0.97) -> DataFrame:
    """(a, b, r, overlap) of pairs of features correlated at ``least``, where both are known; one aggregate."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1 :]]
    out = None
    for lo in range(0, len(pairs), 500):  # expressions of one aggregate
        part = pairs[lo : lo + 500]
        agg = [e for i, (a, b) in enumerate(part) for e in (F.corr(F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))).alias(f"r{i}"), F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias(f"n{i}"), F.greatest(F.count(a), F.count(b)).alias(f"m{i}"))]
        rows = df.agg(*agg).select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"), F.try_divide(F.col(f"n{i}"), F.col(f"m{i}")).alias("overlap")) for i, (a, b) in enumerate(part)])).alias("x")).select("x.*")
        out = rows if out is None else out.unionByName(rows)
    return out.where(F.abs("r") > least)


def select_features(train: DataFrame, universe: DataFrame, valid: DataFrame, features: list[str], estimator: GBTClassifier | None = None) -> tuple[list[str], dict[str, str]]:
    """Features to keep, and why others go: empty or constant, near duplicates of less gain, next to no gain; undone if F0.5 falls."""
    sample = train.where("quick")
    report = {r.feature: r for r in feature_report(sample, features).collect()}
    gone = {f: "empty or constant" for f, r in report.items() if r.coverage < COVERAGE or r.least is None or not r.most > r.least}
    live = [f for f in features if f not in gone]
    model = fit(train.where("quick or early"), live, estimator)
    gain = gains([model], live)
    sep = {f: abs((report[f].auc if report[f].auc is not None else 0.5) - 0.5) for f in live}
    worth = lambda f: (gain[f], sep[f] * report[f].coverage)
    for r in sorted(correlations(sample, live, DUPLICATE).where(F.col("overlap") >= OVERLAP).collect(), key=lambda r: -abs(r.r)):
        if r.a not in gone and r.b not in gone:
            lose, win = (r.a, r.b) if worth(r.a) < worth(r.b) else (r.b, r.a)
            gone[lose] = f"duplicate of {win}"
    cap = int(DROP * len(features))
    weak = sorted((f for f in live if f not in gone and gain[f] < GAIN and sep[f] < PROTECT), key=lambda f: (gain[f], f))[: max(0, cap - len(gone))]
    best = lambda m, fs: max(r.f05 for r in decide.sweep(universe, probability(m, valid, fs, "p"), (1.0, 0.0), decide.THRESHOLDS[::6]).collect())
    keep = [f for f in live if f not in gone and f not in weak]
    if weak and best(fit(train.where("quick or early"), keep, estimator), keep) < best(model, live) - WORSE:
        return [f for f in live if f not in gone], gone
    return keep, gone | dict.fromkeys(weak, "next to no gain")


def kfold(train: DataFrame, features: list[str], estimator: GBTClassifier | None = None, k: int = 3, out: str = "p") -> tuple[list, DataFrame]:
    """K models, each fitted without one fold, and the training pairs scored by the model that has not seen their S1."""
    models = [fit(train.where(F.col("fold") != i), features, estimator) for i in range(k)]
    parts = [probability(m, train.where(F.col("fold") == i), features, out) for i, m in enumerate(models)]
    return models, reduce(DataFrame.unionByName, parts)


def mean_probability(models: list, df: DataFrame, features: list[str], out: str = "p") -> DataFrame:
    names = [f"__p{i}" for i in range(len(models))]
    for m, n in zip(models, names, strict=True):
        df = probability(m, df, features, n)
    return df.withColumn(out, reduce(lambda a, b: a + b, [F.col(n) for n in names]) / len(names)).drop(*names)


def cross_fit(df: DataFrame, features: list[str], estimator: GBTClassifier | None = None, out: str = "p") -> tuple[list, DataFrame]:
    """Two models by parity of the S1's hash; each scores the half that the other was fitted on."""
    return kfold(df.withColumn("fold", F.pmod(F.xxhash64("s1"), F.lit(2)).cast("int")), features, estimator, 2, out)


def fit_pre_score(x: DataFrame) -> dict:
    """Linear weights of the pre-score by logistic regression on standardised features, bits and their number, on the raw scale."""
    names = [*scoring.PRE_FEATURES, *[f"bit_{f}" for f in FAMILY], "n_evidence"]
    x = x.withColumns({f"bit_{f}": F.expr(f"cast(getbit(evidence_mask, {i}) as double)") for i, f in enumerate(FAMILY)})
    v = vectors(capped_rows(x), names, flags=False)
    scaler = StandardScaler(inputCol="__x", outputCol="__z", withMean=True, withStd=True).fit(v)
    lr = LogisticRegression(featuresCol="__z", labelCol="label", maxIter=50, regParam=1e-4).fit(scaler.transform(v))
    sd = [s if s > 1e-6 else 1.0 for s in scaler.std]
    w = [c / s for c, s in zip(lr.coefficients, sd, strict=True)]
    k = len(scoring.PRE_FEATURES)
    return {"weights": dict(zip(scoring.PRE_FEATURES, w[:k], strict=True)), "bits": w[k:-1], "per_family": w[-1], "intercept": float(lr.intercept - sum(a * m for a, m in zip(w, scaler.mean, strict=True)))}


def graph_rounds(train: DataFrame, valid: DataFrame, records: DataFrame, raw: list[str], rounds: int = 2, estimator: GBTClassifier | None = None, k: int = 3) -> tuple[list, DataFrame, DataFrame]:
    """Level-2 models on group features of the previous round's probability ``p``; pairs of both sides compete.

    Tables are written after each round, so plans do not grow.
    """
    out = []
    keep = ["country", "s1", "cand", "label", "fold", "early", *raw]
    x = train.select(*keep, "p", F.lit(True).alias("is_train")).unionByName(valid.select(*[c if c in valid.columns else F.lit(None).alias(c) for c in keep], "p", F.lit(False).alias("is_train")))
    for r in range(rounds):
        extras = ["l1"] if r else []
        z = stored(decide.level2(x.withColumn("l1", F.col("l1") if "l1" in x.columns else F.col("p")), records, extras, raw), f"round-{r}")
        names = level2_names(extras, raw)
        models, oof = kfold(z.where("is_train"), names, estimator, k, "q")
        scored = oof.unionByName(mean_probability(models, z.where("not is_train"), names, "q"))
        out.append({"models": models, "features": names, "raw": raw, "extras": extras})
        x = stored(scored.select(*keep, F.col("q").alias("p"), "l1", "is_train"), f"round-{r}-p")
    return out, x.where("is_train"), x.where("not is_train")


def level2_names(extras: list[str], raw: list[str]) -> list[str]:
    own = ["p", "s1_rank", "s1_lead", "p_div_s1max", "s1_sum", "s1_n50", "s1_n90", "s1_npairs", "rank_minus_n50", "c_rank", "c_lead", "p_div_cmax", "c_sum", "c_n50", "c_n90", "c_npairs", "anchor_n_other"]
    own += [f"anchor_share_{f}" for f in decide.CAND_FIELDS] + ["anchor_share_max", "other_s1_p", "other_s1_shared", "other_s1_shared_frac", "s1_dup_shared_max"]
    own += [f"other_s1_same_{f}" for f in decide.S1_FIELDS] + ["other_s1_jacc_name", "other_s1_jacc_addr"]
    return own + [f"x_{e}" for e in extras] + (["x_std"] if len(extras) >= 2 else []) + [f"raw_{f}" for f in raw]


def predict(pairs: DataFrame, records: DataFrame, level1: list, features: list[str], rounds: list[dict], rule: dict) -> DataFrame:
    """Pairs with ``p`` and ``pred`` by a trained pipeline; repeated pairs count once, features that are absent are null."""
    x = pairs.dropDuplicates(["s1", "cand"])
    x = x.withColumns({f: F.lit(None).cast("double") for f in features if f not in x.columns})
    x = mean_probability(level1, x, features)
    x = x.withColumn("l1", F.col("p"))
    for r in rounds:
        z = stored(decide.level2(x, records, r["extras"], r["raw"]), "predict")
        if missing := [f for f in r["features"] if f not in z.columns]:
            raise ValueError(f"the model was fitted on features that are not there: {missing[:5]}")
        x = mean_probability(r["models"], z, r["features"], "__q").withColumn("p", F.col("__q")).select(*x.columns)
    return decide.decide(x, rule)


def save(path: str, spark, models: list, meta: dict) -> None:
    """Models and what they need, below a folder that must be new."""
    for i, m in enumerate(models):
        PipelineModel([m]).write().save(f"{path}/model-{i}")
    spark.createDataFrame([(json.dumps(meta | {"n": len(models)}, sort_keys=True),)], "meta string").coalesce(1).write.mode("error").text(f"{path}/meta")


def load(path: str, spark, features: list[str] | None = None) -> tuple[list, dict]:
    """What :func:`save` wrote; with ``features`` the saved ones must be the same."""
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    if features is not None and meta.get("features") != features:
        raise ValueError("the saved model was fitted on other features")
    return [PipelineModel.load(f"{path}/model-{i}").stages[0] for i in range(meta["n"])], meta


