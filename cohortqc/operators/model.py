"""Imputation of features, the variant random forest and the population classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortqc.functions.genetics import in_intervals
from cohortqc.functions.ids import lot

# fixed values: the model's features
FEATURES = ("variant_type", "allele_type", "n_alt_alleles", "was_mixed", "was_split", "has_star", "mq", "qd", "mqranksum", "sor", "readposranksum", "mean_het_ab")


def median_impute(df: DataFrame, stratum: str, columns: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Null or NaN becomes the stratum's median, with <column>_imputed as mark. Medians are exact, or approximate with
    ``accuracy`` points for columns of very many distinct values. There are few strata, so they are broadcast."""
    clean = df.withColumns({c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns})
    median = (lambda c: F.median(c)) if accuracy is None else (lambda c: F.percentile_approx(c, 0.5, accuracy))
    side = clean.groupBy(F.col(stratum).alias("_s")).agg(*[median(c).alias(f"_m_{c}") for c in columns])
    j = clean.join(F.broadcast(side), clean[stratum].eqNullSafe(side["_s"]), "left")
    return j.select(*[F.coalesce(c, f"_m_{c}").alias(c) if c in columns else F.col(c) for c in df.columns], *[F.col(c).isNull().alias(f"{c}_imputed") for c in columns])


def label_counts(df: DataFrame, keys: Sequence[str] = ("tp", "fp", "rf_train", "rf_label", "rf_prediction")) -> DataFrame:
    return df.groupBy(*[k for k in keys if k in df.columns]).agg(F.count("*").alias("n"))


def truth_labels(df: DataFrame, sets: Sequence[str] = ("omni", "mills", "kgp_phase1_hc", "hapmap")) -> DataFrame:
    """tp: in any truth set (null if in none); fp: fails the hard filters."""
    tp = F.col(sets[0])
    for s in sets[1:]:
        tp = tp | F.col(s)
    return df.withColumn("tp", tp).withColumn("fp", F.col("fail_hard_filters"))


def training_rows(df: DataFrame, fp_to_tp: float = 1.0, test_intervals: str | Sequence[str] | None = "chr20", seed: int = 42) -> DataFrame:
    """Adds rf_label (TP, FP or null) and rf_train: rows of one class only, the larger class thinned to the ratio,
    nothing inside the test intervals. Thinning is by a hash of the variant, so it does not depend on partitions."""
    tp, fp = F.coalesce("tp", F.lit(False)), F.coalesce("fp", F.lit(False))
    df = df.withColumn("rf_label", F.when(tp & ~fp, "TP").when(fp & ~tp, "FP"))
    outside = ~F.coalesce(in_intervals(list([test_intervals] if isinstance(test_intervals, str) else test_intervals or [])), F.lit(False))
    n = {r["rf_label"]: r["n"] for r in df.where(outside & F.col("rf_label").isNotNull()).groupBy("rf_label").agg(F.count("*").alias("n")).collect()}
    n_tp, n_fp = n.get("TP", 0), n.get("FP", 0)
    share = {"TP": 1.0, "FP": 1.0}
    if fp_to_tp > 0 and n_tp and n_fp:
        want = fp_to_tp * n_tp
        share = {"TP": min(1.0, n_fp / want), "FP": min(1.0, want / n_fp)}
    luck = lot("vid", seed)
    drawn = F.when(F.col("rf_label") == "TP", luck < share["TP"]).when(F.col("rf_label") == "FP", luck < share["FP"])
    return df.withColumn("rf_train", F.coalesce(outside & drawn, F.lit(False)))


def forest(features: Sequence[str], categorical: Sequence[str], label: str, trees: int, depth: int, seed: int) -> Pipeline:
    index = StringIndexer(inputCols=list(categorical), outputCols=[f"{c}_i" for c in categorical], handleInvalid="keep") if categorical else None
    target = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="keep")
    vector = VectorAssembler(inputCols=[f"{f}_i" if f in categorical else f for f in features], outputCol="_features", handleInvalid="error")
    rf = RandomForestClassifier(featuresCol="_features", labelCol="_label", predictionCol="_p", probabilityCol="_prob", rawPredictionCol="_raw", numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[*([index] if index else []), target, vector, rf])


def train(df: DataFrame, features: Sequence[str], categorical: Sequence[str] = (), trees: int = 500, depth: int = 5, seed: int = 42) -> PipelineModel:
    ready = df.where("rf_train").withColumns({f: F.col(f).cast("double") for f in features if f not in categorical})
    return forest(features, categorical, "rf_label", trees, depth, seed).fit(ready)


def labels_of(model: PipelineModel, column: str = "_label") -> list[str]:
    return next(s for s in model.stages if getattr(s, "labels", None) is not None and s.getOutputCol() == column).labels


def importance(model: PipelineModel) -> dict[str, float]:
    names = model.stages[-2].getInputCols()
    return {n.removesuffix("_i"): float(v) for n, v in zip(names, model.stages[-1].featureImportances.toArray(), strict=True)}


def apply(model: PipelineModel, df: DataFrame, features: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """Adds rf_probability (map of label to probability), rf_prediction and score = 1 - P(TP)."""
    labels = labels_of(model)
    ready = df.withColumn("rf_label", F.col("rf_label") if "rf_label" in df.columns else F.lit(None).cast("string"))
    scored = model.transform(ready.withColumns({f"_r_{f}": F.col(f) for f in features}).withColumns({f: F.col(f).cast("double") for f in features if f not in categorical}))
    prob = vector_to_array("_prob")
    names = F.array(*[F.lit(x) for x in labels])
    p = F.map_from_arrays(names, F.slice(prob, 1, len(labels)))
    best = F.array_max(F.transform(names, lambda x: F.struct(F.element_at(p, x).alias("p"), x.alias("l"))))
    own = ("score", "rf_probability", "rf_prediction")
    keep = [F.col(f"_r_{c}").alias(c) if c in features else F.col(c) for c in ready.columns if c not in own]
    return scored.select(*keep, p.alias("rf_probability"), best["l"].alias("rf_prediction"), (1 - F.element_at(p, "TP")).alias("score") if "TP" in labels else F.lit(None).cast("double").alias("score"))


def accuracy(df: DataFrame, label: str = "rf_label", prediction: str = "rf_prediction") -> DataFrame:
    per = df.where(F.col(label).isNotNull()).groupBy(label, prediction).agg(F.count("*").alias("n"))
    return per.agg(F.try_divide(F.sum(F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0)).cast("double"), F.sum("n").cast("double")).alias("test_accuracy"))


def assign_populations(scores: DataFrame, trees: int = 100, share: float = 0.8, min_prob: float = 0.5, seed: int = 42) -> DataFrame:
    """(sid, known_pop, pop, probability): populations by a forest on the principal components, trained on a seeded share
    of the samples whose population is known; below ``min_prob`` the population is 'oth'."""
    s = scores.withColumn("_features", array_to_vector("scores"))
    luck = lot("sid", seed)
    known = s.where("known_pop is not null")
    index = StringIndexer(inputCol="known_pop", outputCol="_label", stringOrderType="alphabetAsc").fit(known)
    rf = RandomForestClassifier(featuresCol="_features", labelCol="_label", probabilityCol="_prob", numTrees=trees, seed=seed)
    fitted = rf.fit(index.transform(known).where(luck < share))
    names = F.array(*[F.lit(x) for x in index.labels])
    out = fitted.transform(s).withColumn("_p", vector_to_array("_prob"))
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(len(index.labels) - 1)), lambda i: F.struct(F.get("_p", i).alias("p"), F.get(names, i).alias("l"))))
    return out.select("sid", "known_pop", best.alias("b")).select("sid", "known_pop", F.when(F.col("b.p") >= min_prob, F.col("b.l")).otherwise("oth").alias("pop"), F.col("b.p").alias("probability"))
