"""The stages of a cohort's quality control as functions over tables.

Each step takes DataFrames (and the thresholds of its configuration section) and returns DataFrames; reading and
writing files is left to the caller or to run_step, so that steps can be joined into one plan or run one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortqc.functions import genetics as G
from cohortqc.operators import aggregates as A
from cohortqc.operators import family, filters, grid, joins, model, ranks, split, structure, tiers
from cohortqc.sources import sinks
from cohortqc.sources.text import trios_of


# ---- 0: resources -------------------------------------------------------------------------------------------------------
def truth_set(hapmap: DataFrame, omni: DataFrame, kgp: DataFrame, mills: DataFrame) -> DataFrame:
    return joins.flag_sets({"hapmap": hapmap, "omni": omni, "kgp_phase1_hc": kgp, "mills": mills}, ["contig", "pos", "alleles"])


def frequency_table(frequencies: DataFrame) -> DataFrame:
    """Only the first two strata (high quality and raw) of an array of frequencies."""
    return frequencies.select("contig", "pos", "alleles", F.slice("freq", 1, 2).alias("freq"))


def reference_cohort(entries: DataFrame, variants: DataFrame, long_range: DataFrame, min_kin: float = 0.125, r2: float = 0.2, **thresholds: float) -> tuple[DataFrame, DataFrame]:
    """Pruned entries of a reference cohort without related samples, and the samples removed."""
    n = entries.select("sid").distinct().count()
    kept = filters.ld_prune_candidates(variants, A.variant_qc(entries, n), long_range, **thresholds)
    pruned = structure.ld_prune(entries.join(kept.select("vid"), "vid", "left_semi"), kept, r2=r2)
    some = entries.join(pruned.select("vid"), "vid", "left_semi")
    related = structure.pc_relate(some, structure.pca(some, 10)[0], min_kin).select(F.col("i").cast("string").alias("i"), F.col("j").cast("string").alias("j"), "kin")
    removed = structure.unrelated_samples(related, min_kin).where("not kept").select(F.col("s").alias("sid"))
    return some.join(removed, some["sid"].cast("string") == removed["sid"], "left_anti"), removed


# ---- 1: import ----------------------------------------------------------------------------------------------------------
def annotate_samples(samples: DataFrame, sex: DataFrame | None = None, contamination: DataFrame | None = None, max_freemix: float = 0.05) -> tuple[DataFrame, DataFrame | None]:
    """Samples with self-reported sex and contamination, and the contaminated ones."""
    if sex is not None:
        samples = joins.annotate(samples, joins.first_of(sex, ["s"], ["self_reported_sex"]), ["s"], ["self_reported_sex"])
    if contamination is None:
        return samples, None
    samples = joins.annotate(samples, joins.first_of(contamination.select("s", "freemix"), ["s"], ["freemix"]), ["s"], ["freemix"])
    return samples, filters.contaminated(samples, max_freemix)


# ---- 2: samples ---------------------------------------------------------------------------------------------------------
def sex_check(entries: DataFrame, variants: DataFrame, samples: DataFrame, **params: float) -> tuple[DataFrame, DataFrame | None]:
    n = samples.count()
    kept = filters.sex_check_variants(variants, A.variant_counts(entries, n))
    sexed = joins.annotate(samples, structure.impute_sex(entries, kept, **params), ["sid"], ["f_stat", "is_female", "imputed_sex"])
    return sexed, filters.sex_conflicts(sexed)


def populations(study: DataFrame, reference: DataFrame, known: DataFrame, k: int = 10, **params: Any) -> DataFrame:
    """Components from the reference, the study projected onto them, and a population for every sample."""
    common = joins.union_cols(study, reference)
    ref = common.join(known.select("sid"), "sid", "left_semi")
    scores, _, loadings = structure.pca(ref, k)
    placed = structure.pc_project(common.join(known.select("sid"), "sid", "left_anti"), loadings)
    both = scores.withColumn("sid", F.col("sid").cast("string")).unionByName(placed.withColumn("sid", F.col("sid").cast("string")))
    return model.assign_populations(both.join(known.select(F.col("sid").cast("string").alias("sid"), "known_pop"), "sid", "left"), **params)


METRICS = ("heterozygosity_rate", "n_snp", "r_ti_tv", "n_transition", "n_transversion", "r_insertion_deletion", "n_insertion", "n_deletion", "r_het_hom_var")


def sample_outliers(entries: DataFrame, variants: DataFrame, populations_: DataFrame, dp: float = 0, gq: float = 0, vaf: float = 0, n_mad: float = 4.0, metrics: Sequence[str] = METRICS) -> DataFrame:
    auto = entries.join(filters.autosomes(variants).select("vid"), "vid", "left_semi")
    qc = A.sample_qc(filters.strict_genotypes(auto, dp, gq, vaf), variants).join(populations_.select("sid", "pop"), "sid")
    return A.pass_fail(A.mad_outliers(qc, "pop", metrics, n_mad))


def remove_failed(entries: DataFrame, status: DataFrame, explicit: DataFrame | None = None) -> DataFrame:
    kept = entries.join(status.where("status = 'Pass'").select("sid"), "sid", "left_semi")
    return kept if explicit is None else kept.join(explicit.select("sid"), "sid", "left_anti")


# ---- 3: variants --------------------------------------------------------------------------------------------------------
def split_cohort(sites: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Biallelic rows and entries (gt as number of alternative alleles, sum_ad from before the split); variants without
    a non-reference call are left out."""
    before = entries.withColumn("sum_ad", F.aggregate("ad", F.lit(0), lambda a, x: a + x))
    rows = split.split_sites(sites)
    e = split.split_entries(before, rows)
    e = e.withColumn("ad_alt", F.get("ad", F.lit(1))).withColumn("gt", G.n_alt("gt"))
    e = e.withColumn("het_ab", G.het_ab("gt", "ad_alt", "sum_ad"))
    seen = e.groupBy("site", "a_index").agg(F.count_if(F.col("gt") > 0).alias("n_non_ref"), F.avg("het_ab").alias("mean_het_ab")).where("n_non_ref > 0")
    return rows.join(seen.drop("n_non_ref"), ["site", "a_index"]), e.join(seen.select("site", "a_index"), ["site", "a_index"], "left_semi")


def family_tables(entries: DataFrame, pedigree: DataFrame, variants: DataFrame | None = None) -> dict[str, DataFrame]:
    """``variants`` (vid, contig, pos): for the sex chromosomes, of which sons have one copy."""
    trios = trios_of(pedigree)
    trio = joins.trio_entries(entries, trios, ("gt", "gq", "dp", "ad_alt"))
    errors = family.mendel_errors(trio if variants is None else family.with_haploid(trio, variants, trios))
    children = pedigree.select(F.col("s").alias("sid"))
    unrelated = A.call_stats(entries.join(children, "sid", "left_anti"))  # whoever is listed as a child is related
    return {"trio_stats": family.trio_stats(trio), "mendel": family.mendel_per_variant(errors), "tdt": family.tdt(trio), "unrelated": unrelated}


def forest_features(variants: DataFrame, tables: Mapping[str, DataFrame], features: Sequence[str], stratum: str = "variant_type", with_pedigree: bool = True) -> DataFrame:
    """Features of each variant from its side tables (later tables override), hard-filter flag, labels and filled gaps."""
    v = variants
    for t in tables.values():
        new = [c for c in t.columns if c != "vid"]
        v = v.drop(*[c for c in new if c in v.columns]).join(t, "vid", "left")
    v = v.withColumn("fail_hard_filters", F.coalesce(filters.fail_hard_filters(), F.lit(False)))
    single = (F.col("n_transmitted_raw") == 1) & (F.col("ac_raw") == 2) if with_pedigree else F.lit(False)
    v = model.truth_labels(v.withColumn("transmitted_singleton", F.coalesce(single, F.lit(False))))
    numeric = [c for c in features if dict(v.dtypes)[c] in ("double", "float", "int", "bigint")]
    return model.median_impute(v, stratum, numeric)


def train_forest(features_: DataFrame, features: Sequence[str], categorical: Sequence[str], runs_json: str, model_dir: str, model_id: str, **params: Any) -> DataFrame:
    """Trains, saves the model, applies it and adds the run with its importance and test accuracy to the registry."""
    rows = model.training_rows(features_)
    fitted = model.train(rows, features, categorical, **params)
    fitted.write().overwrite().save(sinks.model_path(model_dir, "model", model_id))
    scored = model.apply(fitted, rows, features, categorical)
    test = model.accuracy(scored.where("not rf_train and rf_label is not null")).first()[0]
    sinks.add_run(runs_json, model_id, {"features_importance": model.importance(fitted), "test_accuracy": test, "params": {k: v for k, v in params.items()}})
    return scored


def rank_and_bin(scored: DataFrame, with_pedigree: bool, truth: DataFrame | None = None, bins: int = 100, high: float = 0.9, medium: float = 0.5, **limits: float) -> tuple[DataFrame, DataFrame]:
    """The exploded table of ranks and the aggregate per bin. ``limits``: those of ranks.bin_measures."""
    flags = ranks.subrank_flags(with_pedigree, high, medium)
    if "p_de_novo" not in scored.columns:
        scored = scored.withColumn("p_de_novo", F.lit(None).cast("double"))
    ranked = ranks.add_ranks(scored, "score", flags)
    if truth is not None:
        ranked = joins.annotate(ranked, truth, ["vid"], [c for c in truth.columns if c != "vid"])
    long_ = ranks.binned(ranked, ["rank", *flags], bins)
    return long_, ranks.bin_aggregate(long_, **limits)


def filter_variants(entries: DataFrame, variants: DataFrame, ranked: DataFrame, snv_bin: int, indel_bin: int) -> tuple[DataFrame, DataFrame]:
    binned = ranked.where("rank_id = 'rank'").select("vid", F.col("bin").alias("rf_bin"), F.col("score").alias("rf_score"))
    kept = filters.rf_bin_filter(variants.drop("rf_bin", "rf_score").join(binned, "vid", "left"), snv_bin, indel_bin)
    return kept, entries.join(kept.select("vid"), "vid", "left_semi")


# ---- 4: genotypes -------------------------------------------------------------------------------------------------------
def control_set(sites: DataFrame, entries: DataFrame, consequences: DataFrame, panel: DataFrame | None = None) -> DataFrame:
    """Non-reference autosomal variants of a control sample with their consequence, inside the panel."""
    rows, _ = split_cohort(sites, entries)
    c = rows.where(G.in_autosome())
    c = c.join(consequences.select("contig", "pos", "alleles", "consequence").dropDuplicates(["contig", "pos", "alleles"]), ["contig", "pos", "alleles"], "left")
    return c if panel is None else joins.interval_semi(c, panel)


def evaluate_grid(entries: DataFrame, variants: DataFrame, g: DataFrame, n_samples: int, kind: str, trios: DataFrame | None = None, control: DataFrame | None = None, control_sample: int | None = None) -> DataFrame:
    """One row of metrics per grid point; -1 (-2 for the transmission ratio) where a metric cannot be had."""
    if kind not in ("snv", "indel"):
        raise ValueError(f"unknown kind of variants: {kind}")
    if control is not None and control_sample is not None and not entries.where(F.col("sid") == control_sample).limit(1).count():
        raise ValueError("the control sample is not in the cohort")
    v = variants.where(G.is_snp() if kind == "snv" else G.is_indel())
    e = entries.join(v.select("vid"), "vid", "left_semi")
    kept = grid.surviving(e, v, g, n_samples)
    out = grid.tp_fp(kept, v, g)
    missing = lambda names, value: out.withColumns({n: F.lit(value) for n in names})
    out = out.join(grid.mendel(e, trios, kept, g, v), "point", "left") if trios is not None else missing(["mendelian_error_mean", "mendelian_error_std"], -1.0)
    out = out.join(grid.transmission(e, trios, v, kept, g), "point", "left") if trios is not None and kind == "snv" else missing(["t_u_ratio"], -2.0)
    if control is None or control_sample is None:
        return grid.filter_metrics(missing(["prec", "recall"], -1.0), v)
    of_kind = control.join(v.select("vid"), "vid", "left_semi")
    out = out.join(grid.grid_precision_recall(e, kept, of_kind, control_sample, g), "point", "left")
    if kind == "indel":
        for name, terms in (("frameshift", ["frameshift_variant"]), ("inframe", ["inframe_deletion", "inframe_insertion"])):
            ids = v.where(F.col("consequence").isin(*terms)).select("vid")
            part = grid.grid_precision_recall(e.join(ids, "vid", "left_semi"), kept, of_kind.join(ids, "vid", "left_semi"), control_sample, g)
            out = out.join(part.withColumnsRenamed({"prec": f"prec_{name}", "recall": f"recall_{name}"}), "point", "left")
    return grid.filter_metrics(out, v)


def tiered(entries: DataFrame, variants: DataFrame, n_samples: int, limits: Mapping = tiers.EXAMPLE) -> tuple[DataFrame, DataFrame]:
    """Entries with their tags, and variants with the counts per tier."""
    tagged = tiers.retag(tiers.tag(entries, variants, limits), n_samples, limits)
    return tagged, variants.join(tiers.annotate(tagged, n_samples), "vid", "left")


STEPS: dict[str, Callable] = {
    f.__name__: f
    for f in (truth_set, frequency_table, reference_cohort, annotate_samples, sex_check, populations, sample_outliers, remove_failed, split_cohort, family_tables, forest_features, train_forest, rank_and_bin, filter_variants, control_set, evaluate_grid, tiered)
}


def run_step(spark, config: Mapping, name: str) -> Any:
    """Runs one step as its section of the configuration says: ``inputs`` (argument: Parquet path), ``params`` and
    ``outputs`` (a path, or one per table that the step returns)."""
    section = config["steps"][name]
    inputs = {k: spark.read.parquet(p) for k, p in section.get("inputs", {}).items()}
    result = STEPS[section.get("step", name)](**inputs, **section.get("params", {}))
    outputs = section.get("outputs", [])
    tables = list(result.values()) if isinstance(result, dict) else list(result) if isinstance(result, tuple) else [result]
    for path, table in zip([outputs] if isinstance(outputs, str) else outputs, tables, strict=False):
        if table is not None and path:
            sinks.write_table(table, path)
    return result
