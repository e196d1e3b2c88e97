"""Running ranks, bins and what is counted per bin.

A rank is an exclusive prefix count over a total order. Two groups (SNVs and indels) would put all rows of a
large table into two window partitions, so the order is established by range partitioning on (group, order):
each partition counts its own prefix, and the partitions' totals, one short row each, give the offsets.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from cohortqc.functions import genetics as G
from cohortqc.session import materialize

#: Rows that one partition of the order should hold.
ROWS = 2_000_000


def prefix_counts(df: DataFrame, group: str, order: Sequence[str], flags: Mapping[str, Column | str], rows: int = ROWS) -> DataFrame:
    """Adds, per name in ``flags``, the number of earlier rows of the same group whose flag is true.

    Earlier is by ``order``, which must be total within a group. Rows of a null group count among themselves.
    """
    names = list(flags)
    marked = df.select("*", *[F.coalesce(F.expr(c) if isinstance(c, str) else c, F.lit(False)).alias(f"_f_{n}") for n, c in flags.items()])
    parts = max(1, -(-df.count() // rows))
    if parts == 1:
        marked = marked.repartition(1)
    else:
        marked = marked.repartitionByRange(parts, group, *order)
    marked = marked.sortWithinPartitions(group, *order)
    columns = df.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: dict[object, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(group).to_pylist()
            hits = np.stack([np.asarray(batch.column(f"_f_{n}").to_numpy(zero_copy_only=False), np.int64) for n in names], 1)
            cuts = [0, *[k for k in range(1, len(keys)) if keys[k] != keys[k - 1]], len(keys)]
            before = np.empty_like(hits)
            for a, b in zip(cuts, cuts[1:], strict=False):
                start = seen.get(keys[a], np.zeros(len(names), np.int64))
                run = np.cumsum(hits[a:b], 0)
                before[a:b] = start + run - hits[a:b]
                seen[keys[a]] = start + run[-1]
            out = [batch.column(c) for c in columns] + [pa.array(hits[:, k]) for k in range(len(names))] + [pa.array(before[:, k]) for k in range(len(names))] + [pa.array([part] * batch.num_rows, pa.int32())]
            yield pa.RecordBatch.from_arrays(out, [*columns, *[f"_f_{n}" for n in names], *names, "_part"])

    schema = T.StructType([*df.schema.fields, *[T.StructField(f"_f_{n}", T.LongType()) for n in names], *[T.StructField(n, T.LongType()) for n in names], T.StructField("_part", T.IntegerType())])
    local = marked.mapInArrow(count, schema)
    if parts == 1:
        return local.select(*df.columns, *names)
    local = materialize(local)
    totals = local.groupBy("_part", group).agg(*[F.sum(f"_f_{n}").alias(f"_t_{n}") for n in names])
    earlier = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("_part", F.col(group).alias("_g"), *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in names])
    joined = local.join(F.broadcast(offsets), (local["_part"] == offsets["_part"]) & local[group].eqNullSafe(offsets["_g"]))  # a row per partition and group
    return joined.select(*df.columns, *[(F.col(n) + F.col(f"_o_{n}")).alias(n) for n in names])


def subrank_flags(with_trios: bool = True, high: float = 0.9, medium: float = 0.5) -> dict[str, str]:
    """The sub-ranks' conditions; those that need a pedigree are never met without one."""
    flags = {
        "singleton_rank": "transmitted_singleton",
        "biallelic_rank": "not was_split",
        "biallelic_singleton_rank": "not was_split and transmitted_singleton",
        "de_novo_high_quality_rank": f"p_de_novo > {high}",
        "de_novo_medium_quality_rank": f"p_de_novo > {medium}",
        "de_novo_synonymous_rank": "consequence = 'synonymous_variant'",
    }
    if not with_trios:
        flags |= dict.fromkeys(("singleton_rank", "biallelic_singleton_rank", "de_novo_high_quality_rank", "de_novo_medium_quality_rank"), "false")
    return flags


def add_ranks(variants: DataFrame, score: str = "score", subranks: Mapping[str, str] | None = None, order: Sequence[str] = ("vid",)) -> DataFrame:
    """``rank`` and sub-ranks from 0 by ascending score, SNVs apart from all others; ties by ``order``.

    A sub-rank counts the rows that meet its condition and is null on the others.
    """
    subranks = subranks or {}
    df = variants.withColumn("is_snv", G.is_snp())
    ranked = prefix_counts(df, "is_snv", [score, *order], {"rank": "true", **subranks})
    for name, cond in subranks.items():
        ranked = ranked.withColumn(name, F.when(F.expr(cond), F.col(name)))
    return ranked


def rank_counts(ranked: DataFrame, names: Sequence[str]) -> DataFrame:
    """(rank_id, is_snv, n) of the rows that have the rank; a kind without any has 0."""
    kinds = [F.count_if(F.col(n).isNotNull() & (F.col("is_snv") == snv)).alias(f"{n}__{int(snv)}") for n in names for snv in (True, False)]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rank_id"), F.lit(snv).alias("is_snv"), F.col(f"{n}__{int(snv)}").alias("n")) for n in names for snv in (True, False)])).alias("c")
    return ranked.agg(*kinds).select(each).select("c.*")


def bin_of(rank: Column, n: Column, bins: int = 100) -> Column:
    """ceil((rank + 1) / floor(n / bins)); the last bins can exceed ``bins``; null if there are fewer rows than bins."""
    return F.ceil((rank + 1).cast("double") / F.nullif(F.floor(n.cast("double") / bins), F.lit(0)).cast("double")).cast("int")


def binned(ranked: DataFrame, names: Sequence[str], bins: int = 100) -> DataFrame:
    """One row per variant and rank it has, with rank_id and bin. The counts are one row per rank and kind."""
    counts = F.broadcast(rank_counts(ranked, names))
    ranks = F.explode(F.array(*[F.struct(F.lit(n).alias("rank_id"), F.col(n).alias("_rank")) for n in names])).alias("r")
    long_ = ranked.select("*", ranks).select(*ranked.columns, "r.rank_id", "r._rank").where("_rank is not null")
    return long_.join(counts, ["rank_id", "is_snv"]).withColumn("bin", bin_of(F.col("_rank"), F.col("n"), bins)).drop("n", "_rank").where("bin is not null")


BIN_KEYS = ("rank_id", "contig", "snv", "bi_allelic", "singleton", "trans_singletons", "de_novo_high_quality", "de_novo_medium_quality", "de_novo_synonymous", "bin")


def bin_measures(high: float = 0.99, medium: float = 0.5, common_af: float = 0.1) -> dict[str, Column]:
    """The 34 measures of a bin, over flat columns: t, u (transmitted, untransmitted), mendel_errors, unrelated_ac,
    p_de_novo, confidence, af, trans_singletons, untrans_singletons, the truth sets and fail_hard_filters."""
    c, n = F.col, F.count_if
    syn = c("consequence") == "synonymous_variant"
    single = (c("ac_raw") < 3) & (c("unrelated_ac") == 1)
    total = lambda v, cond: F.coalesce(F.sum(F.when(cond, c(v))), F.lit(0)).cast("long")
    return {
        "min_score": F.min("score"), "max_score": F.max("score"), "n": F.count("*"),
        "n_ins": n(G.is_insertion()), "n_del": n(G.is_deletion()), "n_ti": n(G.is_transition()), "n_tv": n(G.is_transversion()),
        "n_1bp_indel": n(G.indel_length() == 1), "n_mod3bp_indel": n(G.indel_length() % 3 == 0), "n_singleton": n(c("transmitted_singleton")),
        "n_high_quality_de_novos": n(c("p_de_novo") > high), "n_medium_quality_de_novos": n(c("p_de_novo") > medium), "n_high_confidence_de_novos": n(c("confidence") == "HIGH"),
        "n_de_novo": total("mendel_errors", c("unrelated_ac") == 0), "n_high_quality_de_novos_synonymous": n((c("p_de_novo") > high) & syn),
        "n_trans_singletons_synonymous_algorithm": n(c("variant_transmitted_singletons") == 1), "n_untrans_singletons_synonymous_algorithm": n(c("variant_untransmitted_singletons") == 1),
        "n_de_novo_sites": n((c("unrelated_ac") == 0) & (c("mendel_errors") > 0)),
        "n_trans_singletons": total("t", single), "n_untrans_singletons": total("u", single),
        "n_trans_singletons_synonymous": total("t", single & syn), "n_untrans_singletons_synonymous": total("u", single & syn),
        "n_train_trans_singletons": n((c("unrelated_ac") == 1) & (c("t") == 1)),
        "n_trans_common": total("t", c("population_af") >= common_af), "n_untrans_common": total("u", c("population_af") >= common_af),
        "n_trans_singletons_synonymous_tdt": n(syn & (c("t") == 1) & (c("u") == 0)), "n_untrans_singletons_synonymous_tdt": n(syn & (c("t") == 0) & (c("u") == 1)),
        "n_omni": n(c("omni")), "n_mills": n(c("mills")), "n_hapmap": n(c("hapmap")), "n_kgp_high_conf_snvs": n(c("kgp_phase1_hc")),
        "fail_hard_filters": n(c("fail_hard_filters")), "fail_hard_filters_snvs": n(c("fail_hard_filters") & G.is_snp()), "fail_hard_filters_indels": n(c("fail_hard_filters") & G.is_indel()),
    }


def bin_aggregate(bins: DataFrame, **limits: float) -> DataFrame:
    """All measures per the ten keys. A measure whose column is not there (no pedigree, no truth set) is 0."""
    needed = {
        "t": "long", "u": "long", "mendel_errors": "long", "unrelated_ac": "long", "p_de_novo": "double", "confidence": "string", "population_af": "double", "ac_raw": "long",
        "variant_transmitted_singletons": "long", "variant_untransmitted_singletons": "long", "omni": "boolean", "mills": "boolean", "hapmap": "boolean", "kgp_phase1_hc": "boolean",
        "fail_hard_filters": "boolean", "biallelic_rank": "long", "singleton_rank": "long", "de_novo_high_quality_rank": "long", "de_novo_medium_quality_rank": "long", "de_novo_synonymous_rank": "long",
    }
    have = bins.withColumns({c: F.lit(None).cast(t) for c, t in needed.items() if c not in bins.columns})
    has = lambda r: F.col(r).isNotNull()
    keyed = have.withColumns(
        {
            "snv": G.is_snp(), "bi_allelic": has("biallelic_rank"), "singleton": F.col("transmitted_singleton"), "trans_singletons": has("singleton_rank"),
            "de_novo_high_quality": has("de_novo_high_quality_rank"), "de_novo_medium_quality": has("de_novo_medium_quality_rank"), "de_novo_synonymous": has("de_novo_synonymous_rank"),
        }
    )
    return keyed.groupBy(*BIN_KEYS).agg(*[m.alias(n) for n, m in bin_measures(**limits).items()])


def coarser(binned_counts: DataFrame, drop: Sequence[str] = ("contig", "de_novo_high_quality")) -> DataFrame:
    """The counts without some keys: scores by min and max, all else added up."""
    keys = [k for k in BIN_KEYS if k not in drop]
    sums = [c for c in binned_counts.columns if c not in BIN_KEYS and c not in ("min_score", "max_score")]
    return binned_counts.groupBy(*keys).agg(F.min("min_score").alias("min_score"), F.max("max_score").alias("max_score"), *[F.sum(c).alias(c) for c in sums])


def cumulative(df: DataFrame, model: str, bin_: str, columns: Sequence[str]) -> DataFrame:
    """Sums per model and bin, and their running totals over the bins (about a hundred rows per model)."""
    per = df.groupBy(model, bin_).agg(*[F.sum(c).alias(c) for c in columns])
    run = W.partitionBy(model).orderBy(bin_).rowsBetween(W.unboundedPreceding, 0)
    return per.select("*", *[F.sum(c).over(run).alias(f"{c}_cumul") for c in columns])


def ratio_curve(df: DataFrame, model: str, bin_: str, numerator: str, denominator: str) -> DataFrame:
    c = cumulative(df, model, bin_, [numerator, denominator])
    d = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    return c.select(model, bin_, d(numerator, denominator).alias("non_cumul"), d(f"{numerator}_cumul", f"{denominator}_cumul").alias("cumul"))


def threshold_range(threshold: int) -> list[int]:
    """Three bins on either side and five beyond, within 1 to 101."""
    return [t for t in (threshold - 8, *range(threshold - 3, threshold + 4), threshold + 8) if 1 <= t <= 101]


def threshold_sweep(bins: DataFrame, thresholds: Sequence[int]) -> DataFrame:
    """(threshold, tp_pc, fp_pc): the percentages of true and false positives that each threshold keeps, in one pass."""
    counts = [F.count_if(F.col(k)).alias(k) for k in ("tp", "fp")]
    counts += [F.count_if(F.col(k) & (F.col("bin") <= t)).alias(f"{k}_{t}") for k in ("tp", "fp") for t in thresholds]
    pc = lambda k, t: F.try_divide(100.0 * F.col(f"{k}_{t}"), F.col(k).cast("double")).alias(f"{k}_pc")
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), pc("tp", t), pc("fp", t)) for t in thresholds])).alias("r")
    return bins.agg(*counts).select(rows).select("r.*")
