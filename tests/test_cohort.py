"""Unit cases of filters, joins, families, splitting, ranks, identity and kernels."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortqc.functions import genetics as G
from cohortqc.operators import aggregates as A
from cohortqc.operators import family, filters, grid, identity, joins, model, ranks, split, structure, tiers
from tests.util import rows


def variants(spark, data):
    return spark.createDataFrame([(k, *d) for k, d in enumerate(data)], "vid long, contig string, pos int, alleles array<string>")


def test_duplicates(spark):
    none = variants(spark, [("1", 1000, ["A", "T"]), ("2", 2000, ["G", "C"]), ("3", 3000, ["G", "A"])])
    assert A.duplicates(none, ["contig", "pos", "alleles"]).count() == 0
    multi = variants(spark, [("1", 1000, ["A", "T", "G"]), ("1", 1000, ["A", "T", "G"]), ("1", 1000, ["A", "T"])])
    assert rows(A.duplicates(multi, ["contig", "pos", "alleles"]), "count") == [(2,)]
    several = variants(spark, [("1", 1, ["A", "T"])] * 3 + [("2", 2, ["G", "C"])] * 2 + [("3", 3, ["G", "A"])])
    assert rows(A.duplicates(several, ["contig", "pos", "alleles"]), "count") == [(2,), (3,)]
    samples = spark.createDataFrame([("sample_dup" if k % 2 else f"s{k}",) for k in range(10)], "s string")
    assert rows(A.duplicates(samples, ["s"])) == [("sample_dup", 5)]


def test_intervals_small_and_tiled(spark, monkeypatch):
    loci = spark.createDataFrame([("chr1", 500), ("chr1", 501), ("chr1", 1000), ("chr1", 1500), ("chr1", 1501), ("chr1", 2000), ("chr2", 3000)], "contig string, pos int")
    bed = spark.createDataFrame([("chr1", 500, 1500), ("chr2", 2500, 3500), ("chr1", 700, 1200), ("chr3", 5, 5)], "contig string, start long, stop long")
    want = [("chr1", 1000), ("chr1", 1500), ("chr1", 501), ("chr2", 3000)]
    for limit in (joins.BROADCAST_INTERVALS, 0):
        monkeypatch.setattr(joins, "BROADCAST_INTERVALS", limit)
        monkeypatch.setattr(joins, "TILE", 100)
        assert rows(joins.interval_semi(loci, bed)) == want
        assert joins.interval_semi(loci, bed).count() + joins.interval_anti(loci, bed).count() == 7
        assert joins.interval_semi(loci, bed.where("contig = 'chr3'")).count() == 0


def test_allele_functions(spark):
    cases = [("A", "G", "snv", True), ("C", "A", "snv", False), ("A", "ATA", "ins", None), ("ATAT", "A", "del", None), ("A", "*", "star", None), ("AC", "GT", "complex", None), ("AC", "AT", "snv", None), ("A", "CTA", "complex", None)]
    df = spark.createDataFrame([(a, b) for a, b, *_ in cases], "ref string, alt string")
    got = {(r[0], r[1]): (r[2], r[3]) for r in df.select("ref", "alt", G.allele_type(), G.is_transition()).collect()}
    for a, b, kind, ti in cases:
        assert got[a, b][0] == kind
        if ti is not None:
            assert got[a, b][1] is ti
    kinds = spark.createDataFrame([(["A", "T"],), (["A", "T", "G"],), (["A", "AT"],), (["A", "AT", "ATT"],), (["A", "T", "AT"],), (["A", "T", "*"],)], "a array<string>")
    assert [r[0] for r in kinds.select(G.variant_type("a")).collect()] == ["snv", "multi-snv", "indel", "multi-indel", "mixed", "snv"]
    c = spark.createDataFrame([("chr1",), ("22",), ("X",), ("chrM",), ("chr23",), (None,)], "contig string")
    assert [r[0] for r in c.select(G.contig_idx()).collect()] == [1, 22, 23, 25, None, None]


def test_unknown_values_never_pass(spark):
    e = spark.createDataFrame([(1, 1, 20, 5, 30, 1), (1, 2, None, 5, 30, 0), (1, 3, 20, None, 30, 1), (1, 4, 20, 10, None, 2), (1, 5, 20, 0, 30, None)], "vid long, sid int, dp int, ad_alt int, gq int, gt int")
    assert rows(e.where(filters.passes(10, 20, 0.2)), "sid") == [(1,)]
    assert filters.strict_genotypes(e, 10, 20, 0.2).count() == 1
    assert filters.strict_genotypes(e).count() == 5
    tagged = tiers.tag(e, spark.createDataFrame([(1, 1, "A", "G")], "vid long, rf_bin int, ref string, alt string"))
    assert {r["sid"]: r["relaxed_filters"] for r in tagged.collect()} == {1: "Pass", 2: None, 3: None, 4: None, 5: None}


def test_mendel(spark):
    # eight possible and two impossible combinations (father, mother, child)
    calls = [(0, 0, 0), (0, 1, 0), (0, 1, 1), (1, 1, 2), (1, 1, 0), (2, 2, 2), (0, 2, 1), (2, 1, 1), (0, 0, 1), (0, 0, 2)]
    e = spark.createDataFrame([(v, s, g[i]) for v, g in enumerate(calls) for i, s in ((0, 2), (1, 3), (2, 1))], "vid long, sid int, gt int")
    trios = spark.createDataFrame([("F", 1, 2, 3)], "fam_id string, kid int, dad int, mom int")
    trio = joins.trio_entries(e, trios)
    r = family.proband_error_rate(trio, trios, len(calls)).first()
    assert abs(r["mendelian_error_mean"] - 0.2) < 1e-9 and r["mendelian_error_std"] == 0
    assert rows(family.mendel_per_variant(family.mendel_errors(trio))) == [(8, 1), (9, 1)]
    codes = {r["vid"]: r["mendel_code"] for r in family.mendel_errors(trio).collect()}
    assert codes == {8: 2, 9: 5}


TABLE = [(0, 1, 1, 0, 2), (0, 0, 1, 0, 1), (0, 1, 0, 0, 1), (1, 1, 1, 1, 1), (1, 0, 1, 1, 0), (1, 1, 0, 1, 0), (1, 2, 1, 0, 1), (1, 1, 2, 0, 1), (2, 1, 1, 2, 0), (2, 1, 2, 1, 0), (2, 2, 1, 1, 0)]


def test_transmission_table(spark):
    df = spark.createDataFrame([(*c[:3],) for c in TABLE] + [(2, 0, 1), (0, 2, 1), (None, 1, 1), (1, None, 1), (1, 2, 0)], "kid_gt int, dad_gt int, mom_gt int")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in df.select("*", *family.transmissions()).collect()}
    for k, d, m, t, u in TABLE:
        assert got[k, d, m] == (t, u)
    assert all(got[x] == (None, None) for x in [(2, 0, 1), (0, 2, 1), (None, 1, 1), (1, None, 1), (1, 2, 0)])


def test_tdt_p(spark):
    e = spark.createDataFrame([(1, s, g) for s, g in zip(range(12), [1, 1, 0] * 4, strict=True)], "vid long, sid int, gt int")
    trios = spark.createDataFrame([(f"F{k}", 3 * k, 3 * k + 1, 3 * k + 2) for k in range(4)], "fam_id string, kid int, dad int, mom int")
    r = family.tdt(joins.trio_entries(e, trios)).first()
    assert (r["t"], r["u"], r["chi_sq"]) == (4, 0, 4.0) and abs(r["p_value"] - math.erfc(math.sqrt(2))) < 1e-12


def test_de_novo(spark):
    trio = spark.createDataFrame([(1, "F", 1, 2, 3, 1, 0, 0, 99, [99, 0, 99], [0, 99, 999], [0, 99, 999], [10, 10], [30, 0], [30, 0])], "vid long, fam_id string, kid int, dad int, mom int, kid_gt int, dad_gt int, mom_gt int, kid_gq int, kid_pl array<int>, dad_pl array<int>, mom_pl array<int>, kid_ad array<int>, dad_ad array<int>, mom_ad array<int>")
    sites = spark.createDataFrame([(1, 1, 100, 0.0, True)], "vid long, ac long, an long, pop_af double, is_snv boolean")
    r = family.de_novo(trio, sites).first()
    pl = lambda x: np.array([10 ** (-v / 10) for v in x]) / sum(10 ** (-v / 10) for v in x)
    k, d = pl([99, 0, 99]), pl([0, 99, 999])
    prior = 100 / 3e7
    new = d[0] * d[0] * k[1] / 3e7
    missed = 2 * d[1] * d[0] * k[1] * (1 - (1 - prior) ** 4)
    assert abs(r["p_de_novo"] - new / (new + missed)) < 1e-9 and r["confidence"] == "HIGH"


def test_split_examples(spark):
    schema = "site int, gt struct<a0:int,a1:int,phased:boolean>, ad array<int>, dp int, gq int, pl array<int>"
    e = spark.createDataFrame([(1, (0, 2, False), [7, 2, 6], 15, 45, [99, 50, 99, 0, 45, 99]), (2, (1, 2, False), [2, 8, 6], 16, 45, [99, 50, 99, 45, 0, 99]), (3, None, None, None, None, None)], schema)
    sites = split.split_sites(spark.createDataFrame([(k, ["A", "C", "T"]) for k in (1, 2, 3)], "site int, alleles array<string>"))
    got = {(r["site"], r["a_index"]): r for r in split.split_entries(e, sites).collect()}
    call = lambda r: (r["gt"]["a0"], r["gt"]["a1"])
    assert (call(got[1, 1]), got[1, 1]["ad"], got[1, 1]["dp"], got[1, 1]["gq"], got[1, 1]["pl"]) == ((0, 0), [13, 2], 15, 45, [0, 45, 99])
    assert (call(got[1, 2]), got[1, 2]["ad"], got[1, 2]["pl"]) == ((0, 1), [9, 6], [50, 0, 99])
    assert (call(got[2, 1]), got[2, 1]["ad"], got[2, 1]["pl"]) == ((0, 1), [8, 8], [45, 0, 99])
    assert (call(got[2, 2]), got[2, 2]["ad"], got[2, 2]["gq"], got[2, 2]["pl"]) == ((0, 1), [10, 6], 45, [50, 0, 99])
    assert got[3, 1]["gt"] is None and got[3, 1]["ad"] is None and got[3, 1]["pl"] is None
    again = {(r["site"], r["a_index"]): r["gq"] for r in split.split_entries(e, sites, recalculate_gq=True).collect()}
    assert again[1, 2] == 50 and again[2, 2] == 50 and again[1, 1] == 45
    star = spark.createDataFrame([(["A", "*", "T"],)], "alleles array<string>")
    assert rows(split.split_sites(star), "a_index") == [(2,)] and split.split_sites(star, keep_star=True).count() == 2
    with pytest.raises(TypeError):
        split.check_types(e.withColumn("dp", F.col("dp").cast("string")))


def test_ranks_over_many_partitions(spark):
    data = [(k, "A", "G" if k % 3 else "AT", (k * 37 % 50) / 10, k % 4 == 0) for k in range(500)]
    v = spark.createDataFrame(data, "vid long, ref string, alt string, score double, flag boolean").withColumn("is_snv", G.is_snp())
    one = ranks.prefix_counts(v, "is_snv", ["score", "vid"], {"rank": "true", "sub": "flag"})
    many = ranks.prefix_counts(v, "is_snv", ["score", "vid"], {"rank": "true", "sub": "flag"}, rows=40)
    assert rows(one, "vid", "rank", "sub") == rows(many, "vid", "rank", "sub")
    want = {}
    for snv in (True, False):
        seen = 0
        for n, d in enumerate(sorted((d for d in data if (d[2] == "G") == snv), key=lambda d: (d[3], d[0]))):
            want[d[0]] = (n, seen)
            seen += d[4]
    assert {r["vid"]: (r["rank"], r["sub"]) for r in many.collect()} == want
    assert ranks.prefix_counts(v.where("false"), "is_snv", ["score", "vid"], {"rank": "true"}).count() == 0


def test_bins(spark):
    df = spark.range(1).select(*[ranks.bin_of(F.lit(r), F.lit(n)).alias(f"b{i}") for i, (r, n) in enumerate([(0, 1370), (12, 1370), (13, 1370), (1369, 1370), (5, 99)])])
    assert list(df.first()) == [1, 1, 2, 106, None]
    assert ranks.threshold_range(60) == [52, 57, 58, 59, 60, 61, 62, 63, 68]
    assert ranks.threshold_range(3) == [1, 2, 3, 4, 5, 6, 11] and ranks.threshold_range(100) == [92, 97, 98, 99, 100, 101]
    assert "n_trans_common" in ranks.bin_measures() and len(ranks.bin_measures()) == 34


def test_precision_recall(spark):
    ids = lambda xs: spark.createDataFrame([(x,) for x in xs], "vid int")
    r = {x["subset"]: x for x in grid.precision_recall(ids([1, 2, 3, 4]), ids([3, 4, 5]), subsets={"none": F.lit(False)}).collect()}
    assert (r["all"]["tp"], r["all"]["fp"], r["all"]["fn"]) == (2, 1, 2) and r["all"]["recall"] == 0.5
    assert (r["none"]["precision"], r["none"]["recall"]) == (-1.0, -1.0)
    name = grid.point_name(80, 5, 10, 0.2, 0.1)
    assert name == "bin_080_DP_05_GQ_10_AB_0.20_missing_0.10" and grid.parse_point(name) == {"bin": 80, "dp": 5, "gq": 10, "ab": 0.2, "call_rate": 0.1}


def test_id_consistency(spark):
    ids = lambda xs: spark.createDataFrame([(x,) for x in xs], "id string")
    d = identity.id_differences(ids(["s1", "s2", "s3", "s4", "s4"]), ids(["s2", "s3", "s5", "s5"]))
    assert rows(d) == [("s1", "data_not_in_map", True), ("s4", "data_not_in_map", False), ("s5", "map_not_in_data", False)]
    m = spark.createDataFrame(list(zip(["W1", "W2", "W3", "W1", "W4"], ["A1", "A2", "A3", "A4", "A1"], strict=True)), "data_sample string, microarray_sample string")
    got = identity.mark_duplicates(m)
    assert rows(got, "data_sample", "microarray_sample", "duplicated_id_any", "duplicated_id_both") == [("W1", "A1", True, True), ("W1", "A4", True, False), ("W2", "A2", False, False), ("W3", "A3", False, False), ("W4", "A1", True, False)]


def report(spark, data):
    return spark.createDataFrame([(k, *d) for k, d in enumerate(data)], "line_no long, data_sample string, microarray_sample string, discordance double, n_sites long")


def test_scores_and_best_match(spark):
    r = report(spark, [("s1", "a1", 0.01, 100), ("s2", "a2", 0.02, 95), ("s2", "a2", 0.9, 9), ("s3", "a3", 0.009, 0), ("s4", "a4", 0.0, 0)])
    got = {x["data_sample"]: x["score"] for x in identity.prepare_report(r).collect()}
    assert abs(got["s2"] - 2.105e-4) < 1e-7 and got["s1"] == 1e-4 and got["s3"] == got["s4"] == 1000.0
    with pytest.raises(Exception, match="not a number"):
        identity.prepare_report(report(spark, [("s1", "a1", None, 5)])).collect()
    tie = identity.best_match(identity.prepare_report(report(spark, [("s1", "b", 1.0, 10), ("s1", "a", 1.0, 10), ("s1", "c", 2.0, 10)])))
    assert rows(tie) == [("s1", "b", 0.1)]


def test_identity_tree(spark):
    r = report(spark, [("s1", "a1", 1.0, 10), ("s2", "a2", 3.0, 10), ("s3", "a3", 1.0, 10), ("s4", "a4", 1.0, 10), ("s4", "b4", 1.5, 10), ("s4", "c4", 9.0, 10)])
    m = spark.createDataFrame([("s2", "a2"), ("s3", "a3"), ("s3", "b3"), ("s4", "b4"), ("s4", "c4"), ("s4", "d4"), ("s9", "a4")], "data_sample string, microarray_sample string")
    v = {(x["data_sample"], x["mapped_microarray_sample"]): x for x in identity.validate(r, m).collect()}
    tags = {k: x["validation_tags"] for k, x in v.items()}
    assert tags["s1", None] == "best_match_not_exist_in_mapfile," and v["s1", None]["is_validation_passed"]
    assert tags["s2", None] == "best_match_exist_in_mapfile,best_match_matched_mapfile,mapfile_unique,score_failed," and not v["s2", None]["is_validation_passed"]
    assert tags["s3", None] == "best_match_exist_in_mapfile,best_match_matched_mapfile,mapfile_non_unique,score_passed,"
    assert tags["s4", "b4"].endswith("mapfile_pairs_have_gtcheck,score_passed,") and v["s4", "b4"]["is_validation_passed"] and v["s4", "b4"]["restored_samples"] == ["s9"]
    assert tags["s4", "c4"].endswith("mapfile_pairs_have_gtcheck,score_failed,") and tags["s4", "d4"].endswith(",no_mapfile_pairs_have_gtcheck,") and len(v) == 6


def test_hwe():
    def plain(a, b, c):
        n, rare = a + b + c, 2 * min(a, c) + b
        f = {}
        for het in range(rare % 2, rare + 1, 2):
            hom = (rare - het) // 2
            f[het] = math.factorial(n) / (math.factorial(hom) * math.factorial(het) * math.factorial(n - het - hom)) * 2**het
        total = sum(f.values())
        return sum(x for x in f.values() if x < f[b] * (1 - 1e-9)) / total + sum(x for x in f.values() if abs(x - f[b]) <= f[b] * 1e-9) / total / 2

    for counts in [(5, 8, 6), (10, 0, 10), (1, 0, 0), (0, 3, 0), (20, 1, 0), (3, 3, 3)]:
        assert abs(A.hwe_midp(*counts)[0] - plain(*counts)) < 1e-9


def test_truth_sets(spark):
    ids = lambda xs: spark.createDataFrame([(x,) for x in xs], "k int")
    assert rows(joins.flag_sets({"a": ids([1, 2]), "b": ids([2, 3, 3])}, ["k"])) == [(1, True, None), (2, True, True), (3, None, True)]


def test_independent_set(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("b", "a"), ("x", "x")], "i string, j string").withColumn("kin", F.lit(0.3))
    kept = {r["s"] for r in structure.unrelated_samples(e).where("kept").collect()}
    assert kept == {"a", "c", "e"}
    assert structure.unrelated_samples(e.where("false")).count() == 0


def test_pca_matches_numpy_and_projection(spark):
    rng = np.random.default_rng(5)
    p = rng.uniform(0.1, 0.9, (60, 1))
    g = rng.binomial(2, np.clip(p + np.where(np.arange(12) < 6, 0.2, -0.2), 0.02, 0.98)).astype(float)
    e = spark.createDataFrame([(v, s, int(g[v, s])) for v in range(60) for s in range(12)], "vid long, sid long, gt int")
    scores, values, loadings = structure.pca(e, 3)
    z = g - 2 * (q := g.mean(1, keepdims=True) / 2)
    z = z / np.sqrt(2 * q * (1 - q))
    want = np.linalg.svd(z / np.sqrt(60))[1][:3] ** 2
    assert np.allclose(values, want)
    a = {r["sid"]: r["scores"] for r in scores.collect()}
    b = {r["sid"]: r["scores"] for r in structure.pc_project(e, loadings).collect()}
    assert all(np.allclose(a[s], b[s]) for s in a)
    assert len({a[s][0] > 0 for s in range(6)}) == 1


def test_pc_relate_finds_twins(spark):
    rng = np.random.default_rng(6)
    g = rng.binomial(2, rng.uniform(0.2, 0.8, (400, 1)), (400, 10))
    g[:, 9] = g[:, 0]
    e = spark.createDataFrame([(v, s, int(g[v, s])) for v in range(400) for s in range(10)], "vid long, sid long, gt int")
    scores = spark.createDataFrame([(s, [0.0]) for s in range(10)], "sid long, scores array<double>")  # one population
    r = {(x["i"], x["j"]): x["kin"] for x in structure.pc_relate(e, scores, -1.0).collect()}
    assert max(r, key=r.get) == (0, 9) and r[0, 9] > 0.3 and abs(np.median([v for k, v in r.items() if k != (0, 9)])) < 0.15


def test_ld_pairs_match_numpy(spark):
    rng = np.random.default_rng(7)
    g = rng.binomial(2, 0.4, (12, 30))
    g[3] = g[2]
    e = spark.createDataFrame([(v, s, int(g[v, s])) for v in range(12) for s in range(30)], "vid long, sid int, gt int")
    v = spark.createDataFrame([(k, "chr1", 100 * k) for k in range(12)], "vid long, contig string, pos int")
    got = {(r["a"], r["b"]): r["r2"] for r in structure.ld_pairs(e, v, 350, 0.0).collect()}
    for a in range(12):
        for b in range(a + 1, 12):
            r2 = np.corrcoef(g[a], g[b])[0, 1] ** 2
            assert ((a, b) in got) == (b - a <= 3 and r2 > 0)
            if (a, b) in got:
                assert abs(got[a, b] - r2) < 1e-9
    kept = {r["vid"] for r in structure.ld_prune(e, v, 350, 0.9).collect()}
    assert len(kept & {2, 3}) == 1 and len(kept) == 11


def test_forest(spark, tmp_path):
    v = spark.range(2000).select(F.col("id").alias("vid"), F.concat(F.lit("chr"), (F.col("id") % 22 + 1).cast("string")).alias("contig"), (F.col("id") * 10).cast("int").alias("pos"), ((F.col("id") * 37) % 100).cast("double").alias("qd"), F.when(F.col("id") % 2 == 0, "snv").otherwise("indel").alias("kind"))
    v = v.withColumn("tp", F.col("qd") > 60).withColumn("fp", F.col("qd") < 30)
    rows_ = model.training_rows(v)
    assert rows_.where("rf_train and contig = 'chr20'").count() == 0
    n = {r["rf_label"]: r["n"] for r in rows_.where("rf_train").groupBy("rf_label").agg(F.count("*").alias("n")).collect()}
    assert abs(n["TP"] - n["FP"]) < 0.15 * n["TP"]
    fitted = model.train(rows_, ["qd", "kind"], ["kind"], trees=10)
    fitted.write().overwrite().save(str(tmp_path / "rf.model"))
    out = model.apply(type(fitted).load(str(tmp_path / "rf.model")), rows_, ["qd", "kind"], ["kind"])
    assert model.accuracy(out.where("contig = 'chr20'")).first()[0] == 1.0
    assert out.where("qd > 60").agg(F.max("score")).first()[0] < 0.5 and model.importance(fitted)["qd"] > 0.8
    assert set(out.columns) >= {"rf_probability", "rf_prediction", "score", "kind", "qd"}


def test_median_impute(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("a", float("nan")), ("b", None), (None, 5.0), (None, None)], "k string, x double")
    got = rows(model.median_impute(df, "k", ["x"]), "k", "x", "x_imputed")
    assert got.count(("a", 2.0, True)) == 2 and ("b", None, True) in got and (None, 5.0, True) in got


def test_differences(spark):
    nan = float("nan")
    a = spark.createDataFrame([(1, 1.0, "x"), (2, nan, None), (3, 5.0, "z"), (4, None, "q")], "k int, v double, t string")
    b = spark.createDataFrame([(1, 1.0 + 1e-12, "x"), (2, nan, None), (3, 6.0, "y"), (5, None, "q")], "k int, v double, t string")
    assert rows(joins.differences(a, b, ["k"], ["v", "t"])) == [(3, "t", "z", "y"), (3, "v", "5.0", "6.0"), (4, "t", "q", None), (5, "t", None, "q")]
    assert joins.differences(a, a, ["k"], ["v", "t"]).count() == 0


def test_sons_have_one_copy_of_the_sex_chromosomes(spark):
    cols = "vid long, fam_id string, kid int, dad int, mom int, kid_gt int, dad_gt int, mom_gt int"
    sites = spark.createDataFrame([(1, "chrX", 5_000_000), (2, "chrX", 20_000), (3, "chrY", 5_000_000), (4, "chr1", 5)], "vid long, contig string, pos long")
    calls = [(v, f, k, 90, 91, *g) for v in range(1, 5) for f, k in (("m", 1), ("f", 2), ("u", 3)) for g in ((0, 0, 2), (2, 2, 0), (0, 2, 0), (2, 0, 2), (1, 0, 0))]
    trios = spark.createDataFrame([("m", 1, 90, 91, False), ("f", 2, 90, 91, True), ("u", 3, 90, 91, None)], "fam_id string, kid int, dad int, mom int, is_female boolean")
    e = family.mendel_errors(family.with_haploid(spark.createDataFrame(calls, cols), sites, trios))
    got = {}
    for r in e.collect():
        got.setdefault((r["vid"], r["fam_id"]), []).append(r["mendel_code"])
    diploid = [2, 3, 4, 6, 7]
    assert {k: sorted(v) for k, v in got.items()} == {(1, "m"): [9, 10], (3, "m"): [11, 12], **{(v, f): diploid for v, f in [(1, "f"), (3, "f"), (2, "m"), (2, "f"), (2, "u"), (4, "m"), (4, "f"), (4, "u")]}}


def test_gram_is_summed_over_tiles_and_partitions(spark, monkeypatch):
    monkeypatch.setattr(structure, "TILE_SAMPLES", 3)
    rng = np.random.default_rng(3)
    g = rng.binomial(2, 0.4, (40, 8))
    e = spark.createDataFrame([(v, s, int(g[v, s])) for v in range(40) for s in range(8)], "vid long, sid int, gt int").repartition(5)
    z = structure._standardised(g.astype(float))
    scores = {r["sid"]: np.array(r["scores"]) for r in structure.pca(e, 8)[0].collect()}
    n = (np.abs(z).sum(1) > 0).sum()
    assert all(abs(scores[a] @ scores[b] - (z.T @ z)[a, b] / n) < 1e-9 for a in range(8) for b in range(8))


def test_components_beyond_the_rank_load_nothing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    g = rng.binomial(2, 0.4, (60, 8))
    e = spark.createDataFrame([(v, s, int(g[v, s])) for v in range(60) for s in range(8)], "vid long, sid int, gt int")
    z, eigh = structure._standardised(g.astype(float)), np.linalg.eigh
    n = (np.abs(z).sum(1) > 0).sum()
    for rounding in (1e-17, -1e-17):  # what is left of the eigenvalue 0

        def rounded(m, rounding=rounding):
            values, vectors = eigh(m)
            return np.r_[rounding, values[1:]], vectors

        monkeypatch.setattr(structure.np.linalg, "eigh", rounded)
        _, values, loadings = structure.pca(e, 8)
        got = {r["sid"]: np.array(r["scores"]) for r in structure.pc_project(e, loadings).collect()}
        assert values[-1] == 0 and (values[:-1] > 0).all()
        assert all(abs(got[a] @ got[b] - (z.T @ z)[a, b] / n) < 1e-9 for a in range(8) for b in range(8))


def test_independent_set_on_a_chain_takes_few_rounds(spark, monkeypatch):
    rounds, write = [], structure.materialize
    monkeypatch.setattr(structure, "materialize", lambda df: rounds.append(1) or write(df))
    e = spark.createDataFrame([(f"n{k:04d}", f"n{k + 1:04d}", 0.3) for k in range(1000)], "i string, j string, kin double")
    kept = {int(r["s"][1:]) for r in structure.unrelated_samples(e).where("kept").collect()}
    assert all(k + 1 not in kept for k in kept) and all({k - 1, k, k + 1} & kept for k in range(1001))
    assert len(rounds) <= 1 + 2 * 12
