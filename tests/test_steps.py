import os

import pytest
from pyspark.sql import functions as F

from cohortqc.functions import genetics as G
from cohortqc.operators import grid, tiers
from cohortqc.plans import plotdata, steps, testcohort
from cohortqc.session import materialize
from cohortqc.sources import export, vcf
from cohortqc.streaming import ingest
from tests.test_sources import VCF
from tests.util import DATA, rows

data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not there")


@pytest.fixture(scope="module")
def cohort(spark):
    c = testcohort.load(spark, DATA)
    return testcohort.Cohort(*[materialize(x) for x in (c.samples, c.variants, c.entries, c.trios, c.intervals)])


@data
def test_sample_steps(cohort):
    pops = cohort.samples.select("sid", "pop")
    out = steps.sample_outliers(cohort.entries, cohort.variants, pops, 5, 5, 0.1)
    assert out.count() == 25 and {r["status"] for r in out.collect()} <= {"Pass", "Fail"}
    assert steps.remove_failed(cohort.entries, out).select("sid").distinct().count() == out.where("status = 'Pass'").count()
    sexed, conflicts = steps.sex_check(cohort.entries, cohort.variants, cohort.samples)
    assert sexed.count() == 25 and conflicts is None


@data
def test_variant_steps(spark, cohort, tmp_path):
    ped = spark.createDataFrame([("F", 3 * k, 3 * k + 1, 3 * k + 2) for k in range(8)], "fam_id string, s int, pat_id int, mat_id int")
    t = steps.family_tables(cohort.entries, ped)
    assert t["trio_stats"].count() > 0 and t["unrelated"].count() > 0
    side = {"stats": t["trio_stats"], "truth": cohort.variants.select("vid", *[F.when(F.col("vid") % k == 0, True).alias(n) for n, k in (("omni", 3), ("mills", 5), ("kgp_phase1_hc", 7), ("hapmap", 11))])}
    v = cohort.variants.drop("tp", "fp", "transmitted_singleton").withColumn("variant_type", G.allele_class()).withColumn("ac_raw", F.lit(2))
    features = steps.forest_features(v, side, ["qd", "fs", "mq", "variant_type"])
    scored = steps.train_forest(features, ["qd", "fs", "mq", "variant_type"], ["variant_type"], str(tmp_path / "runs.json"), str(tmp_path), "m1", trees=5)
    long_, bins = steps.rank_and_bin(materialize(scored), True, bins=10)
    assert long_.where("rank_id = 'rank'").count() == 200 and bins.agg(F.sum("n")).first()[0] == long_.count()
    kept, entries = steps.filter_variants(cohort.entries, cohort.variants, long_, 5, 5)
    assert 0 < kept.count() < 200 and entries.select("vid").distinct().count() <= kept.count()
    curves = plotdata.bin_curves(bins, ["ti_tv", "n_variants"])
    assert curves.where("metric = 'n_variants'").agg(F.sum("value")).first()[0] == long_.count()
    assert plotdata.point_sizes(curves).agg(F.max("size")).first()[0] == 16.0


@data
@pytest.mark.parametrize("kind", ["snv", "indel"])
def test_grid_step(spark, cohort, kind):
    g = grid.points(spark, [60], [40], [50], [0.2], [0.1], unfiltered=True)
    m = steps.evaluate_grid(cohort.entries, cohort.variants, g, 25, kind, cohort.trios, cohort.variants.where("tp").select("vid"), 3)
    got = {r["point"]: r for r in m.collect()}
    assert len(got) == 2 and got["bin_100_DP_00_GQ_00_AB_0.00_missing_0.00"]["TP_percent"] > 90
    assert all(-2 <= r["t_u_ratio"] for r in got.values()) and ("prec_inframe" in m.columns) == (kind == "indel")
    with pytest.raises(ValueError):
        steps.evaluate_grid(cohort.entries, cohort.variants, g, 25, "other")
    with pytest.raises(ValueError):
        steps.evaluate_grid(cohort.entries, cohort.variants, g, 25, "snv", None, cohort.variants.select("vid"), 999)
    plain = steps.evaluate_grid(cohort.entries, cohort.variants, g, 25, kind).first()
    assert (plain["mendelian_error_mean"], plain["t_u_ratio"], plain["prec"]) == (-1.0, -2.0, -1.0)


@data
def test_export(spark, cohort, tmp_path):
    stringent = {"bin": 90, "dp": 20, "gq": 20, "ab": 0.2, "call_rate": 0.2}
    limits = {k: {**t, "stringent": stringent} for k, t in tiers.EXAMPLE.items()}
    tagged, annotated = steps.tiered(cohort.entries, cohort.variants, 25, limits)
    v = annotated.withColumn("alleles", F.array("ref", "alt"))
    e = tagged.join(v.select("vid", "contig", "pos", "alleles"), "vid").withColumn("s", F.col("sid").cast("string"))
    e = e.withColumn("gt", F.when(F.col("gt").isNotNull(), F.struct((F.col("gt") == 2).cast("int").alias("a0"), (F.col("gt") > 0).cast("int").alias("a1"), F.lit(False).alias("phased"))))
    names = [str(k) for k in range(25)]
    for f, tier, fields in ((export.export_tiers, "relaxed", 6), (export.export_stringent, "stringent", 3)):
        out = str(tmp_path / tier)
        f(v, e, names, limits, "m1", out)
        want = v.where(f"fraction_pass_{tier}_filters > 0")
        files = [os.path.join(out, d) for d in os.listdir(out) if d.startswith("contig=")]
        header = vcf.read_header(spark, files[0])
        assert header.samples == names and len(header.format) == fields and f"{tier}_AC" in header.info
        again = vcf.read_sites(spark, files, header)
        assert rows(again, "contig", "pos") == rows(want, "contig", "pos")
        calls = vcf.explode_entries(again, header).where("gt is not null").count()
        assert calls == e.join(want.select("vid"), "vid", "left_semi").where("gt is not null" + (" and stringent_filters = 'Pass'" if tier == "stringent" else "")).count()


def test_split_and_control(spark):
    sites = spark.createDataFrame([(1, "chr1", 10, ["A", "C", "T"]), (2, "chrX", 20, ["A", "G"]), (3, "chr2", 30, ["A", "G"])], "site int, contig string, pos int, alleles array<string>")
    schema = "site int, s string, gt struct<a0:int,a1:int,phased:boolean>, ad array<int>, dp int, gq int"
    e = spark.createDataFrame([(1, "x", (0, 2, False), [7, 2, 6], 15, 45), (2, "x", (1, 1, False), [0, 9], 9, 30), (3, "x", (0, 0, False), [9, 0], 9, 30)], schema)
    variants, entries = steps.split_cohort(sites, e)
    assert rows(variants, "site", "a_index", "mean_het_ab") == [(1, 2, 6 / 15), (2, 1, None)] and entries.count() == 2
    cq = spark.createDataFrame([("chr1", 10, ["A", "T"], "missense_variant")], "contig string, pos int, alleles array<string>, consequence string")
    panel = spark.createDataFrame([("chr1", 0, 50)], "contig string, start long, stop long")
    assert rows(steps.control_set(sites, e, cq, panel), "contig", "consequence") == [("chr1", "missense_variant")]


def test_run_step(spark, tmp_path):
    for k, n in enumerate(("hapmap", "omni", "kgp", "mills")):
        spark.createDataFrame([("chr1", k, ["A", "T"]), ("chr1", 9, ["A", "T"])], "contig string, pos int, alleles array<string>").write.parquet(str(tmp_path / n))
    config = {"steps": {"truth_set": {"inputs": {n: str(tmp_path / n) for n in ("hapmap", "omni", "kgp", "mills")}, "outputs": str(tmp_path / "out")}}}
    steps.run_step(spark, config, "truth_set")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_plot_tables(spark):
    s = spark.createDataFrame([(1, "EUR", [0.1, 0.2, 0.3]), (2, None, [1.0, 2.0, 3.0])], "sid int, known_pop string, scores array<double>")
    assert plotdata.pca_points(s).count() == 6 and plotdata.expand_array(s, "scores", "PC").columns[-1] == "PC3"
    samples = spark.createDataFrame([("a", float(k)) for k in range(10)], "pop string, m double")
    bounds = spark.createDataFrame([("a", "m", 1.5, 7.5)], "pop string, metric string, lower double, upper double")
    h = plotdata.stratified_histograms(samples, "pop", ["m"], bounds, 3)
    assert rows(h, "bin", "n", "below", "above") == [(1, 3, 2, 2), (2, 3, 2, 2), (3, 4, 2, 2)]


def test_stream(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    (drop / "a.vcf").write_text(VCF)
    header = vcf.parse_header(VCF.splitlines())
    run = lambda: ingest.ingest(spark, str(drop), header, str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination(120)
    assert run()
    assert rows(ingest.call_counts(spark, str(tmp_path / "t")), "pos", "n_called", "n_non_ref") == [(100, 1, 1), (200, 2, 1)]
    (drop / "b.vcf").write_text(VCF.replace("chr2\t200", "chr3\t300"))
    assert run()
    assert rows(ingest.call_counts(spark, str(tmp_path / "t")), "pos", "n_called", "n_non_ref") == [(100, 1, 1), (200, 2, 1), (300, 2, 1)]
