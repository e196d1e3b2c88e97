"""Queries that look at all of their rows, with the settings of the reference."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortqc.operators import filling, filters, model, structure
from cohortqc.plans import cohort_queries, domain_queries, kernel_queries, testcohort
from cohortqc.session import read_table
from cohortqc.sources import vcf
from tests.util import DATA, rows


def test_ld_pairs_across_blocks(spark):
    rng = np.random.default_rng(8)
    pos, contig = rng.integers(1, 4000, 60), rng.integers(1, 3, 60)
    g, called = rng.binomial(2, 0.5, (60, 8)), rng.random((60, 8)) < 0.8
    e = spark.createDataFrame([(k, s, int(g[k, s]) if called[k, s] else None) for k in range(60) for s in range(8)], "vid long, sid int, gt int")
    v = spark.createDataFrame([(k, f"chr{contig[k]}", int(pos[k])) for k in range(60)], "vid long, contig string, pos int")
    for window in (3, 999, 1000, 10_000):
        want = {}
        for a in range(60):
            for b in range(60):
                both = called[a] & called[b]
                if contig[a] == contig[b] and (pos[a], a) < (pos[b], b) and pos[b] - pos[a] <= window and g[a, both].std() > 0 and g[b, both].std() > 0:
                    r2 = np.corrcoef(g[a, both], g[b, both])[0, 1] ** 2
                    if r2 > 0.1234:
                        want[a, b] = r2
        got = {(r["a"], r["b"]): r["r2"] for r in structure.ld_pairs(e, v, window, 0.1234).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_ld_prune_query_looks_at_the_whole_window(spark):
    c = testcohort.load(spark, DATA)
    kept = kernel_queries.ld_prune(spark, DATA)
    assert structure.ld_pairs(c.entries, kept, 1_000_000, 0.2).count() == 0
    assert rows(kept, "vid") == rows(structure.ld_prune(c.entries, filters.autosomal_snvs(c.variants)), "vid")


def _greedily_pruned(pos, contig, g, called, window, r2):
    count = len(pos)
    p = [g[k, called[k]].sum() / (2 * called[k].sum()) if called[k].any() else None for k in range(count)]
    kept = []
    for k in sorted((k for k in range(count) if p[k] is not None), key=lambda k: (-min(p[k], 1 - p[k]), hashlib.md5(str(k).encode()).hexdigest(), k)):
        for j in kept:
            both = called[k] & called[j]
            if contig[k] is not None and contig[j] == contig[k] and abs(pos[j] - pos[k]) <= window and g[k, both].std() > 0 and g[j, both].std() > 0 and np.corrcoef(g[k, both], g[j, both])[0, 1] ** 2 > r2:
                break
        else:
            kept.append(k)
    return set(kept)


@pytest.mark.filterwarnings("ignore::RuntimeWarning")
def test_ld_prune_decides_over_borders_and_writes_no_pairs(spark, monkeypatch):
    rng = np.random.default_rng(9)
    count = 400
    pos, contig = rng.integers(1, 4000, count), [("chr1", "chr2")[k] for k in rng.integers(0, 2, count)]
    contig[7] = None
    g, called = rng.binomial(2, 0.4, (count, 9)), rng.random((count, 9)) < 0.8
    called[11] = False
    e = spark.createDataFrame([(k, s, int(g[k, s]) if called[k, s] else None) for k in range(count) for s in range(9)], "vid long, sid int, gt int")
    v = spark.createDataFrame([(k, contig[k], int(pos[k])) for k in range(count)], "vid long, contig string, pos int")
    written, write = [], structure.materialize
    monkeypatch.setattr(structure, "materialize", lambda df: written.append(write(df)) or written[-1])
    monkeypatch.setattr(structure, "release", lambda *dfs: None)
    for window, cells in ((0, 1), (60, 1), (400, 1), (400, 4_000_000)):
        written.clear()
        monkeypatch.setattr(structure, "LD_REGION", cells, raising=False)
        got = {r["vid"] for r in structure.ld_prune(e, v, window, 0.3123).collect()}
        assert got == _greedily_pruned(pos, contig, g, called, window, 0.3123)
        assert all("vid" in t.columns and t.count() <= called.sum() for t in written)
        assert len(written) == 4 if cells > 1 else len(written) < 14


def test_forest_queries_have_the_default_sizes(spark, monkeypatch):
    sizes, made = [], model.RandomForestClassifier
    monkeypatch.setattr(model, "RandomForestClassifier", lambda **k: sizes.append(k["numTrees"]) or made(**k))
    kernel_queries.rf_scores(spark, DATA)
    kernel_queries.population_rf(spark, DATA)
    assert sizes == [500, 100]


def test_fallback_medians_are_exact_over_many_values(spark):
    n = 300_000
    order = (F.col("id") * 7_919) % n  # every whole number below n once
    known = spark.range(n).select("id", (order * 100.0 / n).alias("mq"), (order * 2.0 / n - 1).alias("inbreedingcoeff"), F.when(F.col("id") % 3 == 0, "snv").otherwise("indel").alias("variant_type"))
    gaps = spark.createDataFrame([(n, None, None, "snv"), (n + 1, None, None, "indel"), (n + 2, None, None, "mixed")], "id long, mq double, inbreedingcoeff double, variant_type string")
    # every row is a call set of its own, so there are no neighbours
    t = known.unionByName(gaps).select(F.col("id").alias("row_id"), F.lit("chr1").alias("contig"), F.col("id").cast("int").alias("pos"), "mq", "inbreedingcoeff", "variant_type", F.col("id").cast("string").alias("callset_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("called_at"), F.lit(None).cast("timestamp_ntz").alias("loaded_at"))
    got = {r["row_id"]: r for r in filling.fill_gaps(t).where(f"row_id >= {n}").collect()}
    ids = np.arange(n)
    values = ids * 7_919 % n
    middle = lambda x: int(np.sort(x)[(len(x) + 1) // 2 - 1])
    for k, x, method in ((n, values[ids % 3 == 0], "type"), (n + 1, values[ids % 3 != 0], "type"), (n + 2, values, "overall")):
        assert (got[k]["mq"], got[k]["mq_method"]) == (middle(x) * 100.0 / n, method)
        assert (got[k]["inbreedingcoeff"], got[k]["inbreedingcoeff_method"]) == (middle(x) * 2.0 / n - 1, method)


def test_every_sample_has_a_freemix_index(spark):
    got = domain_queries.QUERIES["freemix_index_all"](spark, DATA).orderBy("idx").collect()
    assert [r["idx"] for r in got] == list(range(read_table(spark, DATA, "samples").count()))
    place = [2 if r["freemix"] is None else 1 if np.isnan(r["freemix"]) else 0 for r in got]
    assert place == sorted(place) and (np.diff([r["freemix"] for r, p in zip(got, place, strict=True) if p == 0]) >= 0).all()


def test_nan_freemix_comes_after_numbers_and_before_nulls(spark, tmp_path):
    data = [("a", None, "2024-01-01"), ("b", float("nan"), "2024-01-02"), ("c", 0.5, "2024-01-03"), ("d", float("inf"), "2024-01-04"), ("e", 0.1, "2024-01-05")]
    spark.createDataFrame(data, "s string, freemix double, arrived_at string").write.parquet(str(tmp_path / "samples.parquet"))
    got = domain_queries.QUERIES["freemix_index_all"](spark, str(tmp_path))
    assert [r["s"] for r in got.orderBy("idx").collect()] == ["e", "c", "d", "b", "a"]


def test_union_of_populations_has_all_entries_of_common_variants(spark):
    c = testcohort.load(spark, DATA)
    pop = {r["sid"]: r["pop"] for r in c.samples.collect()}
    cells = c.entries.select("vid", "sid", "gt").collect()
    sides = [{r["vid"] for r in cells if (pop[r["sid"]] == "ASIA") == asia} for asia in (True, False)]
    want = sorted(((r["vid"], r["sid"], r["gt"]) for r in cells if r["vid"] in sides[0] & sides[1]), key=repr)
    assert rows(cohort_queries.QUERIES["union_cols_populations"](spark, DATA), "vid", "sid", "gt") == want
    assert any(vid % 6 for vid, _, _ in want)


def test_a_header_of_many_lines_is_read_whole(spark, tmp_path):
    head = ["##fileformat=VCFv4.2", *[f"##contig=<ID=c{k}>" for k in range(100_001)], "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "s1", "s2"])]
    (tmp_path / "a.vcf").write_text("\n".join([*head, "\t".join(["c1", "5", ".", "A", "C", ".", ".", ".", "GT", "0/1", "1/1"])]) + "\n")
    assert list(vcf.read_header(spark, str(tmp_path / "a.vcf")).samples) == ["s1", "s2"]
