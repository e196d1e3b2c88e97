import gzip
import zlib

import pytest
from pyspark.sql import functions as F

from cohortqc.plans import config
from cohortqc.sources import sinks, text, vcf
from tests.util import rows

VCF = """##fileformat=VCFv4.2
##INFO=<ID=QD,Number=1,Type=Float,Description="Quality, by depth">
##INFO=<ID=AC,Number=A,Type=Integer,Description="Count">
##INFO=<ID=DB,Number=0,Type=Flag,Description="Known">
##FORMAT=<ID=GT,Number=1,Type=String,Description="Call">
##FORMAT=<ID=AD,Number=R,Type=Integer,Description="Depths">
##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="Quality">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2
chr1\t100\trs1\tA\tC,T\t50.5\tPASS\tQD=2.5;AC=1,.;DB\tGT:AD:GQ\t0/2:7,2,6:45\t./.
chr2\t200\t.\tG\tA\t.\tlow;bad\tQD=.\tGT:GQ\t1|0:30\t0/0:.
"""


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.vcf").write_text(VCF)
    with gzip.open(tmp_path / "b.vcf.gz", "wt") as f:
        f.write(VCF)
    with gzip.open(tmp_path / "c.vcf.bgz", "wt") as f:
        f.write(VCF)
    (tmp_path / "notes.txt").write_text("x")
    return tmp_path


def test_vcf(spark, folder):
    assert [f.rsplit("/", 1)[1] for f in vcf.list_files(spark, str(folder))] == ["b.vcf.gz", "c.vcf.bgz"]
    sites, header = vcf.load_folder(spark, str(folder))
    assert header.samples == ["S1", "S2"] and header.info["QD"].description == "Quality, by depth" and sites.count() == 4
    one = vcf.read_sites(spark, str(folder / "a.vcf"))
    r = {x["pos"]: x for x in one.collect()}
    assert r[100]["alleles"] == ["A", "C", "T"] and r[100]["filters"] == [] and r[100]["qual"] == 50.5 and r[100]["rsid"] == "rs1"
    assert r[100]["info"]["QD"] == 2.5 and r[100]["info"]["AC"] == [1, None] and r[100]["info"]["DB"] is True
    assert r[200]["filters"] == ["low", "bad"] and r[200]["qual"] is None and r[200]["info"]["QD"] is None and r[200]["info"]["DB"] is False and r[200]["rsid"] is None
    e = {(x["pos"], x["s"]): x for x in vcf.explode_entries(one, header).collect()}
    assert tuple(e[100, "S1"]["gt"]) == (0, 2, False) and e[100, "S1"]["ad"] == [7, 2, 6] and e[100, "S2"]["gt"] is None and e[100, "S2"]["ad"] is None
    assert tuple(e[200, "S1"]["gt"]) == (1, 0, True) and e[200, "S1"]["ad"] is None and e[200, "S2"]["gq"] is None
    assert "calls" not in vcf.read_sites(spark, str(folder / "a.vcf"), split_samples=False).columns


def test_vcf_round_trip(spark, folder, tmp_path):
    sites, header = vcf.read_sites(spark, str(folder / "a.vcf")), vcf.read_header(spark, str(folder / "a.vcf"))
    entries = vcf.explode_entries(sites, header)
    flat = sites.select("contig", "pos", "alleles", "rsid", "qual", "filters", "info.QD", "info.AC", "info.DB")
    lines = vcf.vcf_lines(flat, entries, header.samples, ["QD", "AC", "DB"], ["gt", "ad", "gq"])
    head = vcf.header_lines(header.samples, ["chr1", "chr2"], list(header.info.values()), list(header.format.values()))
    out = str(tmp_path / "out")
    vcf.write_by_contig(lines, head, out, ["chr1", "chr2"])
    again = vcf.read_sites(spark, [f"{out}/contig=chr1", f"{out}/contig=chr2"], header)
    assert rows(again) == rows(sites.withColumn("format", F.split(F.lit("GT:AD:GQ"), ":")).withColumn("calls", F.when(F.col("pos") == 100, F.array(F.lit("0/2:7,2,6:45"), F.lit("./.:.:."))).otherwise(F.array(F.lit("1|0:.:30"), F.lit("0/0:.:.")))))
    first = spark.read.text(f"{out}/contig=chr1").first()[0]
    assert first == "##fileformat=VCFv4.2"


def test_text_readers(spark, tmp_path):
    w = lambda n, t: (tmp_path / n).write_text(t) and str(tmp_path / n)
    m = text.mapping(spark, w("map.tsv", "WES_ID\tMicroarray_ID\nW1\tNA\nW2\t\n"))
    assert rows(m) == [("W1", "NA"), ("W2", "")]
    b = text.bed(spark, w("x.bed", "# c\ntrack x\nchr1\t500\t1500\tname\nchr2 2500 3500\n"))
    assert rows(b) == [("chr1", 500, 1500), ("chr2", 2500, 3500)]
    f = text.fam(spark, w("x.fam", "F1\tk\td\tm\t2\t1\nF1 d 0 0 1 -9\nF1\tm\t0\t0\t2\t0\n"))
    assert rows(f, "s", "pat_id", "is_female") == [("d", None, False), ("k", "d", True), ("m", None, True)]
    assert rows(text.founders(f)) == [("d",), ("m",)] and rows(text.trios_of(f), "kid", "dad", "mom") == [("k", "d", "m")]
    g = text.gtcheck(spark, w("g.txt", "# head\nDCv2\ts1\ta1\t0.5\t1.5\t100\t50\nDCv2\ts2\ta2\t0\t1\t0\t0\n"))
    assert rows(g, "line_no", "data_sample", "n_sites") == [(0, "s1", 100), (1, "s2", 0)]
    c = text.consequences(spark, w("c.tsv", "chr1\t5\trs\tA\tT\tmissense_variant\n"))
    assert rows(c, "contig", "pos", "alleles", "consequence") == [("chr1", 5, ["A", "T"], "missense_variant")]
    assert rows(text.tsv(spark, w("n.tsv", "a\tb\n1\t2\n"), header=False)) == [("1", "2"), ("a", "b")]
    assert rows(text.id_list(spark, w("ids", "s1\ns2 \n\n"))) == [("s1",), ("s2",)]
    assert rows(text.reported_sex(spark, w("sex.tsv", "sample_id\tself_reported_sex\n s1\tFemale\n"))) == [("S1", "female")]
    assert rows(text.reference_populations(spark, w("p.tsv", "Sample name\tSuperpopulation code\nX\tEUR\n"), "ref_")) == [("ref_X", "EUR")]


def test_plink(spark, tmp_path):
    v = spark.createDataFrame([(1, "chr2", 2, 7, "A", "T"), (2, "chr1", 1, 9, "G", "C")], "vid long, contig string, contig_idx int, pos long, ref string, alt string")
    e = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (1, "c", 2), (1, "d", None), (1, "e", 2), (2, "e", 1)], "vid long, sid string, gt int")
    sinks.write_plink(e, v, ["a", "b", "c", "d", "e"], str(tmp_path / "x"))
    raw = (tmp_path / "x.bed").read_bytes()
    assert raw[:3] == bytes([0x6C, 0x1B, 1]) and len(raw) == 3 + 2 * 2
    decode = lambda b: [(b[k // 4] >> 2 * (k % 4)) & 3 for k in range(5)]
    assert decode(raw[3:5]) == [1, 1, 1, 1, 2] and decode(raw[5:7]) == [3, 2, 0, 1, 0]
    assert (tmp_path / "x.bim").read_text().splitlines()[1] == "2\tchr2:7:A:T\t0\t7\tT\tA" and (tmp_path / "x.fam").read_text().startswith("a\ta\t0")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2]), (2, None)], "a int, b array<int>")
    sinks.write_tsv(df, str(tmp_path / "t"), compression="none")
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "t")).count() == 2
    assert rows(sinks.checkpoint(df, str(tmp_path / "c")), "a") == [(1,), (2,)]
    sinks.write_table(df, str(tmp_path / "p"), sort=["a"])
    calls = []
    for _ in range(2):
        got = sinks.cached(str(tmp_path / "j"), "snv", "p1", lambda: calls.append(1) or {"TP": 5})
    assert got == {"TP": 5} and len(calls) == 1 and (tmp_path / "j" / "snv_hardfilters_p1.json").read_text() == '{"p1": {"TP": 5}}'
    runs = str(tmp_path / "runs.json")
    assert sinks.read_json(runs) == {}
    sinks.add_run(runs, "m1", {"x": 1})
    assert sinks.add_run(runs, "m2", {"x": 2}) == {"m1": {"x": 1}, "m2": {"x": 2}}
    sinks.write_values([1.5, 0.5], str(tmp_path / "e.txt"))
    assert (tmp_path / "e.txt").read_text() == "1.5\n0.5\n"
    m = spark.createDataFrame([("p", 1, 50.0, 0.5)], "point string, bin int, TP_percent double, t_u_ratio double").withColumns({c: F.lit(1.0) for c in ("DP", "GQ", "AB", "call_rate", "FP_percent", "prec", "recall", "mendelian_error_mean", "mendelian_error_std")})
    sinks.write_filter_metrics(m, str(tmp_path / "m"), "snv")
    back = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "m"))
    assert back.columns[:2] == ["filter", "bin"] and back.columns[-1] == "t_u_ratio" and back.first()["TP"] == "50.0"
    assert sinks.filter_metrics_table(m, "indel").columns[-1] == "recall_inframe"
    keep = tmp_path / "tmp"
    keep.mkdir()
    sinks.clear_folder(str(keep))
    assert keep.exists()
    sinks.clear_folder(f"file://{keep}")
    assert not keep.exists()
    assert sinks.resolve(spark, "/a") == "file:/a" and sinks.path_local("/a") == "/a" and sinks.path_local("file:/a") == "/a" and sinks.path_local("file:///a") == "/a" and sinks.model_path("/r", "model", "m") == "/r/m/rf.model"
    with pytest.raises(ValueError):
        sinks.path_local("hdfs://a/b")
    assert sinks.audit(spark, str(tmp_path / "trail"), "one").count() == 1
    grid = spark.createDataFrame([("a",), ("b",)], "point string")
    assert rows(sinks.missing_points(grid, grid.where("point = 'a'"))) == [("b",)]


def test_config(tmp_path, monkeypatch):
    (tmp_path / "inputs.yaml").write_text("a: {dir: /x, n: 5, l: ['${a.dir}/y']}\nb: '${a.dir}/${a.n}'\nc: ${a.n}\nd: ${b}!\n")
    monkeypatch.delenv(config.VARIABLE, raising=False)
    assert config.load(folder=tmp_path) == {"a": {"dir": "/x", "n": 5, "l": ["/x/y"]}, "b": "/x/5", "c": 5, "d": "/x/5!"}
    monkeypatch.setenv(config.VARIABLE, "other.yaml")
    assert config.find(folder=tmp_path) == tmp_path / "other.yaml"
    monkeypatch.setenv(config.VARIABLE, "/abs.yaml")
    assert str(config.find()) == "/abs.yaml" and str(config.find("given")) == "given"
    with pytest.raises(ValueError):
        config.resolve({"a": "${b}", "b": "${a}"})


def blocks(data, size=700):
    """Block-compressed bytes of ``data``: gzip members with their length in the extra field BC, and the empty last one."""
    out = b""
    for k in [*range(0, len(data), size), None]:
        part = b"" if k is None else data[k : k + size]
        deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = deflate.compress(part) + deflate.flush()
        out += b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + (len(body) + 25).to_bytes(2, "little") + body + zlib.crc32(part).to_bytes(4, "little") + len(part).to_bytes(4, "little")
    return out


@pytest.mark.parametrize("end", ["\n", ""])
def test_block_compressed_files_are_read_by_several_tasks(spark, tmp_path, monkeypatch, end):
    lines = [f"chr{1 + k % 3}\t{k}\t{'x' * (k * 37 % 900)}\tA\tC\t.\t.\t.\tGT\t0/1\té" for k in range(400)]
    data = (VCF.split("chr1")[0] + "\n".join(lines) + end).encode()
    for name in ("a.vcf.gz", "b.vcf.bgz"):
        (tmp_path / name).write_bytes(blocks(data))
    (tmp_path / "c.vcf.gz").write_bytes(gzip.compress(data[:5000]) + gzip.compress(data[5000:]))  # two plain members
    (tmp_path / "d.vcf").write_bytes(data)
    want = sorted(data.decode().splitlines())
    for split in (50, 333, 4000, 10**9):
        for name in ("a.vcf.gz", "b.vcf.bgz"):
            got = [x.decode() for k in range(0, (tmp_path / name).stat().st_size, split) for x in vcf.split_lines(str(tmp_path / name), k, min(k + split, (tmp_path / name).stat().st_size))]
            assert sorted(got) == want, (split, name)
    monkeypatch.setattr(vcf, "SPLIT_BYTES", 2000)
    for name in ("a.vcf.gz", "b.vcf.bgz", "c.vcf.gz", "d.vcf"):
        table = vcf._lines(spark, [str(tmp_path / name)])
        assert sorted(r[0] for r in table.collect()) == want
        assert vcf.read_header(spark, str(tmp_path / name)).samples == ["S1", "S2"]
    assert vcf._lines(spark, [str(tmp_path / "a.vcf.gz")]).rdd.getNumPartitions() > 3
    with pytest.raises(ValueError):
        (tmp_path / "e.vcf").write_text("chr1\t1\n")
        vcf.read_header(spark, str(tmp_path / "e.vcf"))


@pytest.mark.parametrize("blocked", [False, True])
def test_lines_fill_in_missing_samples_and_are_written_in_parts(spark, tmp_path, blocked):
    sites = spark.createDataFrame([("chr1", k, ["A", "C"]) for k in range(1, 30)] + [("chr2", 5, ["A", "C"])], "contig string, pos int, alleles array<string>")
    names = [f"s{k}" for k in range(6)]
    calls = [("chr1", p, ["A", "C"], names[k], {"a0": 0, "a1": 1, "phased": False}, 7) for p in range(1, 30) for k in range(6) if (p * 7 + k * k) % 3 == 0] + [("chr1", 3, ["A", "C"], "s1", None, 1), ("chr1", 3, ["A", "C"], "other", None, 1)]
    entries = spark.createDataFrame(calls, "contig string, pos int, alleles array<string>, s string, gt struct<a0:int,a1:int,phased:boolean>, dp int")
    lines = vcf.vcf_lines(sites, entries, names, [], ["gt", "dp"])
    have = {(c, p, s) for c, p, _, s, gt, _ in calls if gt}
    for r in lines.collect():
        cells = r["line"].split("\t")[9:]
        for s, cell in zip(names, cells, strict=True):
            assert cell == ("0/1:7" if (r["contig"], r["pos"], s) in have else "./.:1" if (r["pos"], s) == (3, "s1") else "./.:."), (r, s)
    vcf.write_by_contig(lines, vcf.header_lines(names, ["chr1", "chr2"]), str(tmp_path / "o"), part_sites=8, blocks=blocked)
    files = sorted((tmp_path / "o" / "contig=chr1").glob("*gz"))
    assert not list((tmp_path / "o").glob("_[0-9]*"))
    assert all(vcf._kind(str(f)) == ("blocks" if blocked else "gzip") for f in files)
    assert len(files) > 1
    whole = "".join(gzip.open(f, "rt").read() for f in files).splitlines()
    assert [x.startswith("#") for x in whole] == [True] * 4 + [False] * 29 and [int(x.split("\t")[1]) for x in whole[4:]] == list(range(1, 30))


def test_plink_segments(spark, tmp_path):
    variants = spark.createDataFrame([(k, f"chr{1 + k % 2}", k % 2, 100 - k, "A", "C") for k in range(9)], "vid long, contig string, contig_idx int, pos int, ref string, alt string")
    gt = {(k, s): (k * s) % 4 for k in range(9) for s in range(5)}
    entries = spark.createDataFrame([(k, s, g if g < 3 else None) for (k, s), g in gt.items() if k != 4], "vid long, sid int, gt int")
    sinks.write_plink(entries, variants, [3, 0, 1, 2, 4], str(tmp_path / "x" / "p"), batch=1 / 32)
    order = sorted(range(9), key=lambda k: (k % 2, 100 - k))
    bed, bim = (tmp_path / "x" / "p.bed").read_bytes(), (tmp_path / "x" / "p.bim").read_text().splitlines()
    assert [x.split("\t")[3] for x in bim] == [str(100 - k) for k in order] and bed[:3] == b"\x6c\x1b\x01" and len(bed) == 3 + 9 * 2
    for n, k in enumerate(order):
        for m, s in enumerate([3, 0, 1, 2, 4]):
            g = 3 if k == 4 else gt[k, s]
            assert bed[3 + n * 2 + m // 4] >> (2 * (m % 4)) & 3 == {0: 3, 1: 2, 2: 0, 3: 1}[g]
    assert not (tmp_path / "x" / "p.segments").exists()


def test_blocks_are_gzip_members_of_known_length():
    import os

    for data in (b"", b"x" * vcf.BLOCK_TEXT, os.urandom(vcf.BLOCK_TEXT)):
        b = vcf.block(data)
        assert vcf.block_size(b) == len(b) and gzip.decompress(b) == data
