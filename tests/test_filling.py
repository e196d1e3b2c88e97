import datetime as dt
import os
import random

import duckdb
import pytest

from cohortqc.operators import filling as X
from cohortqc.plans import general
from tests.util import norm, rows

SCHEMA = "row_id long, contig string, pos int, mq double, inbreedingcoeff double, variant_type string, callset_id string, called_at timestamp_ntz, loaded_at timestamp_ntz, t string, day string, entity int"
nan = float("nan")


def at(day, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour)


def fill(spark, data, **kw):
    return {r["row_id"]: r for r in X.fill_gaps(spark.createDataFrame([(*d, "x", "y", 1) for d in data], SCHEMA), **kw).collect()}


def row(i, mq=50.0, inb=0.0, kind="snv", cs="A", day=0.0, pos=None, called=True):
    t = at(day)
    return (i, "chr1", i * 10 if pos is None else pos, mq, inb, kind, cs, t if called else None, t if called else None)


def test_interpolates_and_carries(spark):
    got = fill(spark, [row(1, 40.0, day=0), row(2, None, day=1), row(3, nan, day=3), row(4, 80.0, day=4), row(5, 101.0, day=10), row(6, -1.0, day=100)])
    assert (got[2]["mq"], got[2]["mq_method"], got[2]["mq_distance"]) == (50.0, "interpolated", 1.0)
    assert (got[3]["mq"], got[3]["mq_method"]) == (70.0, "interpolated")
    assert (got[5]["mq"], got[5]["mq_method"], got[5]["mq_distance"]) == (80.0, "carried", 6.0)
    assert got[6]["mq_method"] == "type" and got[6]["mq_distance"] is None
    assert (got[1]["mq"], got[1]["mq_method"], got[1]["mq_distance"]) == (40.0, "observed", 0.0)


def test_carried_back_and_same_time(spark):
    got = fill(spark, [row(1, None, day=0), row(2, 30.0, day=2), row(3, None, day=2), row(4, 60.0, day=2)])
    assert (got[1]["mq"], got[1]["mq_method"]) == (30.0, "carried_back")
    assert (got[3]["mq"], got[3]["mq_method"]) == (45.0, "interpolated")


def test_other_call_set_is_no_neighbour(spark):
    got = fill(spark, [row(1, 10.0, cs="B"), row(2, None, cs="A", day=1), row(3, 90.0, cs=None, day=1), row(4, None, cs=None, day=2)])
    assert got[2]["mq_method"] == "type" and (got[4]["mq"], got[4]["mq_method"]) == (90.0, "carried")


def test_categories(spark):
    data = [row(1, kind=" SNV ", pos=5), row(2, kind="indel", pos=5), row(3, kind="Indel", pos=5), row(4, kind=None, pos=5), row(5, kind="NA", day=1), row(6, kind="mixed", day=90), row(7, kind="", day=200)]
    got = fill(spark, data)
    assert (got[1]["variant_type"], got[1]["variant_type_method"]) == ("snv", "observed")
    assert (got[4]["variant_type"], got[4]["variant_type_method"]) == ("indel", "site")
    assert (got[5]["variant_type"], got[5]["variant_type_method"], got[5]["variant_type_distance"]) == ("indel", "carried", 1.0)
    assert (got[7]["variant_type"], got[7]["variant_type_method"]) == ("indel", "entity")


def test_nothing_known_and_no_time(spark):
    got = fill(spark, [row(1, None, None, None, called=False)])
    assert [got[1][f"{f}_method"] for f in ("mq", "inbreedingcoeff", "variant_type")] == ["none"] * 3
    got = fill(spark, [row(1, 7.0), row(2, None, called=False)])
    assert (got[2]["mq"], got[2]["mq_method"]) == (7.0, "type")


def test_cells_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(*row(1, None), "x", "y", 1), (*row(1, None), "x", "y", 1), (*row(2, 5.0, 2.0, "snv"), "x", "y", 1)], SCHEMA)
    assert rows(X.filled_cells(X.fill_gaps(df))) == [("inbreedingcoeff", 2), ("mq", 1), ("mq", 1)]
    assert X.fill_gaps(df.where("false")).count() == 0


def test_slices_of_days_agree_with_one_scan(spark):
    import random

    rnd = random.Random(1)
    data = [row(i, rnd.choice([None, float(rnd.randint(0, 100))]), day=rnd.random() * 40) for i in range(300)]
    got = fill(spark, data, gap_days=5.0)
    seq = sorted(data, key=lambda d: (d[7], d[0]))
    for k, d in enumerate(seq):
        if d[3] is None:
            p = next(((x[3], x[7]) for x in reversed(seq[:k]) if x[3] is not None), None)
            n = next(((x[3], x[7]) for x in seq[k + 1 :] if x[3] is not None), None)
            dp = (d[7] - p[1]).total_seconds() / 86400 if p else 99
            dn = (n[1] - d[7]).total_seconds() / 86400 if n else 99
            r = got[d[0]]
            if dp <= 5 and dn <= 5:
                assert r["mq_method"] == "interpolated" and abs(r["mq"] - (p[0] + (n[0] - p[0]) * dp / (dp + dn))) < 1e-6
            else:
                assert r["mq_method"] == ("carried" if dp <= 5 else "carried_back" if dn <= 5 else "type")


@pytest.mark.parametrize("part_rows", [6, 10**6])
def test_parts_cut_entities_and_moments(spark, tmp_path, monkeypatch, part_rows):
    """An entity, and one moment of it, lie in many parts; compared with the SQL of the whole."""
    monkeypatch.setattr(X, "PART_ROWS", part_rows)
    rnd = random.Random(5)
    data = []
    for k in range(150):
        t = rnd.choice([None, at(3), at(3), at(3), at(rnd.randint(0, 60), rnd.randint(0, 23))])
        data.append((k, "chr1", rnd.choice([None, rnd.randint(1, 60)]), rnd.choice([None, nan, 40.0, rnd.random() * 100, -1.0]), rnd.choice([None, rnd.random()]), rnd.choice(["snv", " SNV", "indel", None, "?", None]), rnd.choice(["hot", "hot", "a", None]), t, t))
    spark.createDataFrame([(*d, "x", "y", 1) for d in data], SCHEMA).drop("t", "day", "entity").write.parquet(str(tmp_path / "variants.parquet"))
    (tmp_path / "d").mkdir()
    os.symlink(tmp_path / "variants.parquet", tmp_path / "d" / "variants.parquet")
    con = duckdb.connect()
    con.execute(f"create view variants as select * from '{tmp_path}/variants.parquet/*.parquet'")
    res = con.execute(general.SQL["p6_filled"])
    names = [d[0] for d in res.description]
    norm_row = lambda r: repr(tuple(norm(x) for x in r))
    want = sorted(norm_row(r[names.index(c)] for c in sorted(names)) for r in res.fetchall())
    got = general.p6_filled(spark, str(tmp_path / "d"))
    assert sorted(norm_row(r[c] for c in sorted(names)) for r in got.collect()) == want
