import random

from cohortqc.sources import badrows
from tests.util import rows

TERMS = ["missense_variant", "intron_variant"]


def parse(line):
    """Plain reading of the rules: (reason, columns)."""
    if line is None:
        return "columns", None
    if line.endswith("\r"):
        line = line[:-1]
    cols, k = [], 0
    while True:
        if line[k : k + 1] == '"':
            k, text = k + 1, ""
            while True:
                if k >= len(line):
                    return "quoting", None
                if line[k] == '"':
                    if line[k + 1 : k + 2] == '"':
                        text, k = text + '"', k + 2
                        continue
                    k += 1
                    break
                text, k = text + line[k], k + 1
            if k < len(line) and line[k] != "\t":
                return "quoting", None
        else:
            end = line.find("\t", k)
            end = len(line) if end < 0 else end
            text, k = line[k:end], end
            if '"' in text:
                return "quoting", None
        cols.append(text)
        if k >= len(line):
            break
        k += 1
    if len(cols) != 6:
        return "columns", None
    ok = cols[1].isascii() and cols[1].isdigit() and 1 <= int(cols[1]) <= 2147483647 and all(t in TERMS for t in cols[5].split("&"))
    return (None, cols) if ok else ("value", None)


def run(spark, lines):
    raw = spark.createDataFrame([(k, line, "x", 1) for k, line in enumerate(lines)], "line_id long, raw_line string, chr string, pos int")
    terms = spark.createDataFrame([(t,) for t in [*TERMS, None]], "consequence string")
    loaded = badrows.load_strict(raw, terms)
    bad = {r["line_id"]: r["reason"] for r in badrows.rejected(raw, loaded, terms).collect()}
    good = {r["line_id"]: [r["chr"], r["pos"], r["rs"], r["ref"], r["alt"], r["consequence"]] for r in loaded.collect()}
    return good, bad


def check(spark, lines):
    good, bad = run(spark, lines)
    for k, line in enumerate(lines):
        reason, cols = parse(line)
        assert bad.get(k) == reason, (line[:80] if line else line, bad.get(k), reason)
        if cols:
            cols[1] = int(cols[1])
            assert good[k] == cols
    assert not set(good) & set(bad) and len(good) + len(bad) == len(lines)


T = "chr1\t{}\trs1\tA\tT\t{}"


def test_cases(spark):
    ok = T.format("5", "missense_variant")
    check(spark, [
        ok, ok + "\r", ok + "\r\r", T.format("007", "missense_variant&intron_variant"), T.format("0", "missense_variant"), T.format("2147483647", "intron_variant"), T.format("2147483648", "intron_variant"),
        T.format("00000000000000002147483647", "intron_variant"), T.format("99999999999999999999", "intron_variant"), T.format("-5", "intron_variant"), T.format(" 5", "intron_variant"), T.format("5", "Missense_variant"),
        T.format("5", "missense_variant&"), T.format("5", ""), T.format("", "intron_variant"), T.format("٣", "intron_variant"), "", None, "\t\t\t\t\t", '"chr1"\t"5"\t"r""s"\t"a\tb"\t\t"intron_variant"', '"chr1"x\t5\tr\tA\tT\tintron_variant',
        'chr1\t5\tr"s\tA\tT\tintron_variant', '"chr1\t5\trs\tA\tT\tintron_variant', '""\t5\t""\t""""\t""\tintron_variant', '"""\t5\ta\tb\tc\tintron_variant', 'a\t5\tb\tc\td\te\tintron_variant', T.format("5", '"intron_variant"\r'),
        T.format("5", '"intron_variant\r"'), "a\nb\t5\tx\ty\tz\tintron_variant", "🧬\t5\tx\ty\tz\tintron_variant",
    ])


def test_random(spark):
    rnd = random.Random(3)
    check(spark, ["".join(rnd.choice(['"', '"', "\t", "\t", "a", "5", "\r"]) for _ in range(rnd.randint(0, 14))) for _ in range(3000)])
    pieces = ["5", "intron_variant", '"intron_variant"', '"5"', '""', '"a""b"', "x", '"t\tt"', 'q"', '"z" ']
    check(spark, ["\t".join(rnd.choice(pieces) for _ in range(rnd.choice([5, 6, 6, 6, 7]))) for _ in range(3000)])


def test_very_long_lines(spark):
    check(spark, ['"' + '""' * 300_000 + '"\t5\trs\tA\tT\tintron_variant', '"' + 'x""' * 200_000 + "\t5\trs\tA\tT\tintron_variant", "y" * 1_000_000 + "\t5\trs\tA\tT\tintron_variant", "\t" * 300_000])


def test_repeated_and_null_ids_and_empty(spark):
    ok, bad = T.format("5", "missense_variant"), "x"
    raw = spark.createDataFrame([(1, ok), (1, ok), (1, bad), (None, ok), (None, bad), (2, bad), (2, bad)], "line_id long, raw_line string")
    terms = spark.createDataFrame([(t,) for t in TERMS], "consequence string")
    loaded = badrows.load_strict(raw, terms)
    assert rows(badrows.rejected(raw, loaded, terms), "line_id", "reason") == sorted([(1, "columns"), (None, "columns"), (2, "columns"), (2, "columns")], key=repr)
    assert loaded.count() == 3
    none = raw.where("false")
    assert badrows.rejected(none, badrows.load_strict(none, terms), terms).count() == 0
    empty = terms.where("false")
    assert rows(badrows.rejected(raw.limit(1), badrows.load_strict(raw.limit(1), empty), empty), "reason") == [("value",)]
