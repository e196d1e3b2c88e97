"""Loading delimited lines strictly, and telling why the others fail (problem 7).

Strict load plus anti-join: every line keeps its offset (line_id); only lines that conform are loaded as typed
columns; their offsets are subtracted from all offsets; the remainder is diagnosed. Everything is JVM-side.
The patterns use possessive quantifiers only, so the matcher never recurses and line length does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortqc.session import bounded_rows

COLUMNS = ("chr", "f1", "rs", "ref", "alt", "consequence")
#: One column: quoted up to a quote that is not doubled, or free of quotes and tabs.
_FIELD = r'(?:"(?:[^"]++|"")*+"|[^"\t]*+)'
_WELL_QUOTED = rf"\A{_FIELD}(?:\t{_FIELD})*+\z"
#: Largest vocabulary of terms that is put into the plan.
MAX_TERMS = 100_000


def _line() -> Column:
    """The line without one carriage return at its end."""
    raw = F.col("raw_line")
    return F.when(raw.endswith("\r"), F.expr("left(raw_line, char_length(raw_line) - 1)")).otherwise(raw)


def _columns(line: Column) -> Column:
    """The columns of a well-quoted line, quotes removed."""
    # a tab before each column makes every match begin at a column's start
    quoted = F.regexp_extract_all(F.concat(F.lit("\t"), line), F.lit(rf"\t({_FIELD})"), F.lit(1))
    bare = lambda c: F.replace(F.substr(c, F.lit(2), F.char_length(c) - 2), F.lit('""'), F.lit('"'))
    plain = F.transform(quoted, lambda c: F.when(c.startswith('"'), bare(c)).otherwise(c))
    return F.when(line.contains('"'), plain).otherwise(F.split(line, "\t", -1))


def _pos_ok(f1: Column) -> Column:
    digits = F.regexp_replace(f1, r"\A0+(?=[0-9])", "")
    return f1.rlike(r"\A[0-9]+\z") & (F.char_length(digits) <= 10) & F.try_to_number(F.right(digits, F.lit(10)), F.lit("9999999999")).between(1, 2147483647)


def _terms_ok(consequence: Column, terms: list[str]) -> Column:
    given = F.split(consequence, "&", -1)
    return F.size(F.array_except(given, F.array(*[F.lit(t) for t in terms]).cast("array<string>"))) == 0


def parse_lines(raw: DataFrame, terms: DataFrame) -> DataFrame:
    """Adds ok_quotes, cols (null if the quoting is broken) and ok_values to the lines' offsets."""
    known = sorted(r[0] for r in bounded_rows(terms.select("consequence").where("consequence is not null").distinct(), MAX_TERMS, "vocabulary of terms"))
    lines = raw.select("line_id", F.xxhash64("raw_line").alias("line_hash"), _line().alias("line"))
    lines = lines.withColumn("ok_quotes", ~F.col("line").contains('"') | F.col("line").rlike(_WELL_QUOTED))
    lines = lines.withColumn("cols", F.when(F.col("ok_quotes"), _columns(F.col("line"))))
    six = F.size("cols") == len(COLUMNS)
    return lines.withColumn("ok_values", six & _pos_ok(F.get("cols", F.lit(1))) & _terms_ok(F.get("cols", F.lit(5)), known))


def load_strict(raw: DataFrame, terms: DataFrame) -> DataFrame:
    """The conforming lines as typed columns, with their offsets."""
    good = parse_lines(raw, terms).where("ok_values")
    c = lambda k: F.get("cols", F.lit(k))
    return good.select(
        "line_id", "line_hash", c(0).alias("chr"), c(1).cast("int").alias("pos"), c(2).alias("rs"), c(3).alias("ref"), c(4).alias("alt"),
        c(5).alias("consequence"), F.split(c(5), "&").alias("terms"),
    )


def rejected(raw: DataFrame, loaded: DataFrame, terms: DataFrame) -> DataFrame:
    """(line_id, reason, raw_line) of every line that was not loaded; reason is quoting, columns or value.

    Only offsets (id and a hash of the line, in case an id is repeated) go through the anti-join; the raw text is
    fetched for the remainder alone. Defined results: a null line is a line without columns (``columns``), an
    empty one too (one column); a line with a null id is judged like any other; repeated rows come out as often
    as they stand. With an empty vocabulary every well-formed line fails with ``value``.
    """
    offsets = raw.select("line_id", F.xxhash64("raw_line").alias("line_hash"))
    key = lambda d: [F.col("line_id").isNull().alias("no_id"), F.coalesce("line_id", F.lit(0)).alias("id"), "line_hash"]
    rest = offsets.select(*key(offsets)).join(loaded.select(*key(loaded)).distinct(), ["no_id", "id", "line_hash"], "left_anti").distinct()
    source = raw.select(F.col("line_id").isNull().alias("no_id"), F.coalesce("line_id", F.lit(0)).alias("id"), F.xxhash64("raw_line").alias("line_hash"), "line_id", "raw_line")
    bad = source.join(rest, ["no_id", "id", "line_hash"], "left_semi").select("line_id", "raw_line")
    judged = bad.withColumn("line", _line())
    ok_quotes = ~F.col("line").contains('"') | F.col("line").rlike(_WELL_QUOTED)
    count = F.size(F.when(ok_quotes, _columns(F.col("line"))))
    reason = (
        F.when(F.col("line").isNull(), "columns").when(~ok_quotes, "quoting").when(count != len(COLUMNS), "columns").otherwise("value")
    )
    return judged.select("line_id", reason.alias("reason"), "raw_line")
