"""Identity validation: do sequencing samples and arrays belong together as the mapping file says?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Score of a pair without compared sites (fixed value).
NO_SITES_SCORE = 1000.0


def uniqueness(ids: DataFrame, column: str) -> DataFrame:
    """(id, n, is_unique) of the ids of a list."""
    return ids.groupBy(F.col(column).alias("id")).agg(F.count("*").alias("n")).withColumn("is_unique", F.col("n") == 1)


def id_differences(data: DataFrame, mapping: DataFrame) -> DataFrame:
    """(id, side, is_unique): ids that only one of two lists (column ``id``) has; unique within its own list or not."""
    d, m = uniqueness(data, "id"), uniqueness(mapping, "id")
    side = lambda a, b, name: a.join(b, "id", "left_anti").select("id", F.lit(name).alias("side"), "is_unique")
    return side(d, m, "data_not_in_map").unionByName(side(m, d, "map_not_in_data"))


def mark_duplicates(mapping: DataFrame, left: str = "data_sample", right: str = "microarray_sample") -> DataFrame:
    """Marks every row whose left, right, any or both ids stand in several rows. Counts are aggregates, joined back, so
    that an id with many rows is combined before the shuffle."""
    for c, mark in ((left, "duplicated_wes"), (right, "duplicated_microarray")):
        several = mapping.groupBy(c).agg(F.count("*").alias("_n")).where("_n > 1").select(F.col(c).alias("_id"))
        mapping = mapping.join(several.withColumn(mark, F.lit(True)), mapping[c].eqNullSafe(several["_id"]), "left").drop("_id").fillna(False, [mark])
    a, b = F.col("duplicated_wes"), F.col("duplicated_microarray")
    return mapping.withColumn("duplicated_id_any", a | b).withColumn("duplicated_id_both", a & b)


def without_missing_arrays(mapping: DataFrame, arrays: DataFrame, column: str = "microarray_sample") -> DataFrame:
    return mapping.join(arrays.select(column).distinct(), column, "left_semi")


def prepare_report(report: DataFrame, order: Sequence[str] = ("line_no",), bad_scores: str = "raise") -> DataFrame:
    """The first line of each pair, with score = discordance / n_sites, or 1000 without sites.

    A score that is still null, NaN or infinite raises when it is computed; with ``bad_scores`` 'leave_out' the pair is left
    out, whatever its later lines say. Lines without either id are no pair.
    """
    report = report.where(F.col("data_sample").isNotNull() & F.col("microarray_sample").isNotNull())
    first = report.groupBy("data_sample", "microarray_sample").agg(F.min_by(F.struct("discordance", "n_sites", *order), F.struct(*order)).alias("r"))
    score = F.when(F.col("n_sites") == 0, NO_SITES_SCORE).otherwise(F.col("discordance") / F.nullif(F.col("n_sites"), F.lit(0)))
    bad = F.col("score").isNull() | F.isnan("score") | (F.abs("score") == float("inf"))
    rows = first.select("data_sample", "microarray_sample", "r.*").withColumn("score", score)
    if bad_scores == "leave_out":
        return rows.where(~bad)
    return rows.withColumn("score", F.when(bad, F.raise_error(F.lit("a score is not a number")).cast("double")).otherwise(F.col("score")))


def best_match(pairs: DataFrame, order: Sequence[str] = ("line_no",)) -> DataFrame:
    """The array of the lowest score per data sample, the first line on a tie."""
    best = pairs.groupBy("data_sample").agg(F.min_by(F.struct("microarray_sample", "score"), F.struct("score", *order)).alias("b"))
    return best.select("data_sample", F.col("b.microarray_sample").alias("best_match_microarray_sample"), F.col("b.score").alias("best_match_microarray_score"))


def validate(report: DataFrame, mapping: DataFrame, threshold: float = 0.2, order: Sequence[str] = ("line_no",), bad_scores: str = "raise") -> DataFrame:
    """One row per data sample, or per mapped array where the best match is not one of them, with the tags of each
    check, comma-terminated and in their order, and whether the sample passed.

    Columns: data_sample, best_match_microarray_sample, best_match_microarray_score, mapped_microarray_sample (null
    unless the row is of one mapped array), score_from_mapped, restored_samples (the data samples that the mapping
    gives for the best match), validation_tags, is_validation_passed.
    """
    pairs = prepare_report(report, order, bad_scores)
    best = best_match(pairs, order)
    marked = mark_duplicates(mapping.select("data_sample", "microarray_sample"))
    by_sample = marked.groupBy("data_sample").agg(F.bool_or("duplicated_id_any").alias("duplicated"), F.lit(True).alias("in_map"))
    matched = marked.select("data_sample", F.col("microarray_sample").alias("best_match_microarray_sample"), F.lit(True).alias("matched")).distinct()
    base = best.join(by_sample, "data_sample", "left").join(matched, ["data_sample", "best_match_microarray_sample"], "left")
    base = base.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("duplicated", "in_map", "matched")})
    keep = ["data_sample", "best_match_microarray_sample", "best_match_microarray_score"]
    tag = lambda *parts: F.concat(*[F.concat(p if isinstance(p, Column) else F.lit(p), F.lit(",")) for p in parts])
    by_score = lambda c: F.when(F.col(c) <= threshold, "score_passed").otherwise("score_failed")
    none = lambda t: F.lit(None).cast(t)

    plain = base.where("matched or not in_map").select(
        *keep, none("string").alias("mapped_microarray_sample"), none("double").alias("score_from_mapped"), none("array<string>").alias("restored_samples"),
        F.when(~F.col("in_map"), tag("best_match_not_exist_in_mapfile")).otherwise(
            tag("best_match_exist_in_mapfile", "best_match_matched_mapfile", F.when(F.col("duplicated"), "mapfile_non_unique").otherwise("mapfile_unique"), by_score("best_match_microarray_score"))
        ).alias("validation_tags"),
        (~F.col("in_map") | (F.col("best_match_microarray_score") <= threshold)).alias("is_validation_passed"),
    )
    # the best match is another array than those mapped: look at each mapped array's own score
    mapped = mapping.select("data_sample", F.col("microarray_sample").alias("mapped_microarray_sample"))
    restored = mapping.groupBy(F.col("microarray_sample").alias("best_match_microarray_sample")).agg(F.sort_array(F.collect_list("data_sample")).alias("restored_samples"))
    own = pairs.select("data_sample", F.col("microarray_sample").alias("mapped_microarray_sample"), F.col("score").alias("score_from_mapped"))
    other = base.where("in_map and not matched").join(mapped, "data_sample").join(own, ["data_sample", "mapped_microarray_sample"], "left").join(restored, "best_match_microarray_sample", "left")
    other = other.select(
        *keep, "mapped_microarray_sample", "score_from_mapped", F.coalesce("restored_samples", F.array().cast("array<string>")).alias("restored_samples"),
        F.when(F.col("score_from_mapped").isNull(), tag("best_match_exist_in_mapfile", "best_match_not_matched_mapfile", "no_mapfile_pairs_have_gtcheck")).otherwise(
            tag("best_match_exist_in_mapfile", "best_match_not_matched_mapfile", "mapfile_pairs_have_gtcheck", by_score("score_from_mapped"))
        ).alias("validation_tags"),
        F.coalesce(F.col("score_from_mapped") <= threshold, F.lit(False)).alias("is_validation_passed"),
    )
    return plain.unionByName(other)


def tag_summary(validated: DataFrame) -> DataFrame:
    return validated.groupBy("validation_tags").agg(F.count("*").alias("n"))


def mapping_report(data: DataFrame, arrays: DataFrame, mapping: DataFrame) -> DataFrame:
    """(what, n): sizes, unique and repeated ids of the mapping, ids without counterpart, and rows with repeated ids."""
    parts = []
    for name, column, other in (("wes", "data_sample", data), ("microarray", "microarray_sample", arrays)):
        ids = mapping.select(F.col(column).alias("id"))
        parts.append(uniqueness(ids, "id").groupBy(F.when(F.col("is_unique"), f"{name}_mapping_unique").otherwise(f"{name}_mapping_non_unique").alias("what")).agg(F.count("*").alias("n")))
        diff = id_differences(other.select(F.col(other.columns[0]).alias("id")), ids)
        parts.append(diff.groupBy(F.concat(F.lit(f"{name}_"), "side", F.when(F.col("is_unique"), "_unique").otherwise("_non_unique")).alias("what")).agg(F.count("*").alias("n")))
    marked = mark_duplicates(mapping)
    parts.append(marked.where("duplicated_id_any").agg(F.count("*").alias("n")).select(F.lit("rows_with_repeated_ids").alias("what"), "n"))
    parts.append(mapping.agg(F.count("*").alias("n")).select(F.lit("rows").alias("what"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
