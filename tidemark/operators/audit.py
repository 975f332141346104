"""Audits of samples between snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text


def overlap(previous: DataFrame, current: DataFrame, stratum: str, key: str) -> DataFrame:
    """Per stratum: rows kept, dropped and added between two sets, and fingerprints of both.

    The fingerprint is that of a sorted list of the stratum's keys, which are a sample's and so few; for sets of any
    size see `set_fingerprint`."""
    p = previous.select(stratum, key).distinct().withColumn("p", F.lit(True))
    c = current.select(stratum, key).distinct().withColumn("c", F.lit(True))
    both = p.join(c, [stratum, key], "full_outer")
    old, new = F.coalesce("p", F.lit(False)), F.coalesce("c", F.lit(False))
    return both.groupBy(stratum).agg(
        F.count_if(old & new).alias("kept"), F.count_if(old & ~new).alias("dropped"), F.count_if(~old & new).alias("added"),
        text.url_fingerprint(F.when(old, F.col(key).cast("string"))).alias("before"), text.url_fingerprint(F.when(new, F.col(key).cast("string"))).alias("after"),
    )


def set_fingerprint(rows: DataFrame, stratum: str, key: str) -> DataFrame:
    """(stratum, n, fingerprint) of each stratum's distinct keys, however many: sums of hashes, which partitions add up
    before anything is shuffled.  Equal sets have equal fingerprints in any order."""
    k = F.col(key).cast("string")
    part = lambda seed: F.sum(F.xxhash64(k, F.lit(seed)).cast("decimal(38,0)")).cast("string")
    return rows.select(stratum, key).distinct().groupBy(stratum).agg(F.count("*").alias("n"), F.sha2(F.concat_ws(":", F.count("*").cast("string"), part(1), part(2)), 256).alias("fingerprint"))


def rotation(audit: DataFrame, rows: DataFrame) -> DataFrame:
    """rows (publisher, year, cohort, target, parser_version, ...) with `audited`: whether the holdout's audit bears it out.

    audit: (publisher, year, format_version, passed, expected_parser_version, require_complete, target_per_year,
    previous_unique_evaluated, current_evaluated, prior_cohort_overlap, exclusion_overlap, missing_prior_exclusions,
    wrong_exclusion_cohort_labels).  A cohort that is no holdout needs no audit; a missing or null term fails."""
    target = F.greatest(F.lit(AUDIT_TARGET), F.coalesce("target", F.lit(0)))
    zero = lambda c: F.coalesce(c, F.lit(0)) == 0
    a = F.col("a")
    ok = (
        (a["format_version"] == AUDIT_FORMAT)
        & a["passed"]
        & a["expected_parser_version"].eqNullSafe(F.col("parser_version"))
        & a["require_complete"]
        & (a["target_per_year"] == target)
        & (a["previous_unique_evaluated"] > 0)
        & (a["current_evaluated"] >= target)
        & zero(a["prior_cohort_overlap"])
        & zero(a["exclusion_overlap"])
        & zero(a["missing_prior_exclusions"])
        & zero(a["wrong_exclusion_cohort_labels"])
    )
    joined = rows.join(audit.select("publisher", "year", F.struct(*[c for c in audit.columns if c not in ("publisher", "year")]).alias("a")), ["publisher", "year"], "left")
    holdout_ = F.coalesce(F.col("cohort").startswith("holdout-"), F.lit(False))
    return joined.withColumn("audited", ~holdout_ | F.coalesce(ok, F.lit(False))).drop("a")


AUDIT_FORMAT, AUDIT_TARGET = "holdout-audit/1", 800


def holdout(labelled: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Rows of the current sample that an earlier one, by its label, has too: (key, labels)."""
    seen = labelled.groupBy(key).agg(F.array_sort(F.collect_set("label")).alias("labels"))
    return current.select(key).distinct().join(seen, key)
