"""Control tables: what files there are, what changed, and what is still to do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifest_diff(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Both sides joined by path, with a state: new, changed (content, size or time), unchanged or deleted."""
    a, b = listing.alias("a"), manifest.alias("b")
    differs = ~(F.col("a.sha1").eqNullSafe(F.col("b.sha1")) & F.col("a.size").eqNullSafe(F.col("b.size")) & F.col("a.modified").eqNullSafe(F.col("b.modified")))
    state = F.when(F.col("b.path").isNull(), "new").when(F.col("a.path").isNull(), "deleted").when(differs, "changed").otherwise("unchanged")
    return a.join(b, F.col("a.path") == F.col("b.path"), "full_outer").select(F.coalesce("a.path", "b.path").alias("path"), state.alias("state"), F.coalesce("a.sha1", "b.sha1").alias("sha1"), F.coalesce("a.size", "b.size").alias("size"), F.coalesce("a.modified", "b.modified").alias("modified"))


def upsert_manifest(listing: DataFrame, manifest: DataFrame, now: str) -> DataFrame:
    """The manifest after a scan: first seen times stay, files that are gone are marked."""
    diff = manifest_diff(listing, manifest)
    first = manifest.select("path", "discovered_at")
    return diff.join(first, "path", "left").select("path", "sha1", "size", "modified", F.coalesce("discovered_at", F.lit(now)).alias("discovered_at"), F.lit(now).alias("scanned_at"), (F.col("state") == "deleted").alias("is_deleted"))


def enqueue(changes: DataFrame, jobs: DataFrame, stages: Sequence[str]) -> DataFrame:
    """Jobs (path, sha1, stage) to add for new and changed files; those that exist are not added again."""
    wanted = changes.where(F.col("state").isin("new", "changed")).select("path", "sha1", F.explode(F.array(*[F.lit(s) for s in stages])).alias("stage"))
    return wanted.join(jobs.select("path", "sha1", "stage"), ["path", "sha1", "stage"], "left_anti")


def pending(jobs: DataFrame, manifest: DataFrame, stage: str, most: int | None = None) -> DataFrame:
    """Waiting jobs of a stage in order of their id, with what the manifest has of the file."""
    out = jobs.where((F.col("stage") == stage) & (F.col("status") == "pending")).join(manifest, "path", "left").orderBy("job_id")
    return out.limit(most) if most else out


def retry(jobs: DataFrame, most: int, since: str | None = None) -> DataFrame:
    """Failed jobs set back to pending while they have tries left, if they ended since."""
    again = (F.col("status") == "failed") & (F.col("retry_count") < most)
    if since:
        again = again & (F.coalesce("ended_at", "created_at") >= F.lit(since))
    return jobs.withColumn("retry_count", F.when(again, F.col("retry_count") + 1).otherwise(F.col("retry_count"))).withColumn("status", F.when(again, "pending").otherwise(F.col("status")))


def reset(jobs: DataFrame, stages: Sequence[str]) -> DataFrame:
    """All jobs of the stages set back to pending."""
    return jobs.withColumn("status", F.when(F.col("stage").isin(*stages), "pending").otherwise(F.col("status")))


def latest(names: Sequence[str]) -> str | None:
    """The last of the run folders by name."""
    return max(names, default=None)
