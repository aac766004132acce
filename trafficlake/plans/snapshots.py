"""Dataset-platform snapshots and archive statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.functions import times
from trafficlake.operators import columns as C
from trafficlake.operators import quality
from trafficlake.operators.joins import map_values
from trafficlake.schemas import PARTITION_KEY
from trafficlake.site import Site
from trafficlake.sources.files import SNAPSHOT_FIELDS

# Stored names of the snapshot fields.
SNAPSHOT_NAMES = {
    "datasetSlug": "dataset_name",
    "ownerUser": "owner",
    "usabilityRating": "usability_rating",
    "datasetId": "dataset_id",
    "totalViews": "total_views",
    "totalVotes": "total_votes",
    "totalDownloads": "total_downloads",
    "isPrivate": "is_private",
}
# Stored names of the archive record fields.
ARCHIVE_NAMES = {
    "created": "version_creation_date",
    "modified": "version_last_modified_date",
    "updated": "version_last_updated_date",
    "metadata.publication_date": "version_publication_date",
    "id": "version_id",
    "recid": "version_record_id",
    "conceptrecid": "concept_record_id",
    "doi": "version_doi",
    "conceptdoi": "concept_record_doi",
    "doi_url": "version_doi_url",
    "title": "version_title",
    "status": "version_status",
    "state": "version_state",
    "submitted": "version_submitted",
    "metadata.description": "version_description",
    "metadata.version": "version",
    "stats.downloads": "dataset_downloads",
    "stats.unique_downloads": "dataset_unique_downloads",
    "stats.views": "dataset_views",
    "stats.unique_views": "dataset_unique_views",
    "stats.version_downloads": "version_downloads",
    "stats.version_unique_downloads": "version_unique_downloads",
    "stats.version_views": "version_views",
    "stats.version_unique_views": "version_unique_views",
}


def _snapshot_value(name: str) -> Column:
    """A field from whichever layout holds it.

    Where the layout has a ``hasX`` flag, ``xNullable`` is the value and ``x`` a filler.
    """
    flag = f"has{name[0].upper()}{name[1:]}"

    def pick(at) -> Column:
        return F.when(at(flag).isNotNull(), at(f"{name}Nullable")).otherwise(
            F.coalesce(at(f"{name}Nullable"), at(name))
        )

    return F.coalesce(
        pick(lambda c: F.col("info")[c]), pick(lambda c: C.q(f"info.{c}")), pick(C.q)
    )


def build_core_kaggle_logs(raw: DataFrame) -> DataFrame:
    """One row per snapshot day. A document that carries an error fails the job."""
    failed = F.coalesce(F.col("hasErrorMessage"), F.lit(False))
    message = F.concat_ws(" ", F.lit("snapshot contains an error:"), "errorMessage")
    fine = F.when(~failed, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    picked = raw.where(fine).select(
        times.readable(F.col("metrics_date"), times.iso_time(F.col("metrics_date"))).alias("metrics_date"),
        PARTITION_KEY,
        *[_snapshot_value(c).alias(SNAPSHOT_NAMES.get(c, c)) for c in SNAPSHOT_FIELDS],
    )
    named = picked.withColumn("is_private", F.initcap("is_private"))
    out = C.conform(named, "core_kaggle_logs")
    return quality.unique_or_fail(out, ["metrics_date", PARTITION_KEY], "core_kaggle_logs: key repeats")


def build_core_zenodo_logs(raw: DataFrame, site: Site) -> DataFrame:
    """Statistics per record version with the slug of its dataset.

    A concept id without a slug fails the job. The software hash was an object at first
    and a text later; both give one column.
    """
    is_object = F.coalesce(F.ltrim("swh").startswith("{"), F.lit(False))
    hashed = raw.withColumn(
        "software_hash_id",
        F.when(is_object, F.get_json_object("swh", "$.swhid")).otherwise(F.col("swh")),
    )
    rows = C.rename(hashed, ARCHIVE_NAMES).withColumns(
        {
            "metrics_date": F.to_date("metrics_date"),
            "version_publication_date": times.readable(
                F.col("version_publication_date"), times.iso_date(F.col("version_publication_date")), "date"
            ),
            **{
                c: times.readable(F.col(c), times.iso_time(F.col(c)))
                for c in (
                    "version_creation_date",
                    "version_last_modified_date",
                    "version_last_updated_date",
                )
            },
        }
    )
    slugs = site.all_dataset_slugs
    concept = F.col("concept_record_id")
    slug = quality.mapped_or_fail(concept, map_values(concept, slugs), "concept_record_id")
    out = C.conform(rows.withColumn("dataset_slug", slug), "core_zenodo_logs")
    return quality.unique_or_fail(out, ["metrics_date", "version_id", PARTITION_KEY], "core_zenodo_logs: key repeats")
