"""Values that belong to one deployment rather than to the engine.

Host names, bucket prefixes, account ids and the labels derived from them differ
per site, so nothing here names a real one: build a ``Site`` or load it from JSON.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from pyspark.sql import SparkSession

# Concept record id -> slug of public-agency dataset archives.
# A site adds its own releases through ``Site.dataset_slugs``.
AGENCY_DATASET_SLUGS = {
    "10723220": "ipi_presentation",
    "10838487": "eiaaeo",
    "7067366": "eiaapi",
    "7682357": "eia176",
    "10607836": "eia191",
    "10607838": "eia757a",
    "4127026": "eia860",
    "4281336": "eia860m",
    "4127028": "eia861",
    "4127039": "eia923",
    "10840077": "eia930",
    "7683135": "eiawater",
    "6633769": "epacamd_eia",
    "10233185": "epacems",
    "4127043": "ferc1",
    "5879542": "ferc2",
    "7126395": "ferc6",
    "7126434": "ferc60",
    "4127100": "ferc714",
    "10844661": "gridpathatk",
    "7683517": "mshamines",
    "10839267": "nrelatb",
    "7683351": "phmsagas",
    "11402753": "csv_conf_2024_coops",
    "13937522": "vcerare",
    "13948331": "naps2024",
    "13919959": "vcerare",
    "10020145": "ferc_xbrl_extractor",
    "14624611": "censuspep",
    "14757121": "doeiraec",
    "14757598": "epapcap",
    "14758684": "doelead",
    "14767206": "eianems",
    "14767235": "epaegrid",
    "14782473": "eiacbecs",
    "14736285": "usgsuspvdb",
    "14782873": "nrelefs",
    "14783182": "nrelsts",
    "14783184": "nrelss",
    "14783214": "usgswtdb",
    "14783267": "eiarecs",
    "14783043": "epamats",
    "14888356": "nrelsiting",
    "15312754": "eiasteo",
    "10086108": "ferceqr",
    "3677547": "ferc1_sqlite",
    "4127048": "censusdp1tract",
    "5348395": "hourly_demand_by_state",
    "4127054": "epacems_old",
    "18036225": "nrelcambium2024",
    "14907942": "nrelcambium2023",
    "14920258": "nrelcambium2022",
    "14920246": "nrelcambium2021",
    "14907940": "nrelcambium2020",
    "18248545": "rus7",
    "18315222": "rus12",
    "18251901": "ferceqr_metadata",
}


@dataclass(frozen=True)
class Site:
    """Deployment values used by the object-log, archive and request plans."""

    # requesters whose traffic is the site's own and is left out of the usage log
    internal_requesters: tuple[str, ...] = ()
    # referer of the web viewer, and the bucket prefix its query engine reads from
    viewer_referer_prefix: str = "https://viewer.example.org/"
    viewer_version: str = "viewer-bucket"
    # referer regex of the documentation pages
    docs_referer_pattern: str = "docs.example.org"
    # labels of the four usage types, and of traffic older than the cutoff day
    label_viewer_query: str = "viewer_duckdb"
    label_viewer_link: str = "viewer_link"
    label_docs: str = "docs_link"
    label_other: str = "other_s3"
    label_before_cutoff: str = "all"
    usage_cutoff: str = "2025-11-24"
    # object paths that were renamed: (text contained, new table name)
    renamed_tables: tuple[tuple[str, str], ...] = (
        ("hourly_emissions", "core_epacems__hourly_emissions.parquet"),
    )
    # object paths left out of the usage log
    dropped_prefixes: tuple[str, ...] = ("hourly_emissions_epacems/",)
    dropped_suffixes: tuple[str, ...] = (".js", ".log", ".csv", "env")
    # request paths that count as data requests
    data_paths: tuple[str, ...] = ("/ferc1", "ferc1.db", ".json", ".csv")
    # concept record id -> slug, on top of the agency archives
    dataset_slugs: Mapping[str, str] = field(default_factory=dict)

    @property
    def all_dataset_slugs(self) -> dict[str, str]:
        return {**AGENCY_DATASET_SLUGS, **self.dataset_slugs}

    @classmethod
    def from_json(cls, path: str, spark: SparkSession | None = None) -> Site:
        """Settings from a JSON file: a local one, or with ``spark`` one at any URI it reads."""
        if spark is None:
            with open(path, encoding="utf-8") as handle:
                given = json.load(handle)
        else:
            given = json.loads(spark.read.text(path, wholetext=True).first()[0])
        known = {f.name for f in fields(cls)}
        unknown = set(given) - known
        if unknown:
            raise ValueError(f"unknown site settings: {sorted(unknown)}")
        for name in ("internal_requesters", "dropped_prefixes", "dropped_suffixes", "data_paths"):
            if name in given:
                given[name] = tuple(given[name])
        if "renamed_tables" in given:
            given["renamed_tables"] = tuple(tuple(pair) for pair in given["renamed_tables"])
        return cls(**given)
