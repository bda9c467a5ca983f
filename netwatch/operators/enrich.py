"""Enrichment of lookup events: name length and entropy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netwatch.functions.strings import name_length, shannon_entropy


def enrich_lookups(df: DataFrame, name_column: str = "queried_domain",
                   overwrite: bool = False) -> DataFrame:
    """Fill ``domain_length`` and ``entropy`` from the queried name.

    Values already on the record are kept unless ``overwrite``; missing
    columns are added. The producers never send a length, so without this
    step the length arm of the tunneling rule could not fire.
    """
    length = name_length(name_column)
    entropy = shannon_entropy(name_column)
    if "domain_length" in df.columns and not overwrite:
        length = F.coalesce(F.col("domain_length"), length)
    if "entropy" in df.columns and not overwrite:
        entropy = F.coalesce(F.col("entropy").cast("double"), entropy)
    return df.withColumns({"domain_length": length, "entropy": entropy})
