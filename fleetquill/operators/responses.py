"""Baseline service: requests to send, and triage of the responses that came back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquill import schemas
from fleetquill.functions import nested, text
from fleetquill.sources import readers

# HTTP statuses that mean "leave this id out".
SKIPPED_STATUSES = [404, 426, 500]
# Statuses from here on are failures.
FIRST_FAILURE = 400


def is_skipped(status: Column) -> Column:
    return F.coalesce(status.isin(SKIPPED_STATUSES), F.lit(False))


def overview_uuids(overviews: DataFrame, body: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Baseline uuids listed in overview documents, one per row."""
    parsed = readers.parse_json_column(
        overviews, body, schemas.OVERVIEW_DOCUMENT, keep
    )
    return parsed.select(*keep, F.explode("content.uuid").alias("uuid"))


def overview_url(template: str, product: Column, api_version: str) -> Column:
    return text.fill_template(
        template,
        vpId=product,
        requestParameters=F.concat(F.lit("productid="), product),
        api_version=F.lit(api_version),
    )


def baseline_url(template: str, uuid: Column, api_version: str) -> Column:
    return text.fill_template(
        template, baseline_uuid=uuid, api_version=F.lit(api_version)
    )


def usable_ids(responses: DataFrame) -> DataFrame:
    """Add ``usable``: every status but the skipped ones keeps its id."""
    return responses.withColumn("usable", ~is_skipped(F.col("status")))


def response_report(responses: DataFrame, *by: str) -> DataFrame:
    """Usable and left-out ids."""
    return (
        usable_ids(responses)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("ids"),
            F.count_if("usable").alias("usable_ids"),
            F.count_if(~F.col("usable")).alias("failed_ids"),
        )
    )


def triage(responses: DataFrame) -> DataFrame:
    """Add ``outcome``: skipped, error, invalid_json or ok."""
    status = F.col("status")
    return responses.withColumn(
        "outcome",
        F.when(is_skipped(status), "skipped")
        .when(status >= FIRST_FAILURE, "error")
        .when(nested.is_json(F.col("body")), "ok")
        .otherwise("invalid_json"),
    )
