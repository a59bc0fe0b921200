"""Raw responses to landed baseline documents.

A landed row has the document as it came and the key it is known by, from which product,
day and uuid can be told; the baseline load reads such rows and bare documents alike.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquill.functions import text
from fleetquill.operators import responses
from fleetquill.plans import staging


class FailedResponses(RuntimeError):
    """The service answered with errors or with texts that are no JSON."""


def landed_rows(triaged: DataFrame, folder: str, day: str | dt.date) -> DataFrame:
    """The good responses under their object keys."""
    key = text.raw_object_key(folder, F.lit(str(day)), F.col("product_id"), F.col("uuid"))
    good = triaged.where(F.col("outcome") == "ok")
    return good.select(key.alias("object_key"), "product_id", "uuid", "body")


def land_responses(
    raw: DataFrame, landing: str, day: str | dt.date, strict: bool = True
) -> dict[str, int]:
    """Write the good responses of a table, with their keys, as the folder ``landing/<day>``.

    Returns the number of responses per outcome. ``strict`` refuses the batch when a
    response failed for another reason than the skipped statuses. The triage parses
    every body, so its result is staged for counting and writing; a rerun replaces what
    the day had landed.
    """
    spark = raw.sparkSession
    folder = staging.staging_folder(spark, f"{landing.rstrip('/')}_staging")
    columns = ["outcome", "product_id", "uuid", "body"]
    triaged = staging.stage(responses.triage(raw).select(*columns), folder)
    found = {r["outcome"]: r["count"] for r in triaged.groupBy("outcome").count().collect()}
    bad = found.get("error", 0) + found.get("invalid_json", 0)
    if strict and bad:
        staging.drop(spark, folder)
        raise FailedResponses(f"{bad} of {sum(found.values())} responses failed")
    root = landing.rstrip("/")
    rows = landed_rows(triaged, f"{root.rsplit('/', 1)[-1]}/", day)
    rows.hint("rebalance").write.mode("overwrite").json(f"{root}/{day}")
    staging.drop(spark, folder)
    return found
