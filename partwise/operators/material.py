"""Material quality: each part joined with the certificate of its batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.functions import quality as Q
from partwise.operators.joins import broadcast_if_small

CERT_COLUMNS = [
    "supplier_id",
    "hardness",
    "tensile_strength",
    "cert_date",
    "hardness_min_spec",
    "hardness_max_spec",
    "tensile_min_spec",
    "tensile_max_spec",
]

MATERIAL_COLUMNS = [
    "part_id",
    "production_date",
    "batch_id",
    "supplier_id",
    "hardness",
    "tensile_strength",
    "cert_date",
    "any_material_deviation",
    "material_failure_reason",
]


def with_material(population: DataFrame, certs: DataFrame, broadcast_limit: int | None = None) -> DataFrame:
    """Population columns plus the batch's certificate, deviation and reason.

    Certificates are per batch, a small fraction of the parts, so the lookup
    is broadcast when its estimated size is under the limit. Otherwise it is a
    sort-merge join on ``batch_id``; a batch feeding a third of all parts is
    then split by adaptive skew-join handling on the population side.
    """
    cert = certs.select("batch_id", *CERT_COLUMNS, F.lit(True).alias("_has_cert"))
    joined = population.join(broadcast_if_small(cert, broadcast_limit), "batch_id", "left")
    has_cert = F.coalesce(F.col("_has_cert"), F.lit(False))
    return joined.select(
        *population.columns,
        *CERT_COLUMNS,
        Q.material_deviation(has_cert).alias("any_material_deviation"),
        Q.material_reason(has_cert).alias("material_failure_reason"),
    )


def material_quality(population: DataFrame, certs: DataFrame, broadcast_limit: int | None = None) -> DataFrame:
    return with_material(population, certs, broadcast_limit).select(*MATERIAL_COLUMNS)
