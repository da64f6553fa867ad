"""Silver views: current customers, loan history and current loans with their product.

No join is hinted: Catalyst broadcasts the product lookup while its size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where AQE splits a product that
holds a large share of the loans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cdc import END_AT, START_AT, current_versions

# The expectation's name and condition, and the column names of the views below.
CUSTOMER_EXPECTATIONS = {"tipdoc_no_nulo": "cod_tipodoc IS NOT NULL"}


def customer_current(customers: DataFrame) -> DataFrame:
    """Open versions of the customer table with trimmed names; see ``CUSTOMER_EXPECTATIONS``."""
    return current_versions(customers).select(
        "cliente_id",
        F.col("tipo_documento_codigo").alias("cod_tipodoc"),
        F.trim("nombres").alias("nombre"),
        F.trim("apellidos").alias("apellido"),
        F.col("fecha_nacimiento").alias("fec_nacimiento"),
        F.col("fecha_alta").alias("fec_alta_usuario"),
    )


def _with_product(loans: DataFrame, products: DataFrame, *more: str) -> DataFrame:
    """Loans with the description the product lookup holds today, NULL where it has none."""
    names = [
        "prestamo_id",
        "cliente_id",
        "producto_codigo",
        "producto",
        "estado_prestamo_codigo",
        "monto_original",
        "tasa_anual",
        "numero_cuotas",
        "fecha_desembolso",
        "fec_modificacion",
        *more,
    ]
    columns = [F.col("prd.descripcion").alias(n) if n == "producto" else F.col(f"p.{n}") for n in names]
    match = F.col("p.producto_codigo") == F.col("prd.codigo")
    return loans.alias("p").join(products.alias("prd"), match, "left").select(*columns)


def loan_history(loans: DataFrame, products: DataFrame) -> DataFrame:
    """Every loan version with today's product description."""
    return _with_product(loans, products, START_AT, END_AT)


def loan_current(loans: DataFrame, products: DataFrame) -> DataFrame:
    """Open loan versions with today's product description."""
    return _with_product(current_versions(loans), products)
