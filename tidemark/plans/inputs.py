"""The given tables in the shapes the jobs take: change logs, CSV lots, topic messages."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.batch import file_inventory

EVENT_RULES = {
    "keys": ["user_id"],
    "sequence_by": "ts",
    "apply_as_deletes": "event_type = 'error'",
    "tie_breakers": ["event_id"],
}
LOT_SCHEMA = (
    T.StructType()
    .add("order_ref", "string")
    .add("lot_name", "string")
    .add("order_day", "string")
    .add("customer_ref", "string")
    .add("line_total", "double")
    .add("order_state", "string")
    .add("promised_days", "integer")
)
SCHEMA_CHANGE_AT = "2024-01-15 00:00:00"
PAYLOAD = (
    T.StructType()
    .add("event_ref", "string")
    .add("event_id", "long")
    .add("user_id", "long")
    .add("event_day", "date")
    .add("value", "double")
    .add("event_type", "string")
    .add("event_at", "timestamp")
)
ADDED_FIELD = T.StructField("props", T.StringType())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loan_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes of the loan of their customer."""
    # The column names that the loan views read.
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("prestamo_id"),
        F.col("o_custkey").alias("cliente_id"),
        F.col("o_custkey").cast("string").alias("producto_codigo"),
        F.col("o_orderstatus").alias("estado_prestamo_codigo"),
        F.col("o_totalprice").alias("monto_original"),
        (F.col("o_totalprice") / 1000).alias("tasa_anual"),
        F.length("o_orderpriority").alias("numero_cuotas"),
        F.col("o_orderdate").alias("fecha_desembolso"),
        F.col("o_orderdate").alias("fec_modificacion"),
        F.col("o_orderkey").alias("orden"),
    )


def product_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of the product of their user; an error event deletes it."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("codigo"),
        F.concat_ws(" ", "event_type", "event_id").alias("descripcion"),
        F.when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE").alias("operation"),
        F.col("ts").alias("event_ts"),
    )


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as versions: padded names, some document types missing, some versions closed."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cliente_id"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("tipo_documento_codigo"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("nombres"),
        F.concat(F.col("c_mktsegment"), F.lit("   ")).alias("apellidos"),
        F.col("c_nationkey").alias("fecha_nacimiento"),
        F.col("c_acctbal").alias("fecha_alta"),
        F.when(F.col("c_acctbal") < 0, F.col("c_acctbal")).alias("__END_AT"),
    )


CORE_FIRST_PULL = "1995-01-01 00:00:00"


def core_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a core system keeps it, with the column by which it is pulled."""
    # The column names that the silver views read.
    if name == "prestamo":
        loans = loan_log(spark, sf_dir)
        return loans.withColumn("prestamo_id", F.col("orden")).drop("orden")
    if name == "cliente":
        customers = customer_versions(spark, sf_dir).drop("__END_AT")
        return customers.withColumn("fec_modificacion", _day(F.col("fecha_nacimiento")))
    if name == "cuenta":
        accounts = table(spark, sf_dir, "supplier")
        return accounts.select(F.col("s_suppkey").alias("cuenta_id"), "s_acctbal", _day(F.col("s_nationkey")).alias("fec_modificacion"))
    parts = table(spark, sf_dir, "part")
    return parts.select(F.col("p_partkey").alias("cuota_id"), "p_retailprice", _day(F.col("p_partkey") % 25).alias("fec_modificacion"))


def _day(number):
    """A day of December 1994 or January 1995, so that a first pull sees about half of the rows."""
    return F.date_add(F.lit("1994-12-20").cast("date"), number.cast("int")).cast("timestamp_ntz")


def lot(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """Orders of one status as a lot of text columns.

    Lot F has the known columns, lot O one more, lot P two more and another column order.
    """
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == status)
    urgent = F.col("o_orderpriority").startswith("3")
    columns = {
        "order_ref": F.concat(F.lit("ORD-"), F.col("o_orderkey")),
        "lot_name": F.concat(F.lit("LOTE-"), F.col("o_orderstatus")),
        "order_day": F.col("o_orderdate").cast("date"),
        "customer_ref": F.col("o_custkey"),
        "line_total": F.col("o_totalprice"),
        "order_state": F.col("o_orderstatus"),
        "promised_days": F.when(urgent, F.lit("n/a")).otherwise(F.length("o_orderpriority").cast("string")),
        "ship_priority": F.substring("o_orderpriority", 3, 20),
        "extra_remark": F.concat(F.lit("valor "), F.col("o_custkey")),
    }
    names = list(columns)
    if status == "F":
        names = names[:7]
    elif status == "O":
        names = names[:8]
    else:
        names = names[::-1]
    return orders.select(*[columns[n].cast("string").alias(n) for n in names])


def land_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).csv(path)
    return path


def share_of_files(spark: SparkSession, path: str, batches: int) -> int:
    """Files per micro-batch that drain ``path`` in about ``batches`` batches."""
    return max(1, math.ceil(file_inventory(spark, path, "part-*").count() / batches))


def land_scrambled(df: DataFrame, path: str, key: str, lots: int = 3) -> str:
    """``df`` as parquet files whose order has nothing to do with the order of its rows."""
    df.withColumn("__lot", F.pmod(F.xxhash64(key), F.lit(lots))).write.partitionBy("__lot").parquet(path)
    return path


def messages(spark: SparkSession, sf_dir: str, topic: str = "pagos") -> DataFrame:
    """Events as topic messages with JSON bodies, with a new schema version from ``SCHEMA_CHANGE_AT`` on."""
    at = F.col("ts").cast("timestamp")
    late = at >= F.lit(SCHEMA_CHANGE_AT).cast("timestamp")
    fields = [
        F.concat(F.lit("EVT-"), F.col("event_id")).alias("event_ref"),
        "event_id",
        "user_id",
        F.col("ts").cast("date").alias("event_day"),
        "value",
        "event_type",
        at.alias("event_at"),
    ]
    schema_id = F.when(late, 2).otherwise(1)
    body = F.when(late, F.to_json(F.struct(*fields, "props"))).otherwise(F.to_json(F.struct(*fields)))
    head = F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(schema_id), 8, "0")))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.concat(head, body.cast("binary")).alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        at.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def payload_schemas() -> dict[int, str]:
    return {1: PAYLOAD.json(), 2: T.StructType([*PAYLOAD.fields, ADDED_FIELD]).json()}


def registry(spark: SparkSession, topic: str = "pagos") -> DataFrame:
    rows = [(f"{topic}-value", i, text) for i, text in payload_schemas().items()]
    return spark.createDataFrame(rows, "subject string, schema_id int, schema_json string")
