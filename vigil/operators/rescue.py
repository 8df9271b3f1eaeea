"""Typed rescue: a message's fields that the typed parse cannot hold.

The message is read twice from its text in one projection: by its schema, and as
a VARIANT, which holds any JSON. A field that the schema doesn't know, or
whose value doesn't fit the declared type (so that the typed field is null though
something was sent), is kept as it came in ``_rescued_data``, a JSON object of
just these fields. A text that isn't JSON is kept whole under ``_text``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigil.operators.silver import MESSAGE_LINEAGE, _ingested
from vigil.schemas import TRANSACTION_SCHEMA


def rescued_transactions(bronze: DataFrame, schema: StructType = TRANSACTION_SCHEMA, now: Column | None = None) -> DataFrame:
    """``parse_transactions`` with ``_rescued_data`` (null where everything fits)."""
    rows = bronze.withColumns({"_message": F.from_json("value", schema), "_variant": F.try_parse_json("value")})
    isobject = F.coalesce(F.schema_of_variant("_variant").startswith("OBJECT"), F.lit(False))
    sent = F.when(isobject, F.expr("CAST(_variant AS MAP<STRING, VARIANT>)"))
    known = F.array(*[F.lit(n) for n in schema.names])
    empty = F.filter(F.array(*[F.when(F.col("_message")[n].isNull(), F.lit(n)) for n in schema.names]), lambda n: n.isNotNull())
    misfit = F.map_filter(sent, lambda k, v: ~F.is_variant_null(v) & (~F.array_contains(known, k) | F.array_contains(empty, k)))
    rescued = (F.when(isobject, F.when(F.size(misfit) > 0, F.to_json(misfit)))
               .when(F.col("value").isNotNull(), F.to_json(F.struct(F.col("value").alias("_text")))))
    made = rows.select("_message", *[r.value() for r in MESSAGE_LINEAGE], rescued.alias("_rescued_data"))
    return made.select("_message.*", *[r.column for r in MESSAGE_LINEAGE], "_rescued_data", _ingested(now, "silver_ingestion_timestamp"))
