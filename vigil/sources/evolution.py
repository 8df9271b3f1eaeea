"""Typed inference of JSON records, and tables whose schema grows while a flow runs.

Each field of a record has a kind: null, boolean, long, double, timestamp or
string. What a column must hold is the join of the kinds seen, over the lattice
null < long < double < string, null < boolean < string, null < timestamp <
string. Kinds are bits, so the join is a ``bit_or`` for each field: a distributed
aggregate with a map-side part, mergeable over batches. Text stays text, even
digits (card numbers); text in one of the timestamp formats is a timestamp;
objects, arrays and whole numbers beyond 64 bits are kept as text.

A schema store holds numbered versions, each written once. For each micro-batch
the kinds of its records are merged into the store (a new version only if a
column is new or wider), the records are written with the types of that version,
below a folder for it, together with their text. ``read_evolved`` reads all
versions as the newest one: numbers are cast, a column that has become text is
taken from the records' own text, a column that wasn't there is null.

Field names are compared without regard to case, as Spark does; columns have
the lower-case name. A record that isn't a JSON object has its text and no fields.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.schemas import WATCHLIST_EFFECTIVE_FROM_FORMAT
from vigil.sources.tables import is_missing_path

KINDS = ("null", "boolean", "long", "double", "timestamp", "string")
BIT = {k: 1 << i for i, k in enumerate(KINDS)}
SQL_TYPE = {"boolean": "boolean", "long": "bigint", "double": "double", "timestamp": "timestamp", "string": "string"}
TIMESTAMP_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]", "yyyy-MM-dd HH:mm:ss[.SSSSSS]", WATCHLIST_EFFECTIVE_FROM_FORMAT)
RAW, SOURCE, VERSION = "_record", "_source_file", "_schema"
_STORE = "number long, name string, spellings array<string>, kinds long"


def join_of(mask: int) -> str:
    """The kind that holds all kinds of the mask; only nulls are held as text."""
    kinds = {k for k in KINDS if mask & BIT[k]} - {"null"}
    if kinds in ({"long"}, {"double"}, {"boolean"}, {"timestamp"}):
        return kinds.pop()
    return "double" if kinds == {"long", "double"} else "string"


@dataclass(frozen=True)
class Field:
    name: str
    spellings: tuple[str, ...]
    kinds: int

    @property
    def kind(self) -> str:
        return join_of(self.kinds)


def _as_timestamp(text: Column, formats: tuple[str, ...]) -> Column:
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats))


def _path(name: str) -> str:
    if "'" not in name:
        return f"$['{name}']"
    if '"' not in name:
        return f'$["{name}"]'
    raise ValueError(f"a field name with both quotes: {name}")


def infer(records: DataFrame, text: str = "value", formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> DataFrame:
    """(name, spellings, kinds) of the fields of JSON records; a row for each field."""
    spark = records.sparkSession
    parsed = records.select(F.try_parse_json(F.col(text)).alias("v")).filter("schema_of_variant(v) LIKE 'OBJECT%'")
    fields = parsed.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("key", "value", F.schema_of_variant("value").alias("t"))
    stamp = _as_timestamp(F.expr("try_variant_get(value, '$', 'string')"), formats).isNotNull()
    kind = (F.when(F.col("t") == "VOID", BIT["null"]).when(F.col("t") == "BOOLEAN", BIT["boolean"]).when(F.col("t") == "BIGINT", BIT["long"])
            .when(F.col("t").rlike(r"^DECIMAL\(\d+,0\)$"), BIT["string"]).when(F.col("t").rlike("^(DECIMAL|DOUBLE|FLOAT)"), BIT["double"])
            .when((F.col("t") == "STRING") & stamp, BIT["timestamp"]).otherwise(BIT["string"]))
    spelled = fields.groupBy("key").agg(F.bit_or(kind.cast("long")).alias("kinds"))
    return spelled.groupBy(F.lower("key").alias("name")).agg(F.array_sort(F.collect_set("key")).alias("spellings"), F.bit_or("kinds").alias("kinds"))


class SchemaStore:
    """Numbered versions of a table's fields. ``most_fields`` is the width at which records are taken for
    broken (fields named by data): an error, as a schema is held by the driver."""

    def __init__(self, spark: SparkSession, path: str, most_fields: int = 10_000) -> None:
        self.spark, self.path, self.most_fields = spark, path.rstrip("/"), most_fields

    def versions(self) -> dict[int, list[Field]]:
        try:
            rows = self.spark.read.schema(_STORE).json(f"{self.path}/*").orderBy("number", "name").collect()
        except AnalysisException as e:
            if not is_missing_path(e):
                raise
            return {}
        out: dict[int, list[Field]] = {}
        for r in rows:
            out.setdefault(r.number, []).append(Field(r.name, tuple(r.spellings), r.kinds))
        return out

    def newest(self) -> tuple[int, list[Field]]:
        versions = self.versions()
        return max(versions.items(), default=(0, []))

    def merge(self, seen: DataFrame) -> tuple[int, list[Field]]:
        """The version that holds what the store has and ``seen`` (of ``infer``); written if it is new."""
        rows = seen.limit(self.most_fields + 1).collect()
        number, fields = self.newest()
        have = {f.name: f for f in fields}
        for r in rows:
            old = have.get(r.name, Field(r.name, (), 0))
            have[r.name] = Field(r.name, tuple(sorted({*old.spellings, *r.spellings})), old.kinds | r.kinds)
        if len(have) > self.most_fields:
            raise ValueError(f"more than {self.most_fields} fields")
        merged = [have[n] for n in sorted(have)]
        if merged != fields:
            number += 1
            new = [(number, f.name, list(f.spellings), f.kinds) for f in merged]
            self.spark.createDataFrame(new, _STORE).coalesce(1).write.json(f"{self.path}/{number:08d}")  # a number is taken once
        return number, merged


def typed(records: DataFrame, fields: list[Field], text: str = "value", formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> DataFrame:
    """A column for each field with its type, and the record's text and file."""
    own = [F.col(text).alias(RAW)] + ([F.col(SOURCE)] if SOURCE in records.columns else [])
    rows = records.select(*own, F.try_parse_json(F.col(text)).alias("v"))
    return rows.select(*[_value("v", f, formats).alias(f.name) for f in fields], *[c for c in rows.columns if c != "v"])


def _value(variant: str, field: Field, formats: tuple[str, ...]) -> Column:
    def get(kind: str) -> Column:
        return F.coalesce(*(F.try_variant_get(F.col(variant), _path(s), kind) for s in field.spellings))

    return _as_timestamp(get("string"), formats) if field.kind == "timestamp" else get(SQL_TYPE[field.kind])


def evolving_writer(out: str, store: SchemaStore, query_id: Callable[[], str], text: str = "value"):
    """A ``foreachBatch`` function: infer, merge into the store, write with the merged types. A retried batch finds
    the same or a wider version and replaces its own output wherever it was."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            number, fields = store.merge(infer(batch, text))
            rows = typed(batch, fields, text)
            rows.write.mode("overwrite").parquet(f"{out.rstrip('/')}/query={query_id()}/batch_id={batch_id}/{VERSION}={number}")
        finally:
            batch.unpersist()

    return write


def read_evolved(spark: SparkSession, out: str, store: SchemaStore, formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> DataFrame:
    """All batches under the newest schema; of a batch that was written under two versions, the newer."""
    versions = store.versions()
    newest = versions[max(versions)]
    frames = []
    for number, fields in versions.items():
        have = {f.name: f for f in fields}
        try:
            rows = spark.read.option("basePath", out).parquet(f"{out.rstrip('/')}/*/*/{VERSION}={number}")
        except AnalysisException as e:
            if not is_missing_path(e):
                raise
            continue                                  # a version that no batch was written under
        text = F.try_parse_json(F.col(RAW))
        columns = []
        for f in newest:
            if f.name not in have:
                c = F.lit(None).cast(SQL_TYPE[f.kind])
            elif have[f.name].kind == f.kind:
                c = F.col(f"`{f.name}`")
            elif f.kind == "string":
                c = _value("_variant", f, formats)
            else:
                c = F.col(f"`{f.name}`").cast(SQL_TYPE[f.kind])
            columns.append(c.alias(f.name))
        keep = [c for c in (RAW, SOURCE) if c in rows.columns]
        rows = rows.withColumn("_variant", text)
        frames.append(rows.select(*columns, *keep, F.col("query").cast("string").alias("query"), F.col("batch_id").cast("long").alias("batch_id"), F.lit(number).alias(VERSION)))
    both = frames[0]
    for f in frames[1:]:
        both = both.unionByName(f)
    if len(frames) > 1:
        last = both.groupBy("query", "batch_id").agg(F.max(VERSION).alias("_last"))
        both = both.join(last, ["query", "batch_id"]).filter(F.col(VERSION) == F.col("_last")).drop("_last")
    return both.drop("query", "batch_id")
