"""Documents of unknown or changing layout in one pass.

Each JSON document is read as a variant, without a schema and so without a pass to infer one.
Fields are taken from it by path; a field may have been renamed, moved in or out of a nested
object, or written as text in some files. The first of its paths that holds a value counts, and
a value of another type is cast. Fields that a document lacks are NULL, as is all of a document
that can't be parsed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugemill.schemas import RAW_DOCUMENT

DOCUMENT = "document"

# Where else a field may be, by its name with dots.
OTHER_PATHS = {
    "readings.temperature": ("temperature",),
    "readings.vibration": ("vibration",),
    "readings.humidity": ("humidity",),
    "readings.pressure": ("pressure",),
    "readings.energy_use": ("readings.energy_consumption", "energy_use", "energy_consumption"),
    "life_remaining": ("remaining_life", "predicted_remaining_life"),
}


def read_variants(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """A row per document, as a variant."""
    return spark.read.format(fmt).option("singleVariantColumn", DOCUMENT).load(path)


def from_variants(
    documents: DataFrame,
    schema: T.StructType = RAW_DOCUMENT,
    others: Mapping[str, Sequence[str]] = OTHER_PATHS,
) -> DataFrame:
    """Documents in the layout of ``schema``."""
    return documents.select(*(_field(field, "", others).alias(field.name) for field in schema))


def _field(field: T.StructField, prefix: str, others: Mapping[str, Sequence[str]]) -> Column:
    name = f"{prefix}{field.name}"
    if isinstance(field.dataType, T.StructType):
        inner = (_field(each, f"{name}.", others).alias(each.name) for each in field.dataType)
        return F.struct(*inner)
    kind = field.dataType.simpleString()
    paths = (name, *others.get(name, ()))
    return F.coalesce(*(F.try_variant_get(DOCUMENT, f"$.{path}", kind) for path in paths))
