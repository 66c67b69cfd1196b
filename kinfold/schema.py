"""Table layouts and schema conformance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns every source must return, under their source names and ours.
SOURCE_NAMES = {
    "NOMOR_INDUK": "record_id",
    "NAMA_LENGKAP": "full_name",
    "NIK": "national_id",
    "TANGGAL_LAHIR": "birth_date",
    "ID_JENIS_KELAMIN": "gender",
    "ALAMAT": "address",
    "ID_UPT": "site_id",
    "NM_AYAH": "father_name",
    "NM_IBU": "mother_name",
}


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S = T.StringType()

SOURCE = _struct(*[(name, T.DateType() if name == "birth_date" else _S) for name in SOURCE_NAMES.values()])

STAGING = _struct(
    ("record_id", _S),
    ("full_name", _S),
    ("national_id", _S),
    ("birth_date", T.DateType()),
    ("gender", _S),
    ("address", _S),
    ("site_id", _S),
    ("clean_name", _S),
    ("clean_address", _S),
    ("clean_father", _S),
    ("clean_mother", _S),
    ("extracted_at", T.TimestampType()),
    ("processed_at", T.TimestampType()),
)

CLUSTERS = _struct(
    ("record_id", _S),
    ("cluster_id", T.LongType()),
    ("cif_number", _S),
    ("processed_at", T.TimestampType()),
)

KEYS = _struct(("record_id", _S), ("profile", _S))
COUNTS = _struct(("column", _S), ("value", _S), ("n", T.LongType()))
FOREST = _struct(("number", _S), ("root", _S))
POSITIONS = T.StructType([T.StructField("sites", T.StringType(), False), T.StructField("position", T.StringType())])
MERGES = _struct(("old_cif", _S), ("new_cif", _S))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Shape ``df`` to ``schema``: absent columns become null, extra ones go, types are cast."""
    have = {name.lower(): name for name in df.columns}
    return df.select(
        *[
            (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def from_source_names(df: DataFrame) -> DataFrame:
    """Rename source column names (any case) to ours; other columns stay as they are."""
    ours = {native.lower(): name for native, name in SOURCE_NAMES.items()}
    return df.withColumnsRenamed({c: ours[c.lower()] for c in df.columns if c.lower() in ours})
