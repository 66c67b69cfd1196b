"""Person registrations derived from the star-schema tables, with known duplicates.

Keys ending in 9 copy the person whose key ends in 0 (every second one with two letters of the name swapped, every
third one without national id); keys ending in 4 are relatives: same parents and birth date, another person. Of each
fifty keys, one has an empty name, one a placeholder for a name, one no address, and one name is in Cyrillic letters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


PLACEHOLDER = "UNKNOWN PERSON"
# Letters that move a name to another script, and back.
LATIN, CYRILLIC = "abvgdeziklmnoprstuf", "абвгдезиклмнопрстуф"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def persons(spark: SparkSession, folder: str) -> DataFrame:
    """The nine source columns and ``true_entity``."""
    customer = _table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nk"), F.col("c_mktsegment").alias("seg"))
    base = F.when(F.col("k") % 10 == 9, F.col("k") - 9).otherwise(F.col("k"))
    family = F.when(F.col("base") % 10 == 4, F.col("base") - 4).otherwise(F.col("base"))
    rows = customer.withColumn("base", base).withColumn("fam", family)
    part = _table(spark, folder, "part").select("p_partkey", "p_name")
    # The words come from all parts, so that there are more names where there are more persons.
    parts = F.lit(part.count())
    lookups = {
        "first": F.col("base") % parts,
        "second": (F.col("base") * 7 + 3) % parts,
        "father": (F.col("fam") * 11 + 5) % parts,
        "family": (F.col("fam") * 17 + 2) % parts,
        "mother": (F.col("fam") * 13 + 1) % parts,
    }
    for name, key in lookups.items():
        rows = rows.withColumn("p_partkey", key).join(part.withColumnRenamed("p_name", name), "p_partkey").drop("p_partkey")
    k, number = F.col("k"), F.col("base").cast("string")
    name = F.concat_ws(" ", "first", "second")
    swapped = F.concat(F.substring(name, 1, 2), F.substring(name, 4, 1), F.substring(name, 3, 1), F.substring(name, F.lit(5), F.char_length(name)))
    shown = F.concat(
        F.when(k % 7 == 0, "Dr. ").otherwise(""),
        F.when(k % 20 == 19, swapped).otherwise(name),
        F.when(k % 11 == 0, ", S.Kom").otherwise(""),
    )
    address = F.concat(F.lit("Jl. "), "seg", F.lit(" No. "), (F.col("base") % 300).cast("string"), F.lit(" Kec. "), F.col("nk").cast("string"))
    return rows.select(
        F.concat(F.lpad(F.col("nk").cast("string"), 3, "0"), F.lit("20240101"), F.lpad(k.cast("string"), 7, "0")).alias("record_id"),
        F.when(k % 50 == 21, "")
        .when(k % 50 == 32, F.concat_ws(" ", F.lit(PLACEHOLDER), k.cast("string")))
        .when(k % 50 == 16, F.translate(F.lower(name), LATIN, CYRILLIC))
        .otherwise(shown)
        .alias("full_name"),
        F.when(k % 30 != 29, F.concat(F.lit("11"), F.lpad((F.col("base") * 7919 % 99999999).cast("string"), 14, "0"))).alias("national_id"),
        F.date_add(F.lit("1960-01-01").cast("date"), (F.col("fam") * 7919 % 15000).cast("int")).alias("birth_date"),
        F.when(F.col("base") % 2 == 0, "L").otherwise("P").alias("gender"),
        F.when(k % 50 != 43, address).alias("address"),
        F.lpad(F.col("nk").cast("string"), 3, "0").alias("site_id"),
        F.concat_ws(" ", "father", "family").alias("father_name"),
        F.concat_ws(" ", "mother", "family").alias("mother_name"),
        F.col("base").alias("true_entity"),
    )


def mapped_ids(people: DataFrame) -> DataFrame:
    """Persons that already have an entity number elsewhere."""
    return people.filter("true_entity % 17 = 0").select("record_id")


def cases(spark: SparkSession, folder: str) -> DataFrame:
    """``case_id, record_id, site_id``: each order is a case of its customer, so a person has several."""
    orders = _table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("case_id"), F.col("o_custkey").alias("c_custkey"))
    holder = _table(spark, folder, "customer").select("c_custkey", F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("site_id"))
    record = F.concat("site_id", F.lit("20240101"), F.lpad(F.col("c_custkey").cast("string"), 7, "0"))
    return orders.join(holder, "c_custkey").select("case_id", record.alias("record_id"), "site_id")
