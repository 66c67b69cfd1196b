"""Identity numbers and record keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_cluster_id(ident: Column) -> Column:
    """A BIGINT for an id: its own digits where they fit, else the first 15 hex digits of its SHA-1."""
    digits = F.when(ident.rlike("^[0-9]+$"), ident.try_cast("long"))
    return F.coalesce(digits, F.conv(F.substring(F.sha1(ident.cast("binary")), 1, 15), 16, 10).cast("long"))


def mint_cif(smallest_id: Column) -> Column:
    return F.concat(F.lit("CIF-"), smallest_id)


def _digits(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def compose_national_id(
    province: Column, city: Column, district: Column, birth_date: Column, gender: Column, serial: Column
) -> Column:
    """16 digits PPKKCCDDMMYYSSSS; the day is 40 higher for gender 'P'."""
    day = F.dayofmonth(birth_date) + F.when(gender == "P", 40).otherwise(0)
    return F.concat(
        _digits(province, 2),
        _digits(city, 2),
        _digits(district, 2),
        _digits(day, 2),
        _digits(F.month(birth_date), 2),
        _digits(F.year(birth_date) % 100, 2),
        _digits(serial, 4),
    )


def national_id_gender(national_id: Column) -> Column:
    return F.when(F.substring(national_id, 7, 2).try_cast("int") > 40, "P").otherwise("L")


def national_id_agrees(national_id: Column, birth_date: Column, gender: Column) -> Column:
    """Does the number encode this birth date and gender? Null when anything is missing."""
    day = F.dayofmonth(birth_date) + F.when(gender == "P", 40).otherwise(0)
    expected = F.concat(_digits(day, 2), _digits(F.month(birth_date), 2), _digits(F.year(birth_date) % 100, 2))
    known = national_id.isNotNull() & birth_date.isNotNull() & gender.isNotNull()
    return F.when(known, F.substring(national_id, 7, 6) == expected)


# Keys are counted from this day, 5000 a day.
FIRST_DAY = "2010-01-01"
KEYS_PER_DAY = 5000


def compose_record_key(site: Column, index: Column) -> Column:
    """Site (3 digits), day YYYYMMDD, sequence (4 digits) for the running ``index``."""
    day = F.date_add(F.to_date(F.lit(FIRST_DAY)), F.floor(index / KEYS_PER_DAY).cast("int"))
    return F.concat(_digits(site, 3), F.date_format(day, "yyyyMMdd"), _digits(index % KEYS_PER_DAY + 1, 4))


def swap_letters(text: Column, position: Column) -> Column:
    """Swap the letters at ``position`` and after it (1-based); texts of up to 3 letters stay as they are."""
    at = position.cast("int")
    swapped = F.concat(
        F.substring(text, F.lit(1), at - 1),
        F.substring(text, at + 1, F.lit(1)),
        F.substring(text, at, F.lit(1)),
        F.substring(text, at + 2, F.char_length(text)),
    )
    return F.when(F.char_length(text) > 3, swapped).otherwise(text)
