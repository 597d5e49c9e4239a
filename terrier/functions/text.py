"""Text normalisation. Every function maps Columns to a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Street types that may open a street name.
STREET_TYPES = (
    "RUE", "AVENUE", "AVE", "AV", "BOULEVARD", "BD", "PLACE", "PL", "CHEMIN", "CHE",
    "IMPASSE", "IMP", "ALLEE", "ALL", "ROUTE", "RTE", "QUAI", "SQUARE", "SQ", "PASSAGE",
    "VOIE", "COURS", "CRS", "MAIL", "ESPLANADE", "PROMENADE", "PARC", "VILLA", "COUR", "HAMEAU",
    "CITE", "RESIDENCE", "RES", "LOTISSEMENT", "LOT",
)
LEADING_STREET_TYPE = "^(" + "|".join(STREET_TYPES) + r")\s+"

# Fixed value: premises type of a sale that names none.
UNKNOWN_PREMISES = "INCONNU"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_text(c: Column | str) -> Column:
    """Upper case, outer blanks removed, every run of whitespace reduced to one blank."""
    return F.upper(F.regexp_replace(F.trim(_col(c)), r"\s+", " "))


def norm_upper(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c)))


def norm_code(c: Column | str) -> Column:
    return F.trim(_col(c))


def norm_text_or_null(c: Column | str) -> Column:
    """As :func:`norm_text`, an empty string counting as missing."""
    return norm_text(F.nullif(_col(c), F.lit("")))


def blank_if_null(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def null_if_blank(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def norm_optional(c: Column | str) -> Column:
    """Optional identifier part: missing and blank are both ``''``."""
    return F.trim(blank_if_null(c))


def premises_type(c: Column | str) -> Column:
    return F.coalesce(norm_upper(c), F.lit(UNKNOWN_PREMISES))


def strip_street_type(c: Column | str) -> Column:
    """Drop one leading street type of an upper-case street name."""
    return F.regexp_replace(_col(c), LEADING_STREET_TYPE, "")


def full_street(street_type: Column | str, street: Column | str) -> Column:
    """``TYPE STREET``, the street alone without a type, NULL without a street."""
    kind, name = _col(street_type), _col(street)
    return F.when(name.isNotNull(), F.concat_ws(" ", kind, name))


def number_with_suffix(number: Column | str, suffix: Column | str) -> Column:
    """``12`` and ``BIS`` make ``12 BIS``; a missing number stays NULL."""
    number, suffix = _col(number), _col(suffix)
    return F.concat(number, F.coalesce(F.concat(F.lit(" "), suffix), F.lit("")))


def _address_line(number, street_type, street, separator, postcode, commune) -> Column:
    head = F.concat_ws(" ", *(blank_if_null(c) for c in (number, street_type, street)))
    tail = F.concat_ws(" ", blank_if_null(postcode), blank_if_null(commune))
    return F.concat(head, F.lit(separator), tail)


def address_label(number, street_type, street, postcode, commune) -> Column:
    return _address_line(number, street_type, street, " ", postcode, commune)


def address_label_full(number, street_type, street, postcode, commune) -> Column:
    """As :func:`address_label`, with a comma between street and town."""
    return _address_line(number, street_type, street, ", ", postcode, commune)
