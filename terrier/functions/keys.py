"""Surrogate keys and address match keys.

Keys are pure functions of normalised text, so a foreign key can be computed where it is needed
instead of being looked up in the dimension it points to.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrier.functions.text import blank_if_null, full_street, strip_street_type

SEPARATOR = "|"


def sk_hex(text: Column) -> Column:
    """16 hex digits; a NULL input has a key as well."""
    return F.upper(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 16))


def sk_long(text: Column) -> Column:
    """60-bit non-negative number; a NULL input has a key as well."""
    digest = F.md5(F.coalesce(text, F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def joined(*parts: Column | str) -> Column:
    """Parts joined by ``|``, missing ones as empty text (never NULL)."""
    return F.concat_ws(SEPARATOR, *(blank_if_null(p) for p in parts))


def strictly_joined(*parts: Column | str) -> Column:
    """Parts joined by ``|``, NULL as soon as one is missing."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    pieces = [cols[0]]
    for c in cols[1:]:
        pieces += [F.lit(SEPARATOR), c]
    return F.concat(*pieces)


def address_id(*six_parts: Column | str) -> Column:
    """Number, street type, street, postcode, commune, département."""
    return sk_hex(joined(*six_parts))


def fallback_address_id(commune: Column | str, departement: Column | str) -> Column:
    return sk_hex(strictly_joined(F.lit("UNKNOWN"), commune, departement))


def postcode_id(postcode: Column | str, departement: Column | str) -> Column:
    return sk_hex(joined(postcode, departement))


def commune_id(commune: Column | str, departement: Column | str) -> Column:
    return sk_long(strictly_joined(commune, departement))


def parcel_id(prefix, section, plan, volume) -> Column:
    return sk_long(joined(prefix, section, plan, volume))


def premises_id(premises: Column | str) -> Column:
    return sk_long(F.col(premises) if isinstance(premises, str) else premises)


def premises_is(name: str, fk: str = "TYPE_LOCAL_ID") -> Column:
    """True for rows of one premises type, tested on the key: needs no dimension."""
    return F.col(fk) == sk_long(F.lit(name))


# Address register side.

def register_key_exact(number, suffix, street, postcode, commune) -> Column:
    return joined(number, suffix, street, postcode, commune)


def register_key_untyped(number, street, postcode, commune) -> Column:
    return joined(number, strip_street_type(street), postcode, commune)


def key_street(street, postcode, commune) -> Column:
    return joined(street, postcode, commune)


def key_postcode(postcode, commune) -> Column:
    return joined(postcode, commune)


# Sale side. Sales carry no usable repetition suffix, so that slot is always empty.

def sale_key_exact(number, street_type, street, postcode, commune) -> Column:
    return joined(number, F.lit(""), full_street(street_type, street), postcode, commune)


def sale_key_untyped(number, street, postcode, commune) -> Column:
    return joined(number, street, postcode, commune)


def sale_key_street(street_type, street, postcode, commune) -> Column:
    return key_street(full_street(street_type, street), postcode, commune)
