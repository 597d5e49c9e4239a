"""Small hand-made inputs with known results."""

from __future__ import annotations

from terrier.sources.bronze import REGISTER_COLUMNS, REGISTER_SCHEMA, SALES_COLUMNS, SALES_SCHEMA


def sale(**values) -> tuple:
    """A raw sale line; anything not given takes an ordinary value."""
    row = {
        "DATE_MUTATION": "15/03/2023", "NATURE_MUTATION": "Vente", "VALEUR_FONCIERE": "250000,00",
        "NO_VOIE": "1", "TYPE_DE_VOIE": "RUE", "VOIE": "X", "CODE_POSTAL": "75001",
        "COMMUNE": "PARIS", "CODE_DEPARTEMENT": "75", "PREFIXE_DE_SECTION": "001",
        "SECTION": "AB", "NO_PLAN": "12", "NO_VOLUME": None, "TYPE_LOCAL": "Appartement",
        "SURFACE_REELLE_BATI": "50", "NOMBRE_PIECES_PRINCIPALES": "2",
    }
    row.update(values)
    return tuple(row.get(c) for c in SALES_COLUMNS)


def at(number, kind, street, postcode, commune, departement, **values) -> tuple:
    """A raw sale at an address."""
    return sale(
        NO_VOIE=number, TYPE_DE_VOIE=kind, VOIE=street, CODE_POSTAL=postcode, COMMUNE=commune,
        CODE_DEPARTEMENT=departement, **values,
    )


def entry(id_, fantoir, number, rep, street, postcode, insee, commune, lon, lat, position, certified):
    """A raw register row."""
    row = {
        "id": id_, "id_fantoir": fantoir, "numero": number, "rep": rep, "nom_voie": street,
        "code_postal": postcode, "code_insee": insee, "nom_commune": commune, "lon": lon,
        "lat": lat, "type_position": position, "certification_commune": certified,
        "cad_parcelles": "AB0123|AB0124", "x": "650000,5", "y": "6860000",
    }
    return tuple(row.get(c) for c in REGISTER_COLUMNS)


REGISTER = [
    entry("b1", "f1", "12", None, "Rue  Victor Hugo", "75001", "75101", "Paris", "2,35", "48,85", "housenumber", "0"),
    entry("b2", "f1", "12", None, "RUE VICTOR HUGO", "75001", "75101", "PARIS", "2,36", "48,86", "interpolation", "1"),
    entry("b3", "f1", "14", "bis", "Rue Victor Hugo", "75001", "75101", "Paris", "2,37", "48,87", "housenumber", "1"),
    entry("b4", "f2", "3", None, "Avenue Foch", "75001", "75101", "Paris", "2,30", "48,80", "housenumber", "0"),
    entry("b5", None, None, None, None, "20000", "2A004", "Ajaccio", "8,73", "41,92", "municipality", "0"),
    entry("b6", "f9", "1", None, "Rue A", "97100", "97105", "Basse-Terre", "-61,73", "16,00", "housenumber", "1"),
    entry("b7", "f3", "5", None, "Rue B", "69001", "69381", "Lyon", "abc", "45,7", "housenumber", "1"),
    entry("b8", "f4", "7", None, "Place C", None, "13055", "Marseille", "5,4", "43,3", "housenumber", "1"),
]

SALES = [
    at(" 12", "rue", "Victor   Hugo", "75001", "Paris ", "75"),
    at("12", "RUE", "VICTOR HUGO", "75001", "PARIS", "75"),
    at(None, None, None, "20000", "AJACCIO", "2A"),
    at("14", "RUE", "VICTOR HUGO", "75001", "PARIS", "75"),
    at("3", "AV", "FOCH", "75001", "PARIS", "75"),
    at("99", "RUE", "VICTOR HUGO", "75001", "PARIS", "75"),
    at("1", "QUAI", "X", "75001", "PARIS", "75"),
    at("1", "RUE", "A", "97100", "BASSE-TERRE", "971"),
    at("5", "RUE", "B", "69001", "LYON", "69"),
    at("7", "PL", "C", None, "MARSEILLE", "13"),
]

# Number, street, commune -> level, register id, longitude, latitude, quality.
MATCHES = {
    ("12", "VICTOR HUGO", "PARIS"): ("EXACT", "b1", 2.35, 48.85, 100.0),
    (None, None, "AJACCIO"): ("EXACT", "b5", 8.73, 41.92, 20.0),
    ("14", "VICTOR HUGO", "PARIS"): ("SANS_TYPE", "b3", 2.37, 48.87, 110.0),
    ("3", "FOCH", "PARIS"): ("SANS_TYPE", "b4", 2.30, 48.80, 100.0),
    ("99", "VICTOR HUGO", "PARIS"): ("VOIE_SEULE", "b3", 2.37, 48.87, 110.0),
    ("1", "X", "PARIS"): ("CODE_POSTAL", None, 2.345, 48.845, 100.0),
    ("1", "A", "BASSE-TERRE"): ("NO_MATCH", None, None, None, None),
    ("5", "B", "LYON"): ("NO_MATCH", None, None, None, None),
}


def sales(spark, rows):
    return spark.createDataFrame(rows, SALES_SCHEMA)


def register(spark, rows=REGISTER):
    return spark.createDataFrame(rows, REGISTER_SCHEMA)
