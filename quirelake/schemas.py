"""Table layouts of the layers and of the warehouse.

Column names, defaults, widths and source names are fixed values: they are
what the surrounding jobs and dashboards expect.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Required Bronze columns with the default used when a whole batch lacks one.
BOOK_COLUMNS = {
    "titre": None,
    "auteur": None,
    "prix": None,
    "note_etoiles": None,
    "disponibilite": "unknown",
    "categorie": "Unknown",
    "description": None,
    "isbn": None,
    "nb_avis": "0",
    "langue": None,
    "annee_publication": None,
    "url": None,
    "source": None,
    "date_scraping": None,
}

BOOK_RAW = T.StructType([T.StructField(name, T.StringType()) for name in BOOK_COLUMNS])

# Types of the cleaned columns; the ones not named stay text.
SILVER_TYPES = {
    "prix": "double",
    "note_etoiles": "double",
    "nb_avis": "bigint",
    "annee_publication": "int",
    "date_scraping": "timestamp",
    "qualite_score": "int",
}

SILVER_COLUMNS = [*BOOK_COLUMNS, "qualite_score", "date_silver", "source_layer"]
PARTITION_KEY = "categorie_key"


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(),
    "timestamp": T.TimestampType(), "boolean": T.BooleanType(), "date": T.DateType(),
}


def _struct(names: list[str], types: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[types.get(n, "string")]) for n in names])


SILVER = _struct([*SILVER_COLUMNS, PARTITION_KEY], SILVER_TYPES)

FLAT_COLUMNS = [
    "titre", "auteur", "prix", "note_etoiles", "categorie", "disponibilite", "isbn",
    "nb_avis", "langue", "annee_publication", "source", "qualite_score", "date_scraping", "url",
]

_GOLD_TYPES = {
    **SILVER_TYPES,
    "nb_livres": "bigint", "prix_moyen": "double", "prix_min": "double", "prix_max": "double",
    "note_moyenne": "double", "total_avis": "bigint", "rang": "int", "nb_avis_total": "bigint",
    "annee_min": "int", "annee_max": "int",
}

GOLD_COLUMNS = {
    "kpi_par_categorie": [
        "categorie", "nb_livres", "prix_moyen", "prix_min", "prix_max", "note_moyenne",
        "total_avis", "source", "date_gold",
    ],
    "distribution_notes": ["note_etoiles", "categorie", "nb_livres", "prix_moyen", "source", "date_gold"],
    "top_livres_chers": [
        "categorie", "rang", "titre", "auteur", "prix", "note_etoiles", "isbn", "url", "source", "date_gold",
    ],
    "kpi_par_auteur": [
        "auteur", "nb_livres", "nb_avis_total", "annee_min", "annee_max", "source", "date_gold",
    ],
    "livres_flat": [*FLAT_COLUMNS, "date_gold"],
}

GOLD = {table: _struct(names, _GOLD_TYPES) for table, names in GOLD_COLUMNS.items()}

# Presentation order of each Gold table: (column, descending).
GOLD_ORDER = {
    "kpi_par_categorie": [("nb_livres", True), ("categorie", False)],
    "distribution_notes": [("categorie", False), ("note_etoiles", False)],
    "top_livres_chers": [("categorie", False), ("rang", False)],
    "kpi_par_auteur": [("nb_avis_total", True), ("auteur", False)],
    "livres_flat": [],
}

# Source labels as they appear inside the rows and in the folders.
SHOP_SITE = "books.toscrape.com"
LIBRARY_SITE = "openlibrary.org"
VOLUME_SITE = "google_books"
SHOP_FOLDER = "books_toscrape_com"
LIBRARY_FOLDER = "openlibrary_org"
EVENT_TOPIC = "books.raw.events"

STAR = {
    "dim_livre": _struct(["id_livre", "titre", "auteur", "url"], {}),
    "dim_categorie": _struct(["id_categorie", "nom_categorie"], {}),
    "dim_source": _struct(["id_source", "nom_site"], {}),
    "dim_disponibilite": _struct(["id_dispo", "est_disponible"], {"est_disponible": "boolean"}),
    "dim_date": _struct(["id_date", "date_val"], {"date_val": "date"}),
    "fact_scraping": _struct(
        ["id", "fk_livre", "fk_categorie", "fk_source", "fk_dispo", "fk_date",
         "prix", "note_etoiles", "nb_avis", "qualite_score"],
        {"prix": "double", "note_etoiles": "double", "nb_avis": "bigint", "qualite_score": "int"},
    ),
}
