"""Projection of Gold tables onto the warehouse tables, and its rejects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.functions.numeric import safe_float, safe_int, safe_text


@dataclass(frozen=True)
class Field:
    """Target column: `kind` text / int / float; text may be cut to its width."""

    name: str
    kind: str
    width: int | None = None
    default: str | None = None
    cut: bool = False

    @property
    def ddl(self) -> str:
        types = {"int": "INTEGER", "float": "FLOAT"}
        return f"{self.name} {types.get(self.kind) or f'VARCHAR({self.width})'}"


def _text(name, width, default="", cut=False):
    return Field(name, "text", width, default, cut)


def _int(name):
    return Field(name, "int")


def _float(name):
    return Field(name, "float")


# Warehouse columns with widths and defaults.
WAREHOUSE = {
    "kpi_par_categorie": [
        _text("categorie", 100, "Unknown"), _int("nb_livres"), _float("prix_moyen"), _float("prix_min"),
        _float("prix_max"), _float("note_moyenne"), _int("total_avis"), _text("source", 100), _text("date_gold", 30),
    ],
    "distribution_notes": [
        _float("note_etoiles"), _text("categorie", 100, "Unknown"), _int("nb_livres"), _float("prix_moyen"),
        _text("source", 100), _text("date_gold", 30),
    ],
    "top_livres_chers": [
        _text("categorie", 100, "Unknown"), _int("rang"), _text("titre", 500, cut=True),
        _text("auteur", 300, cut=True), _float("prix"), _float("note_etoiles"), _text("isbn", 20, cut=True),
        _text("url", 500, cut=True), _text("source", 100), _text("date_gold", 30),
    ],
    "kpi_par_auteur": [
        _text("auteur", 300, "Unknown", cut=True), _int("nb_livres"), _int("nb_avis_total"),
        _float("annee_min"), _float("annee_max"), _text("source", 100), _text("date_gold", 30),
    ],
    "livres_flat": [
        _text("titre", 500, cut=True), _text("auteur", 300, cut=True), _float("prix"), _float("note_etoiles"),
        _text("categorie", 100, "Unknown"), _text("disponibilite", 50, "unknown"), _text("isbn", 20, cut=True),
        _int("nb_avis"), _text("langue", 10, "en", cut=True), _float("annee_publication"), _text("source", 100),
        _float("qualite_score"), _text("date_scraping", 50), _text("url", 500, cut=True), _text("date_gold", 30),
    ],
}

_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def _cell(df: DataFrame, field: Field) -> Column:
    if field.name not in df.columns:
        c = F.lit(None).cast("string")
    elif df.schema[field.name].dataType.simpleString().startswith("timestamp"):
        c = F.date_format(field.name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    else:
        c = F.col(field.name)
    if field.kind == "float":
        return safe_float(c)
    if field.kind == "int":
        return safe_int(c)
    text = safe_text(c, field.default)
    return F.substring(text, 1, field.width) if field.cut else text


def project(df: DataFrame, table: str) -> DataFrame:
    """The rows as the warehouse takes them: defaults, rounding, cut texts."""
    return df.select(*[_cell(df, f).alias(f.name) for f in WAREHOUSE[table]])


def column_types(table: str) -> str:
    """For the writer's `createTableColumnTypes`; the row id is left to the database."""
    return ", ".join(f.ddl for f in WAREHOUSE[table])


def _problem(field: Field) -> Column:
    c = F.col(field.name)
    if field.kind == "text":
        return F.when(F.length(c) > field.width, f"{field.name}: longer than {field.width}")
    if field.kind == "int":
        return F.when(~c.between(_INT_MIN, _INT_MAX), f"{field.name}: out of range")
    return F.lit(None).cast("string")


def _checked(projected: DataFrame, table: str) -> DataFrame:
    reasons = F.array_compact(F.array(*[_problem(f) for f in WAREHOUSE[table]]))
    return projected.withColumn("reasons", F.array_join(reasons, "; "))


def split_rejects(projected: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(loadable, rejected with reasons). A bulk write fails as a whole on one
    bad row, so rows the database would refuse are taken out first."""
    checked = _checked(projected, table)
    return checked.filter("reasons = ''").drop("reasons"), checked.filter("reasons <> ''")


def load_report(projected: DataFrame, table: str) -> DataFrame:
    loadable = F.col("reasons") == ""
    return _checked(projected, table).agg(
        F.count_if(loadable).alias("chargees"), F.count_if(~loadable).alias("erreurs")
    )
