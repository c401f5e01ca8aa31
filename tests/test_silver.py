from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from quirelake.operators import cleaning, dedup, quarantine
from quirelake.schemas import BOOK_COLUMNS, BOOK_RAW
from quirelake.sources import bronze, tables

RUN = "2026-05-01T10:00:00Z"


def books(spark, *rows):
    return spark.createDataFrame([tuple(r.get(c) for c in BOOK_COLUMNS) for r in rows], BOOK_RAW)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_latest_by_brute_force(spark):
    rng = random.Random(7)
    rows = [
        (rng.choice([None, *range(12)]), rng.choice([None, *range(30)]), rng.randint(0, 5), f"p{i}")
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "k int, d int, tie int, payload string")
    best: dict = {}
    for k, d, tie, payload in rows:
        rank = (d is not None, d or 0, tie, payload)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, d, tie, payload))
    kept = dedup.keep_latest(df, "k", "d", ties=[F.col("tie"), F.col("payload")])
    assert kept.columns == df.columns
    assert {tuple(r) for r in kept.collect()} == {row for _, row in best.values()}
    report = dedup.duplicate_report(df, "k").first()
    assert (report.rows_read, report.rows_kept, report.duplicates) == (3000, 13, 2987)


def test_ties_do_not_depend_on_row_order(spark):
    rows = [("u", "2026-01-01", f"t{i}", {"a": str(i)}) for i in range(50)]
    schema = "url string, d string, titre string, extra map<string,string>"
    first = dedup.keep_latest(spark.createDataFrame(rows, schema), "url", "d").collect()
    second = dedup.keep_latest(spark.createDataFrame(rows[::-1], schema).repartition(7), "url", "d").collect()
    assert first == second and len(first) == 1


def test_keep_latest_is_idempotent_and_counts_versions(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), (None, 3), ("b", None)], "url string, d int")
    once = dedup.keep_latest(df, "url", "d")
    assert sorted(map(tuple, once.collect()), key=str) == sorted(
        map(tuple, dedup.keep_latest(once, "url", "d").collect()), key=str
    )
    versions = dedup.latest_versions(df, "url", "d")
    assert {(r.url, r.d, r.n_versions) for r in versions.collect()} == {("a", 2, 2), (None, 3, 2), ("b", None, 1)}


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS url", "id AS d")
    assert plan(dedup.keep_latest(df, "url", "d")).count("partial_max_by") == 1
    fresh = plan(dedup.new_keys(df, df.filter("d > 5"), "url"))
    assert "partial_max_by" in fresh and "CartesianProduct" not in fresh


def test_new_keys(spark):
    new = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "url string")
    seen = spark.createDataFrame([("a",), ("a",), (None,)], "url string")
    assert sorted(r.url for r in dedup.new_keys(new, seen, "url").collect()) == ["b", "c"]
    assert sorted(r.url for r in dedup.new_keys(new, seen.limit(0), "url").collect()) == ["a", "b", "c"]


def test_newest_version_without_title_hides_older_ones(spark):
    df = books(
        spark,
        {"titre": "Old", "url": "u1", "date_scraping": "2026-01-01T00:00:00+00:00"},
        {"titre": "  ", "url": "u1", "date_scraping": "2026-02-01T00:00:00+00:00"},
        {"titre": "Fine", "url": "u2", "date_scraping": "bad"},
    )
    latest = dedup.keep_latest(df.withColumn("at", F.try_to_timestamp("date_scraping")), "url", "at")
    valid, untitled = quarantine.split_untitled(latest)
    assert [r.url for r in valid.collect()] == ["u2"]
    assert [r.url for r in untitled.collect()] == ["u1"]


def test_split_loses_no_row(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), (" ",)], "titre string")
    valid, bad = quarantine.split(df, F.col("titre") == "a")
    assert valid.count() + bad.count() == 4


def test_shop_and_library_rules(spark):
    df = books(spark, {
        "titre": "Blue Lamp", "auteur": "Unknown", "prix": "£51.77", "note_etoiles": "3",
        "disponibilite": "In stock (22 available)", "categorie": "Add a comment", "isbn": " ", "nb_avis": "4",
        "annee_publication": "1999", "url": "u", "description": "a\r\nb", "date_scraping": "2026-05-01T10:00:00+00:00",
    })
    shop = cleaning.to_silver(df, cleaning.clean_shop, RUN).first()
    assert (shop.prix, shop.auteur, shop.disponibilite, shop.categorie, shop.isbn, shop.langue) == (
        51.77, None, "available", "Unknown", None, "en",
    )
    assert (shop.note_etoiles, shop.nb_avis, shop.annee_publication, shop.qualite_score) == (3.0, 4, 1999, 70)
    assert (shop.date_silver, shop.source_layer, shop.categorie_key, shop.description) == (RUN, "silver", "Unknown", "a\r\nb")
    library = cleaning.to_silver(df, cleaning.clean_library, RUN).first()
    assert (library.prix, library.langue, library.description, library.qualite_score) == (None, None, "a b", 50)


def test_absent_columns_get_defaults_and_extras_stay(spark):
    df = spark.createDataFrame([("t", None, "x")], "titre string, categorie string, autre string")
    row = cleaning.align(df).first()
    assert (row.nb_avis, row.disponibilite, row.categorie, row.autre, row.url) == ("0", "unknown", None, "x", None)


LINES = [
    '{"titre":"A","prix":12.50,"nb_avis":3,"autre":{"x":[1]},"note_etoiles":null}',
    '{"titre":"broken"',
    "",
    "   ",
    '["a"]',
    '{"titre":"x"} trailing',
    '{"titre":"first","titre":"last"}',
    '  {"titre":"é"}  ',
]


def write_lines(folder, name="part.json"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(LINES), encoding="utf-8")
    return str(folder)


def test_lines_are_read_tolerantly(spark, tmp_path):
    write_lines(tmp_path / "a" / "b")
    (tmp_path / "note.txt").write_text("not json")
    (tmp_path / "bytes.json").write_bytes(b'{"titre":"\xff\xfe"}\n{"titre":"ok"}\n')
    rows = bronze.parse_lines(bronze.read_lines(spark, str(tmp_path))).collect()
    good = sorted(r.titre for r in rows if r[bronze.CORRUPT] is None and r.titre.isascii() and len(r.titre) < 6)
    assert good == ["A", "last", "ok"]
    corrupt = sorted(r[bronze.CORRUPT] for r in rows if r[bronze.CORRUPT] and "�" not in r[bronze.CORRUPT])
    assert corrupt == sorted([LINES[1], LINES[4], LINES[5]])
    first = next(r for r in rows if r.titre == "A")
    assert (first.prix, first.nb_avis, first.note_etoiles) == ("12.5", "3", None)
    assert json.loads(first[bronze.EXTRAS]["autre"]) == {"x": [1]}


def test_read_keeps_unknown_fields(spark, tmp_path):
    write_lines(tmp_path)
    df = bronze.read_bronze(spark, str(tmp_path), extras=["autre"])
    assert "autre" in df.columns and set(BOOK_COLUMNS) <= set(df.columns)
    rows = {r.titre: r for r in df.filter(F.col(bronze.CORRUPT).isNull()).collect()}
    assert set(rows) == {"A", "last", "é"}
    assert (rows["A"].nb_avis, rows["é"].nb_avis, rows["é"].url) == ("3", None, None)
    assert rows["A"].autre == rows["A"][bronze.EXTRAS]["autre"]
    report = bronze.corrupt_report(df).first()
    assert (report.lignes_lues, report.lignes_ignorees) == (3, 3)


def test_keys_that_differ_in_case_stay_in_the_map(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"titre":"a","Titre":"b","new":"c"}\n')
    row = bronze.read_bronze(spark, str(tmp_path), extras=["Titre", "new"]).first()
    assert (row.titre, row.new, row[bronze.EXTRAS]["Titre"]) == ("a", "c", "b")


def test_unread_files_are_found(spark, tmp_path):
    write_lines(tmp_path / "a")
    (tmp_path / "empty.json").write_text("")
    assert bronze.skipped_files(spark, str(tmp_path)).count() == 0
    listed = spark.createDataFrame([("file:/x/a.json",), ("s3a://b/c.json",)], "path string")
    read = spark.createDataFrame([("file:///x/a.json",)], "path string")
    assert [r.path for r in bronze.missing_paths(listed, read).collect()] == ["s3a:/b/c.json"]


def test_the_last_of_equal_fields_wins(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"titre":"a","k":1,"titre":"b","k":2,"prix":"3"}\n{"titre":null}\n{}\n')
    rows = bronze.read_bronze(spark, str(tmp_path)).collect()
    assert sorted((str(r.titre), str(r.prix), str(r[bronze.EXTRAS])) for r in rows) == [
        ("None", "None", "{}"), ("None", "None", "{}"), ("b", "3", "{'k': '2'}"),
    ]
    assert all(r[bronze.CORRUPT] is None for r in rows)


def test_clean_batch_reports_no_corrupt_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"titre":"A"}\n')
    report = bronze.corrupt_report(bronze.read_bronze(spark, str(tmp_path))).first()
    assert (report.lignes_lues, report.lignes_ignorees) == (1, 0)


def test_landing_folders(spark, tmp_path):
    df = books(
        spark, {"titre": "a", "source": "books.toscrape.com", "categorie": "A/B C"}, {"titre": "b", "categorie": None}
    )
    at = F.lit("2026-05-01 23:10:00").cast("timestamp_ntz")
    bronze.land(df, str(tmp_path / "landed"), at)
    bronze.land(df, str(tmp_path / "landed"), at)
    folders = {str(p.parent.relative_to(tmp_path / "landed")) for p in (tmp_path / "landed").rglob("*.json")}
    assert folders == {
        "source_key=books_toscrape_com/ingest_hour=2026-05-01-23/categorie_key=A_B_C",
        "source_key=unknown/ingest_hour=2026-05-01-23/categorie_key=unknown",
    }
    assert bronze.parse_lines(bronze.read_lines(spark, str(tmp_path / "landed"))).count() == 4


def silver_rows(spark, *pairs):
    df = books(spark, *[{"titre": t, "url": t, "categorie": c} for t, c in pairs])
    return cleaning.to_silver(df, cleaning.clean_shop, RUN)


def test_other_partitions_stay(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_silver(silver_rows(spark, ("a", "X"), ("b", "Y")), path)
    tables.write_silver(silver_rows(spark, ("c", "X")), path)
    assert sorted((r.titre, r.categorie) for r in tables.read_silver(spark, path).collect()) == [("b", "Y"), ("c", "X")]


def test_labels_that_share_a_folder_name_all_stay(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_silver(silver_rows(spark, ("a", "A B"), ("b", "A_B"), ("c", "A/B")), path)
    assert sorted(r.categorie for r in tables.read_silver(spark, path).collect()) == ["A B", "A/B", "A_B"]


def test_absent_tables_read_as_empty(spark, tmp_path):
    assert tables.read_silver(spark, str(tmp_path / "none")).count() == 0
    assert tables.read_gold(spark, str(tmp_path), "kpi_par_auteur").columns[0] == "auteur"


def test_merged_read_keeps_added_columns(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_silver(silver_rows(spark, ("a", "X")), path)
    tables.write_silver(silver_rows(spark, ("b", "Y")).withColumn("autre", F.lit("z")), path)
    merged = tables.read_silver(spark, path, merge=True)
    assert {(r.titre, r.autre) for r in merged.collect()} == {("a", None), ("b", "z")}


def test_repeated_quarantine_run_replaces_itself(spark, tmp_path):
    df = books(spark, {"titre": None, "url": "u"})
    for _ in range(2):
        tables.write_quarantine(df, str(tmp_path), "shop", RUN)
    back = spark.read.option("recursiveFileLookup", True).schema(BOOK_RAW).json(str(tmp_path))
    assert [r.url for r in back.collect()] == ["u"]
