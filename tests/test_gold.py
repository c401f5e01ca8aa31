from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from quirelake.operators import dashboard, gold, gold_delta, profiles, quality, star, warehouse
from quirelake.schemas import GOLD_COLUMNS
from quirelake.sources import tables
from tests.compare import differences, duck
from tests.test_silver import plan

SF_DIR = "/root/testdata/sf0.001"

COLUMNS = "categorie string, titre string, prix double, note_etoiles double, nb_avis bigint, url string"


def test_kpi_skips_null_keys_and_sums_nulls_to_zero(spark):
    rows = [
        ("A", "t", 10.0, None, None, "u1"), ("A", None, None, None, None, "u2"), (None, "t", 1.0, 1.0, 1, "u3"),
        ("B", "t", 2.345, 4.0, 2, "u4"),
    ]
    kpi = {r.categorie: r for r in gold.kpi_by_category(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert set(kpi) == {"A", "B"}
    assert (kpi["A"].nb_livres, kpi["A"].prix_moyen, kpi["A"].note_moyenne, kpi["A"].total_avis) == (1, 10.0, None, 0)
    assert (kpi["B"].prix_min, kpi["B"].prix_max, kpi["B"].total_avis) == (2.35, 2.35, 2)


def test_distribution_drops_null_ratings(spark):
    rows = [("A", "t", 10.0, None, 1, "u"), ("A", "t", 10.0, 3.0, 1, "u"), ("A", "t", 20.0, 3.0, 1, "u")]
    found = gold.rating_distribution(spark.createDataFrame(rows, COLUMNS)).collect()
    assert [tuple(r) for r in found] == [(3.0, "A", 2, 15.0)]


def test_top_by_price_by_brute_force(spark):
    rng = random.Random(11)
    rows = [
        (rng.choice(["hot"] * 8 + ["A", "B", None]), f"t{i}", rng.choice([None, *map(float, range(40))]), 1.0, 1, f"u{i:04}")
        for i in range(3000)
    ]
    expected = set()
    for category in ("hot", "A", "B"):
        priced = [r for r in rows if r[0] == category and r[2] is not None]
        for rank, r in enumerate(sorted(priced, key=lambda r: (-r[2], r[5]))[:10], start=1):
            expected.add((category, rank, r[1], r[2]))
    top = gold.top_by_price(spark.createDataFrame(rows, COLUMNS).repartition(8), columns=("titre", "prix"))
    assert plan(top).count("WindowGroupLimit") == 2
    assert {tuple(r) for r in top.collect()} == expected


def test_kpi_over_a_joined_dimension_equals_the_plain_one(spark):
    rng = random.Random(13)
    facts = [(rng.choice([None, 1, 1, 1, 2, 3, 99]), f"t{i}", i / 8, rng.choice([None, 4.0]), i) for i in range(800)]
    fact = spark.createDataFrame(facts, "fk int, titre string, prix double, note_etoiles double, nb_avis bigint")
    dim = spark.createDataFrame([(1, "A"), (2, "B"), (3, "A"), (4, "C"), (5, None)], "id int, genre string")
    names = dict(category="genre", title="titre", price="prix", rating="note_etoiles", reviews="nb_avis")
    fast = gold.kpi_by_dimension(fact, dim, "fk", "id", **names)
    slow = gold.kpi_by_category(fact.join(dim, F.col("fk") == F.col("id")), **names)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))


def test_authors_and_flat_view(spark):
    rows = [("Ann", "t", 3, 1950), ("Ann", "u", None, None), (None, "v", 9, 1900), ("Bob", "w", None, 2000)]
    df = spark.createDataFrame(rows, "auteur string, titre string, nb_avis bigint, annee_publication int")
    assert sorted(map(tuple, gold.kpi_by_author(df).collect())) == [("Ann", 2, 3, 1950, 1950), ("Bob", 1, 0, 2000, 2000)]
    flat = gold.flat_view(df, df.select("auteur", F.lit("x").alias("url")), run_ts="now")
    assert flat.count() == 8 and flat.filter("url IS NULL").count() == 4 and "date_gold" in flat.columns


def test_order_of_gold_tables(spark):
    df = spark.createDataFrame([("B", 1), ("A", 1), ("C", 5)], "categorie string, nb_livres int")
    assert [r.categorie for r in gold.in_order(df, "kpi_par_categorie").collect()] == ["C", "A", "B"]


def tiny_star(spark):
    silver = spark.createDataFrame(
        [
            ("T1", "Ann", "u1", "A", "s1", "available", "2026-05-01 10:00:00", 10.0, 5.0, 1, 100),
            ("T2", None, "u2", "A", "s2", "unknown", "2026-05-01 11:00:00", 20.0, 4.0, 9, 60),
            ("T3", "Bob", "u3", "B", "s1", "available", "2026-05-02 10:00:00", None, None, 2, 40),
        ],
        "titre string, auteur string, url string, categorie string, source string, disponibilite string, d string, "
        "prix double, note_etoiles double, nb_avis bigint, qualite_score int",
    ).withColumn("date_scraping", F.to_timestamp("d"))
    return star.star_from_silver(silver)


def test_star_built_from_silver(spark):
    s = tiny_star(spark)
    assert {n: d.count() for n, d in s.items()} == {
        "dim_livre": 3, "dim_categorie": 2, "dim_source": 2, "dim_disponibilite": 2, "dim_date": 2, "fact_scraping": 3,
    }
    stats = {r.genre: r for r in star.genre_stats(s["fact_scraping"], s["dim_categorie"], s["dim_disponibilite"]).collect()}
    assert tuple(stats["A"]) == ("A", 2, 15.0, 10.0, 20.0, 4.5, 50.0)
    assert tuple(stats["B"]) == ("B", 1, None, None, None, None, 100.0)
    volumes = star.timeline(s["fact_scraping"], s["dim_date"], s["dim_source"]).collect()
    assert [(str(r.date_val), r.nom_site, r.nb_livres) for r in volumes] == [
        ("2026-05-02", "s1", 1), ("2026-05-01", "s1", 1), ("2026-05-01", "s2", 1),
    ]
    assert tuple(star.global_kpis(s["fact_scraping"]).first()) == (3, 15.0, 4.5, 2, 2)


def test_best_rated_needs_all_dimension_rows(spark):
    s = tiny_star(spark)
    books = s["dim_livre"].filter("titre <> 'T1'")
    args = (s["dim_categorie"], s["dim_source"])
    assert [r.titre for r in star.top_rated(s["fact_scraping"], books, *args).collect()] == ["T2"]
    complete = star.top_rated(s["fact_scraping"], s["dim_livre"], *args, keys_complete=True)
    assert [r.titre for r in complete.collect()] == ["T1", "T2"]


def ranked_expected(facts, dims, n):
    """(note, reviews, id) of the best facts whose keys all have a row."""
    found = [f for f in facts if f[4] is not None and all(f[i + 1] in d for i, d in enumerate(dims))]
    return [(f[4], f[5], f[0]) for f in sorted(found, key=lambda f: (-f[4], f[5] is None, -(f[5] or 0), f[0]))][:n]


@pytest.mark.parametrize("scores", [1000, 3])
def test_best_rated_among_many_that_match_nothing(spark, monkeypatch, scores):
    """Hundreds of better facts match no row, ties and nulls stand at the cutoff; only facts down to it are joined."""
    monkeypatch.setattr(star, "SCORES", scores)
    rng = random.Random(12)
    facts = [(i, f"x{i}", "c", "s", float(rng.randint(6, 9)), rng.choice([None, 1, 2])) for i in range(600)]
    facts += [(1000 + i, f"b{rng.randint(0, 5)}", rng.choice("cde"), "s", float(rng.randint(1, 5)), rng.choice([None, 0, 7])) for i in range(300)]
    facts += [(2000, "b1", "c", "s", None, 9), (2001, "b1", "c", None, 9.0, 9), (2002, None, "c", "s", 9.0, 9)]
    rows = spark.createDataFrame(
        [(*f[:4], 1.0, *f[4:]) for f in facts],
        "id bigint, fk_livre string, fk_categorie string, fk_source string, prix double, note_etoiles double, nb_avis bigint",
    )
    books = spark.createDataFrame([(f"b{i}", f"T{i}", "A") for i in range(5)], "id_livre string, titre string, auteur string")
    kinds = spark.createDataFrame([("c", "C"), ("d", "D")], "id_categorie string, nom_categorie string")
    sites = spark.createDataFrame([("s", "S")], "id_source string, nom_site string")
    dims = [{f"b{i}" for i in range(5)}, {"c", "d"}, {"s"}]
    for n in (1, 10, 250):
        best = star.top_rated(rows, books, kinds, sites, n=n)
        expected = [(note, reviews) for note, reviews, _ in ranked_expected(facts, dims, n)]
        assert [(r.note_etoiles, r.nb_avis) for r in best.collect()] == expected
    assert star.top_rated(rows, books.limit(0), kinds, sites).count() == 0


def test_facts_below_the_cutoff_are_not_read_into_the_join(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(1000).selectExpr(
        "id", "CAST(id % 7 AS string) AS fk_livre", "'c' AS fk_categorie", "'s' AS fk_source", "1.0D AS prix",
        "CAST(id DIV 100 AS double) AS note_etoiles", "id % 10 AS nb_avis",
    ).write.parquet(path)
    books = spark.createDataFrame([(str(i), "T", "A") for i in range(7)], "id_livre string, titre string, auteur string")
    kinds = spark.createDataFrame([("c", "C")], "id_categorie string, nom_categorie string")
    sites = spark.createDataFrame([("s", "S")], "id_source string, nom_site string")
    best = star.top_rated(spark.read.parquet(path), books, kinds, sites)
    assert "GreaterThanOrEqual(note_etoiles,9.0)" in plan(best)
    assert [(r.note_etoiles, r.nb_avis) for r in best.collect()] == [(9.0, 9)] * 10


def test_surrogate_keys(spark):
    df = spark.createDataFrame([("a", "b"), ("a,b", ""), ("a", None)], "x string, y string")
    keys = [r[0] for r in df.select(star.surrogate_key("x", "y")).collect()]
    assert keys[2] is None and len({k for k in keys if k}) == 2


def test_dimension_plans_have_no_forced_broadcast(spark):
    s = tiny_star(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stats = star.genre_stats(s["fact_scraping"], s["dim_categorie"], s["dim_disponibilite"])
        assert "BroadcastHashJoin" not in plan(stats) and "SortMergeJoin" in plan(stats)
        assert stats.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rules_and_profiles(spark):
    fact = spark.createDataFrame([(1.0, 5.0, 50), (-1.0, 6.0, 51), (None, None, None)], "prix double, note_etoiles double, qualite_score int")
    books = spark.createDataFrame([("t", "u"), ("", None), (None, "u")], "titre string, url string")
    report = {r.regle: (r.resultat, r.statut) for r in quality.check_star(fact, books).collect()}
    assert report == {
        "Livres sans titre": (2, "ECHEC"), "URLs manquantes": (1, "ECHEC"), "Prix negatifs": (1, "ECHEC"),
        "Notes hors plage": (1, "ECHEC"),
    }
    assert quality.star_totals(fact, books).first().asDict() == {"total_faits": 3, "score_moyen": 50.5, "total_livres": 3}
    nulls = {r.colonne: (r.nulls, r.pct) for r in quality.null_profile(fact).collect()}
    assert nulls == {"prix": (1, 33.3), "note_etoiles": (1, 33.3), "qualite_score": (1, 33.3)}
    assert [r["count"] for r in quality.score_histogram(fact).collect()] == [0, 0, 2, 0, 0]
    assert quality.residue_profile(fact).first().asDict() == {"total": 3, "prix_renseignes": 2, "prix_negatifs": 1}
    assert [r.regle for r in quality.check_rules(books, [quality.Rule("x", F.col("titre") == "t", 1)]).filter("statut = 'OK'").collect()] == ["x"]


def test_dashboard_means_are_unweighted(spark):
    kpi = spark.createDataFrame([("A", 9, 10.0, 4.0), ("B", 1, 20.0, None)], "categorie string, nb_livres int, prix_moyen double, note_moyenne double")
    flat = spark.range(10)
    assert tuple(dashboard.headline(kpi, flat).first()) == (10, 15.0, 4.0, 2)
    assert dashboard.headline(kpi.limit(0), flat.limit(0)).first().total_livres == 0


def test_warehouse_projection_and_rejects(spark):
    rows = [("x" * 101, "t" * 600, 2.675, None), ("ok", None, float("nan"), 2**31)]
    df = spark.createDataFrame(rows, "categorie string, titre string, prix double, nb_avis bigint")
    projected = warehouse.project(df, "livres_flat")
    assert projected.columns == [f.name for f in warehouse.WAREHOUSE["livres_flat"]]
    first, second = sorted(projected.collect(), key=lambda r: r.categorie, reverse=True)
    assert (len(first.titre), first.prix, first.nb_avis, first.langue, first.url) == (500, 2.67, 0, "en", "")
    assert (second.prix, second.titre) == (None, "")
    good, bad = warehouse.split_rejects(projected, "livres_flat")
    assert good.count() == 0
    assert sorted(r.reasons for r in bad.collect()) == ["categorie: longer than 100", "nb_avis: out of range"]
    assert tuple(warehouse.load_report(projected, "livres_flat").first()) == (0, 2)
    assert "titre VARCHAR(500)" in warehouse.column_types("livres_flat")
    assert list(GOLD_COLUMNS) == list(warehouse.WAREHOUSE)


def test_load_sends_good_rows_and_returns_the_others(spark, tmp_path):
    df = spark.createDataFrame([("ok", 1), ("x" * 101, 2)], "categorie string, nb_livres bigint")
    target = {"path": str(tmp_path / "warehouse")}
    rejected = tables.load_warehouse(df, "kpi_par_categorie", target, fmt="parquet")
    assert [r.nb_livres for r in rejected.collect()] == [2]
    assert [(r.categorie, r.nb_livres, r.source) for r in spark.read.parquet(target["path"]).collect()] == [("ok", 1, "")]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_one_program_for_all_sizes(spark, threshold):
    """The same rows whether Spark broadcasts the dimensions or not."""
    import __spark_entry__ as driver

    names = [
        "star_genre_stats", "star_daily_volumes", "bi_timeline", "bi_top_genres", "bi_source_compare", "bi_top_rated",
        "gold_kpi_category", "gold_kpi_shared_name",
    ]
    connection = duck(SF_DIR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for name in names:
            assert differences(driver.queries()[name](spark, SF_DIR), connection, driver.oracle_sql()[name]) == ""
        text = plan(driver.queries()["bi_top_rated"](spark, SF_DIR))
        assert "WindowGroupLimit" in text and "CartesianProduct" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_united_profiles_equal_one_pass(spark):
    """Days that are profiled one by one and united are the same as all rows at once, and quantiles keep their error."""
    rng = random.Random(3)
    values = [rng.choice([None, 0.0, float("nan"), -rng.random() * 1e6, rng.lognormvariate(0, 8), float(rng.randint(1, 50))]) for _ in range(4000)]
    rows = spark.createDataFrame([(f"2026-05-0{1 + i % 5}", v) for i, v in enumerate(values)], "d string, v double")
    rows = rows.selectExpr("CAST(d AS date) AS d", "v")
    whole = rows.selectExpr("DATE '2026-01-01' AS d", "v")

    def exact(df):
        return [tuple(r) for r in profiles.united(profiles.day_profiles(df, "d", ["v"])).collect()]

    (days,), (once,) = exact(rows), exact(whole)
    assert repr(days[:-1]) == repr(once[:-1])
    distinct = len({repr(v) for v in values if v is not None})
    assert abs(days[-1] - distinct) < 0.06 * distinct and abs(once[-1] - distinct) < 0.06 * distinct
    shares = [0.0, 0.01, 0.3, 0.5, 0.77, 0.999, 1.0]

    def places(df):
        return {r["share"]: r["value"] for r in profiles.quantiles(profiles.day_histograms(df, "d", ["v"]), shares).collect()}

    found = places(rows)
    assert found == places(whole)
    ordered = sorted(v for v in values if v is not None and v == v)
    for share in shares:
        real = ordered[max(math.ceil(share * len(ordered)), 1) - 1]
        assert abs(found[share] - real) <= profiles.ERROR * abs(real) * (1 + 1e-9)
    assert profiles.united(profiles.day_profiles(rows.limit(0), "d", ["v"])).count() == 0


def test_state_after_retractions_equals_recomputation(spark):
    """Rows come, go, change price and category; extremes leave and return; categories vanish and come back."""
    rng = random.Random(8)
    schema = "url string, categorie string, titre string, prix double, note_etoiles double, nb_avis bigint"

    def book(i):
        return (
            f"u{i}", rng.choice(["a", "b", "c", None]), rng.choice(["t", None]), rng.choice([None, 1.25, 2.5, 9.75, float(rng.randint(0, 40))]),
            rng.choice([None, 1.0, 4.5]), rng.choice([None, 0, 7]),
        )

    rows = {i: book(i) for i in range(25)}
    state, before = spark.createDataFrame([], gold_delta.STATE), spark.createDataFrame([], schema)
    for step in range(5):
        after = spark.createDataFrame(list(rows.values()), schema)
        state = gold_delta.apply_changes(state, gold_delta.changes(before, after), after)
        state = spark.createDataFrame(state.collect(), gold_delta.STATE)
        got = sorted(map(tuple, gold_delta.kpi_of_state(state).collect()))
        assert got == sorted(map(tuple, gold.kpi_by_category(after).collect()))
        before = after
        for i in rng.sample(sorted(rows), 8):
            rows[i] = book(i)
        for i in rng.sample(sorted(rows), 4):
            del rows[i]
        rows |= {i: book(i) for i in range(100 * step + 100, 100 * step + 103)}
        if step == 2:
            rows = {i: r for i, r in rows.items() if r[1] != "a"}
