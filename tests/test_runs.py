"""Whole runs on a tiny lake, and streams."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.operators.cleaning import clean_shop
from quirelake.operators.dedup import keep_latest
from quirelake.plans import medallion
from quirelake.plans.catalogue import storage
from quirelake.session import scratch
from quirelake.sources import bronze, ledger, merge, snapshots, tables, visited
from quirelake.streaming import jobs

RUN = "2026-05-03T02:00:00Z"

SHOP = [
    {"titre": "Blue Lamp", "auteur": "Unknown", "prix": "£51.77", "note_etoiles": 3, "disponibilite": "In stock (2 available)",
     "categorie": "Poetry", "description": "d", "isbn": "a1", "langue": "en", "annee_publication": None, "url": "u1",
     "source": "books.toscrape.com", "date_scraping": "2026-05-01T10:00:00.123456+00:00"},
    {"titre": "Blue Lamp 2", "auteur": "Ann", "prix": "£10.00", "note_etoiles": 5, "disponibilite": "Out of stock",
     "categorie": "Poetry", "description": "d", "isbn": "a1", "langue": "en", "annee_publication": None, "url": "u1",
     "source": "books.toscrape.com", "date_scraping": "2026-05-02T10:00:00+00:00", "rayon": "7"},
    {"titre": "Old", "prix": "£1", "categorie": "Poetry", "url": "u2", "source": "books.toscrape.com",
     "date_scraping": "2026-05-01T10:00:00+00:00"},
    {"titre": " ", "prix": "£1", "categorie": "Poetry", "url": "u2", "source": "books.toscrape.com",
     "date_scraping": "2026-05-02T10:00:00+00:00"},
    {"titre": "Red Hat", "prix": "£20.00", "note_etoiles": 1, "categorie": "default", "url": "u3",
     "source": "books.toscrape.com", "date_scraping": "bad"},
]
LIBRARY = [
    {"titre": "Red Door", "auteur": "Ann Lee", "prix": "9", "note_etoiles": None, "disponibilite": "N/A",
     "categorie": "Fiction", "description": "a\r\nb", "isbn": "978", "nb_avis": 12, "langue": "eng",
     "annee_publication": 1954, "url": "l1", "source": "openlibrary.org", "date_scraping": "2026-05-01T10:00:00+00:00"},
]


@pytest.fixture
def lake(tmp_path):
    config = medallion.layout(str(tmp_path))
    for source, rows in ((config.shop, SHOP), (config.library, LIBRARY)):
        folder = tmp_path / "bronze" / "books" / source.bronze.rsplit("/", 1)[1] / "2026" / "05"
        folder.mkdir(parents=True)
        lines = [json.dumps(r, ensure_ascii=False) for r in rows] + ["", "BROKEN"]
        (folder / "x.json").write_text("\n".join(lines), encoding="utf-8")
    return config


def test_whole_run(spark, lake):
    reports = medallion.run(spark, lake, RUN)
    shop = reports[lake.shop.name].first()
    assert (shop.rows_read, shop.rows_deduplicated, shop.rows_quarantined, shop.rows_written) == (5, 3, 1, 2)
    assert (shop.mean_score, shop.categories) == (75.0, 2)
    assert (shop.skipped_lines, shop.skipped_files) == (1, 0)
    corrupt = spark.read.option("recursiveFileLookup", True).schema("ligne string, n_versions int").json(f"{lake.quarantine}-corrupt")
    assert [tuple(r) for r in corrupt.collect()] == [("BROKEN", 1), ("BROKEN", 1)]

    silver = {r.url: r for r in tables.read_silver(spark, lake.shop.silver).collect()}
    assert set(silver) == {"u1", "u3"}
    assert (silver["u1"].titre, silver["u1"].auteur, silver["u1"].prix, silver["u1"].qualite_score) == ("Blue Lamp 2", "Ann", 10.0, 90)
    # no row of the batch has reviews, so the default of the absent column applies
    assert (silver["u3"].categorie, silver["u3"].nb_avis, silver["u3"].date_scraping, silver["u3"].langue) == ("Unknown", 0, None, "en")
    extras = tables.read_silver(spark, lake.shop.silver, merge=True).filter("url = 'u1'").first()
    assert extras["_extras"] == {"rayon": "7"}

    genres = snapshots.snapshot(spark, lake.star).table("agg_genre_stats").collect()
    assert sorted((r.genre, r.nb_livres, r.pct_disponible) for r in genres) == [
        ("Fiction", 1, 0.0), ("Poetry", 1, 0.0), ("Unknown", 1, 0.0),
    ]

    gold = {t: tables.read_gold(spark, lake.gold, t, ordered=True).collect() for t in medallion.GOLD_COLUMNS}
    assert [(r.categorie, r.nb_livres, r.prix_moyen, r.total_avis, r.source) for r in gold["kpi_par_categorie"]] == [
        ("Poetry", 1, 10.0, 0, "books_toscrape_com"), ("Unknown", 1, 20.0, 0, "books_toscrape_com"),
    ]
    assert [(r.categorie, r.note_etoiles, r.nb_livres) for r in gold["distribution_notes"]] == [("Poetry", 5.0, 1), ("Unknown", 1.0, 1)]
    assert [(r.categorie, r.rang, r.titre) for r in gold["top_livres_chers"]] == [("Poetry", 1, "Blue Lamp 2"), ("Unknown", 1, "Red Hat")]
    assert [(r.auteur, r.nb_avis_total, r.annee_min) for r in gold["kpi_par_auteur"]] == [("Ann Lee", 12, 1954)]
    assert sorted((r.titre, r.langue, r.prix) for r in gold["livres_flat"]) == [
        ("Blue Lamp 2", "en", 10.0), ("Red Door", "en", None), ("Red Hat", "en", 20.0),
    ]


def break_checksum(path):
    """The file's bytes no longer fit the checksum beside it, so reading it fails."""
    (path.parent / f".{path.name}.crc").write_bytes(b"crc\0" + (512).to_bytes(4, "big") + bytes(4))


def test_a_run_reads_bronze_once_and_silver_never(spark, lake, tmp_path, monkeypatch):
    """Files, lines and rows are counted where they are read or written; a file that cannot be read is named."""
    lost = tmp_path / "bronze" / "books" / lake.shop.bronze.rsplit("/", 1)[1] / "lost.json"
    lost.write_text(json.dumps(SHOP[0]))
    break_checksum(lost)
    reads = []

    def counted(spark, prefix, *rest):
        reads.append(prefix)
        return bronze.read_lines(spark, prefix, *rest)

    def forbidden(*_):
        raise AssertionError("Silver is read")

    monkeypatch.setattr(medallion, "read_lines", counted)
    monkeypatch.setattr(tables, "read_silver", forbidden)
    report = medallion.run_source(spark, lake.shop, lake, RUN).first()
    assert reads == [lake.shop.bronze]
    assert (report.rows_read, report.rows_written, report.skipped_lines, report.skipped_files) == (5, 2, 1, 1)
    assert (report.mean_score, report.categories, report.rows_quarantined) == (75.0, 2, 1)
    assert [r.path.rsplit("/", 1)[1] for r in bronze.skipped_files(spark, lake.shop.bronze).collect()] == ["lost.json"]


def test_visited_history_is_not_shuffled(spark, tmp_path):
    path, kind = str(tmp_path / "visited"), T.StructField("url", T.StringType())

    def feed(*urls):
        batch = spark.createDataFrame([(u,) for u in urls], "url string")
        fresh = visited.unvisited(batch, path, "url", buckets=4)
        text = fresh._jdf.queryExecution().executedPlan().toString()
        history = text[text.index("SortMergeJoin"):].split("+- ")[-3:]
        assert "Bucketed: true" in text and "Exchange" not in "".join(history)
        visited.append_visited(fresh, path, "url")
        return sorted(r.url for r in visited.read_visited(spark, path, kind).collect())

    assert feed("a", "b", "b", None) == ["a", "b"]
    assert feed("b", "c") == ["a", "b", "c"]
    visited.compact_visited(spark, path, kind)
    assert feed("a", "c", "d") == ["a", "b", "c", "d"]
    visited.compact_visited(spark, path, kind)
    assert feed("d") == ["a", "b", "c", "d"]
    files = [f for f in (tmp_path / "visited" / "version=000002").iterdir() if f.suffix == ".parquet"]
    assert len(files) <= 4


def test_a_visited_set_keeps_its_number_of_buckets(spark, tmp_path):
    path = str(tmp_path / "visited")
    urls = [f"u{i}" for i in range(50)]
    batch = spark.createDataFrame([(u,) for u in urls], "url string")
    visited.append_visited(batch, path, "url", buckets=3)
    assert visited.unvisited(batch.union(spark.createDataFrame([("new",)], "url string")), path, "url", buckets=7).count() == 1


def frames(spark, value, *names):
    return {name: spark.createDataFrame([(value,)], "v int") for name in names}


def test_snapshots_are_whole_and_stay(spark, tmp_path):
    root = str(tmp_path / "star")
    assert snapshots.snapshot(spark, root).table("a", T.StructType([T.StructField("v", T.IntegerType())])).count() == 0
    first = snapshots.publish(spark, root, lambda v: v.write(frames(spark, 1, "a", "b")))
    making = snapshots.Publication(spark, root)
    making.write(frames(spark, 2, "a"))
    assert snapshots.snapshot(spark, root) == first  # tables that are written but not published
    making.write(frames(spark, 2, "b"))
    second = making.publish()

    def values(s):
        return [s.table(name).first().v for name in ("a", "b")]

    assert values(first) == [1, 1] and values(second) == [2, 2] and snapshots.snapshot(spark, root) == second

    def failing(version):
        version.write(frames(spark, 3, "a"))
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        snapshots.publish(spark, root, failing)
    assert snapshots.snapshot(spark, root) == second
    for value in (4, 5):
        snapshots.publish(spark, root, lambda v, value=value: v.write(frames(spark, value, "a", "b")), keep=2)
    assert sorted(p.name for p in (tmp_path / "star" / "versions").iterdir() if p.is_dir())[0] == second.version
    assert values(second) == [2, 2] and values(snapshots.snapshot(spark, root)) == [5, 5]


def test_files_are_read_once_and_dead_runs_do_not_count(spark, tmp_path):
    prefix, root = tmp_path / "in", str(tmp_path / "lake")
    prefix.mkdir()

    def put(name, *rows):
        (prefix / name).write_text("\n".join(json.dumps(r) if isinstance(r, dict) else r for r in rows))

    def versions():
        return sorted((r.url, r.titre, r.n_versions) for r in ledger.read_versions(spark, root).collect())

    assert ledger.ingest(spark, str(prefix), root) == 0 and versions() == []
    put("a.json", {"url": "u", "titre": "1", "date_scraping": "2026-05-01T00:00:00+00:00"}, "broken")
    assert ledger.ingest(spark, str(prefix), root) == 1
    put("b.json", {"url": "u", "titre": "2", "date_scraping": "2026-05-02T00:00:00+00:00"}, {"url": "w", "titre": "x"})
    dead = ledger.stage_run(spark, str(prefix), root)
    assert dead and versions() == [("u", "1", 1)]
    assert ledger.ingest(spark, str(prefix), root) == 1 and ledger.ingest(spark, str(prefix), root) == 0
    assert versions() == [("u", "2", 2), ("w", "x", 1)]
    assert not (tmp_path / "lake" / "rows" / dead).exists()
    page = {r.path.rsplit("/", 1)[1]: (r.lines, r.broken) for r in ledger.read_ledger(spark, root).collect()}
    assert page == {"a.json": (2, 1), "b.json": (2, 0)}
    put("a.json", {"url": "new", "titre": "y"}, {"url": "u", "titre": "0"}, {"url": "longer"})
    assert ledger.ingest(spark, str(prefix), root) == 1  # another length: the file is read again
    assert [v[0] for v in versions()] == ["longer", "new", "u", "w"]


def test_merged_rows_leave_their_old_partition(spark, tmp_path):
    path, index = str(tmp_path / "silver"), str(tmp_path / "index")
    schema = T.StructType([
        T.StructField("url", T.StringType()), T.StructField("titre", T.StringType()), T.StructField("categorie_key", T.StringType()),
        T.StructField("date_scraping", T.TimestampType()),
    ])

    def feed(*rows):
        batch = spark.createDataFrame([(u, t, c, dt.datetime(2026, 5, d)) for u, t, c, d in rows], schema)
        return merge.merge_silver(batch, path, index)

    def read():
        rows = tables.read_parquet(spark, path, merge.SILVER).collect()
        return sorted(((r.url, r.titre, r.categorie_key) for r in rows), key=repr)

    assert feed(("a", "1", "x", 1), ("b", "1", "x", 1), ("c", "1", "y", 1), (None, "n", "z", 1)) == ["x", "y", "z"]
    untouched = {f.name for f in (tmp_path / "silver" / "categorie_key=z").iterdir()}
    assert feed(("a", "2", "y", 2)) == ["x", "y"]
    assert read() == [("a", "2", "y"), ("b", "1", "x"), ("c", "1", "y"), (None, "n", "z")]
    assert {f.name for f in (tmp_path / "silver" / "categorie_key=z").iterdir()} == untouched
    assert feed(("b", "2", "w", 2)) == ["w", "x"]
    assert not (tmp_path / "silver" / "categorie_key=x").exists()
    assert feed(("b", "old", "x", 1), ("c", "same", "y", 1)) == ["w", "x", "y"]  # an older row changes nothing, an equal one wins
    assert read() == [("a", "2", "y"), ("b", "2", "w"), ("c", "same", "y"), (None, "n", "z")]
    assert feed(("b", "3", "x", 3)) == ["w", "x"]
    assert read() == [("a", "2", "y"), ("b", "3", "x"), ("c", "same", "y"), (None, "n", "z")]


def test_a_merge_that_died_before_its_swap_can_be_repeated(spark, tmp_path, monkeypatch):
    path, index = str(tmp_path / "silver"), str(tmp_path / "index")

    def feed(titre, folder, day):
        rows = [("a", titre, folder, dt.datetime(2026, 5, day))]
        merge.merge_silver(spark.createDataFrame(rows, "url string, titre string, categorie_key string, date_scraping timestamp"), path, index)

    def die(*_, **__):
        raise RuntimeError("lost")

    feed("1", "x", 1)
    with monkeypatch.context() as m:
        m.setattr(merge, "write_silver", die)
        with pytest.raises(RuntimeError):
            feed("2", "y", 2)
    feed("2", "y", 2)
    assert [(r.titre, r.categorie_key) for r in tables.read_parquet(spark, path, merge.SILVER).collect()] == [("2", "y")]


def test_repeated_run_changes_nothing(spark, lake):
    medallion.run(spark, lake, RUN)
    before = sorted(map(str, tables.read_gold(spark, lake.gold, "livres_flat").collect()))
    medallion.run(spark, lake, RUN)
    assert sorted(map(str, tables.read_gold(spark, lake.gold, "livres_flat").collect())) == before
    quarantined = spark.read.option("recursiveFileLookup", True).schema("url string").json(lake.quarantine)
    assert [r.url for r in quarantined.collect()] == ["u2"]


def test_run_without_data(spark, tmp_path):
    config = medallion.layout(str(tmp_path))
    (tmp_path / "bronze" / "books" / config.shop.bronze.rsplit("/", 1)[1]).mkdir(parents=True)
    reports = medallion.run(spark, config, RUN)
    assert reports[config.shop.name].first().rows_read == 0
    assert tables.read_gold(spark, config.gold, "livres_flat").count() == 0


class FakeSession:
    """A session whose settings are fixed, as on a cluster."""

    def __init__(self, master, **settings):
        self.conf = self
        self.sparkContext = self
        self.master, self.settings, self.applicationId = master, settings, "app"

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_follows_the_cluster_setting():
    session = FakeSession("spark://host", **{"spark.checkpoint.dir": "/shared/"})
    assert scratch(session, "x").startswith("/shared/x-")
    with pytest.raises(RuntimeError):
        scratch(FakeSession("spark://host"), "x")


def arrivals(spark, path, rows):
    df = spark.createDataFrame(rows, "url string, d int, titre string")
    df.write.mode("append").parquet(path)
    return df.schema


LATEST = T.StructType([T.StructField("url", T.StringType()), T.StructField("d", T.IntegerType()), T.StructField("titre", T.StringType())])
def by_title():
    return ["url"], "d", [F.col("titre")]


def test_upsert_over_batches_equals_one_batch(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "latest")
    batches = [
        [("a", 1, "a1"), ("b", 5, "b5"), (None, 1, "n1")],
        [("a", 3, "a3"), ("a", 2, "a2"), ("b", 4, "late"), ("c", None, "c0")],
        [("c", 1, "c1"), (None, 2, "n2")],
    ]
    for n, rows in enumerate(batches):
        schema = arrivals(spark, source, rows)
        stream = jobs.read_stream(spark, "parquet", {}, schema, source)
        jobs.upsert_latest(stream, path, str(tmp_path / "cp"), *by_title()).awaitTermination()
        delta = spark.read.parquet(f"{path}/deltas/{n:012d}-*")
        assert delta.count() == len({r[0] for r in rows})  # a batch writes its own keys only
        if n == 1:
            jobs.compact_latest(spark, path, LATEST, *by_title())
    latest = jobs.read_latest(spark, path, LATEST, *by_title())
    whole = keep_latest(spark.createDataFrame(sum(batches, []), schema), "url", "d", ties=[F.col("titre")])
    assert sorted(map(str, latest.collect())) == sorted(map(str, whole.collect()))
    jobs.compact_latest(spark, path, LATEST, *by_title())
    assert sorted(map(str, jobs.read_latest(spark, path, LATEST, *by_title()).collect())) == sorted(map(str, whole.collect()))


def test_readers_see_whole_versions_only(spark, tmp_path):
    """During a batch, a repeated batch or a compaction a reader gets the version before it, whole."""
    path = str(tmp_path / "latest")

    def write(rows, batch_id):
        jobs.write_delta(spark.createDataFrame(rows, LATEST), path, "s", batch_id, *by_title())

    def read():
        return sorted((r.url, r.titre) for r in jobs.read_latest(spark, path, LATEST, *by_title()).collect())

    assert read() == []
    write([("a", 1, "x"), ("b", 1, "y")], 0)
    before = jobs.read_latest(spark, path, LATEST, *by_title())
    half = tmp_path / "latest" / "deltas" / f"{1:012d}-s-{1:012d}"
    spark.createDataFrame([("q", 9, "half")], LATEST).write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert read() == [("a", "x"), ("b", "y")]
    write([("a", 2, "z")], 1)
    write([("a", 2, "z")], 1)
    assert read() == [("a", "z"), ("b", "y")]
    # a base that is written but not published yet
    spark.createDataFrame([("q", 9, "half")], LATEST).write.parquet(f"{path}/bases/{1:012d}")
    assert read() == [("a", "z"), ("b", "y")]
    jobs.compact_latest(spark, path, LATEST, *by_title())
    assert read() == [("a", "z"), ("b", "y")]
    assert sorted(r.titre for r in before.collect()) == ["x", "y"]  # a reader that began before goes on


def test_streamed_cleaning_equals_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [json.dumps(r, ensure_ascii=False) for r in SHOP] + ["", "BROKEN"]
    (tmp_path / "in" / "x.json").write_text("\n".join(lines), encoding="utf-8")
    stream = jobs.read_stream(spark, "text", {}, path=str(tmp_path / "in"))
    silver, quarantine = str(tmp_path / "silver"), str(tmp_path / "quarantine")
    jobs.to_silver_batches(stream, silver, quarantine, str(tmp_path / "cp"), clean_shop, RUN).awaitTermination()
    rows = spark.read.parquet(silver)
    assert sorted((r.url, r.titre, r.prix) for r in rows.collect()) == [
        ("u1", "Blue Lamp", 51.77), ("u1", "Blue Lamp 2", 10.0), ("u2", "Old", 1.0), ("u3", "Red Hat", 20.0),
    ]
    assert spark.read.option("recursiveFileLookup", True).schema("url string").json(quarantine).count() == 1


def repeat_last_batch(checkpoint):
    """As if the job had died after it wrote a batch and before it noted that."""
    last = max((f for f in (checkpoint / "commits").iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
    last.unlink()
    (checkpoint / "commits" / f".{last.name}.crc").unlink(missing_ok=True)


def test_landing_stream_repeats_without_doubling(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "bronze")
    schema = arrivals(spark, source, [("a", 1, "x"), ("b", 1, "y")])
    at = F.lit("2026-05-01 10:00:00").cast("timestamp_ntz")

    def run(checkpoint):
        stream = jobs.read_stream(spark, "parquet", {}, schema, source)
        jobs.to_bronze(stream, root, str(tmp_path / checkpoint), at).awaitTermination()
        return spark.read.option("recursiveFileLookup", True).schema("url string").json(root).count()

    assert run("one") == 2
    repeat_last_batch(tmp_path / "one")
    assert run("one") == 2
    assert run("two") == 4  # another stream that reads the same source lands it again, in folders of its own


def test_silver_batches_survive_a_new_checkpoint(spark, tmp_path):
    """Two streams over different files, each counting its batches from 0, and a repeated batch."""
    silver = str(tmp_path / "silver")

    def run(name, line):
        (tmp_path / name).mkdir(exist_ok=True)
        (tmp_path / name / "x.json").write_text(line, encoding="utf-8")
        stream = jobs.read_stream(spark, "text", {}, path=str(tmp_path / name))
        jobs.to_silver_batches(stream, silver, str(tmp_path / "q"), str(tmp_path / f"cp-{name}"), clean_shop, RUN).awaitTermination()

    run("a", json.dumps({"titre": "One", "url": "u1"}))
    run("b", json.dumps({"titre": "Two", "url": "u2"}))
    repeat_last_batch(tmp_path / "cp-b")
    run("b", json.dumps({"titre": "Two", "url": "u2"}))
    assert sorted(r.titre for r in spark.read.parquet(silver).collect()) == ["One", "Two"]


def test_upsert_survives_a_new_checkpoint(spark, tmp_path):
    """After a compaction a stream with a new checkpoint starts from batch 0; its rows count all the same."""
    path, n = str(tmp_path / "latest"), 0

    def feed(folder, checkpoint, rows):
        schema = arrivals(spark, str(tmp_path / folder), rows)
        stream = jobs.read_stream(spark, "parquet", {}, schema, str(tmp_path / folder))
        jobs.upsert_latest(stream, path, str(tmp_path / checkpoint), *by_title()).awaitTermination()

    def read():
        return sorted((r.url, r.d) for r in jobs.read_latest(spark, path, LATEST, *by_title()).collect())

    for n in range(3):
        feed("old", "cp1", [("1", n, "t"), ("2", n, "t")])
    jobs.compact_latest(spark, path, LATEST, *by_title())
    feed("new", "cp2", [("1", 9, "t")])
    assert read() == [("1", 9), ("2", 2)]
    feed("new", "cp2", [("3", 9, "t")])
    repeat_last_batch(tmp_path / "cp2")
    jobs.compact_latest(spark, path, LATEST, *by_title())
    feed("new", "cp2", [("2", 1, "late")])
    assert read() == [("1", 9), ("2", 2), ("3", 9)]
    jobs.compact_latest(spark, path, LATEST, *by_title())
    jobs.compact_latest(spark, path, LATEST, *by_title())
    assert read() == [("1", 9), ("2", 2), ("3", 9)]


def test_stream_dedup_remembers_keys(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(3):
        schema = arrivals(spark, source, [("hot" if i % 3 else f"k{i + part}", i, "t") for i in range(300)])
        stream = jobs.read_stream(jobs.stream_session(spark), "parquet", {}, schema, source)
        jobs.unseen(stream, ["url"]).select("url").writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", str(tmp_path / "cp")
        ).trigger(availableNow=True).start().awaitTermination()
    found = [r.url for r in spark.read.parquet(out).collect()]
    assert sorted(found) == sorted({"hot"} | {f"k{i + part}" for i in range(0, 300, 3) for part in range(3)})
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != jobs.ROCKSDB


def test_daily_volumes_over_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    for day in ("2026-05-01", "2026-05-02", "2026-05-01"):
        spark.createDataFrame([(f"{day} 10:00:00", "s")], "t string, source string").select(
            F.to_timestamp("t").alias("ts"), "source"
        ).write.mode("append").parquet(source)
        stream = jobs.read_stream(spark, "parquet", {}, spark.read.parquet(source).schema, source)
        jobs.write_daily_volumes(stream, str(tmp_path / "v"), str(tmp_path / "cp"), "ts", "source").awaitTermination()
    rows = jobs.read_daily_volumes(spark, str(tmp_path / "v")).orderBy("date_val").collect()
    assert [(str(r.date_val), r.nb_livres) for r in rows] == [("2026-05-01", 2), ("2026-05-02", 1)]


def test_daily_volumes_are_recounted_by_a_new_checkpoint(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "v")

    def feed(checkpoint, *days):
        rows = spark.createDataFrame([(f"{day} 10:00:00", "s") for day in days], "t string, source string")
        rows.select(F.to_timestamp("t").alias("ts"), "source").write.mode("append").parquet(source)
        stream = jobs.read_stream(spark, "parquet", {}, spark.read.parquet(source).schema, source)
        jobs.write_daily_volumes(stream, path, str(tmp_path / checkpoint), "ts", "source").awaitTermination()
        return {str(r.date_val): r.nb_livres for r in jobs.read_daily_volumes(spark, path).collect()}

    assert feed("cp1", "2026-05-01", "2026-05-02") == {"2026-05-01": 1, "2026-05-02": 1}
    assert feed("cp1", "2026-05-02") == {"2026-05-01": 1, "2026-05-02": 2}
    assert feed("cp2", "2026-05-02") == {"2026-05-01": 1, "2026-05-02": 3}
    assert feed("cp2", "2026-05-03") == {"2026-05-01": 1, "2026-05-02": 3, "2026-05-03": 1}


def test_lines_with_many_fields_of_one_row_group_are_parsed_by_many_tasks(spark, tmp_path):
    spark.range(100).selectExpr("id AS s_suppkey").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    rows = storage.bronze_many_fields(spark, str(tmp_path))
    with_work = rows.groupBy(F.spark_partition_id().alias("task")).agg(F.count("n").alias("n"), F.sum("k_last").alias("s")).collect()
    assert len(with_work) >= spark.sparkContext.defaultParallelism
    assert (sum(r["n"] for r in with_work), sum(r["s"] for r in with_work)) == (100, 5050)
