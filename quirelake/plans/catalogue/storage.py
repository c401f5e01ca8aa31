"""Round trips through the files of the layers, and the whole run."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelake.functions.text import safe_timestamp, trim_ws, utc_wall_clock
from quirelake.operators import cleaning, gold, gold_delta
from quirelake.operators.dedup import keep_latest
from quirelake.operators.quarantine import split_untitled
from quirelake.plans import medallion
from quirelake.plans.catalogue import query, spread, table
from quirelake.plans.catalogue.bindings import (
    LIBRARY_SQL, RUN_TS, SHOP_SQL, SILVER_LIST, library_books, shop_books,
)
from quirelake.plans.catalogue.silver import plain, shop_silver
from quirelake.plans.catalogue.star import half_up
from quirelake.schemas import BOOK_RAW, PARTITION_KEY, SHOP_FOLDER, SILVER
from quirelake.session import folders, scratch
from quirelake.sources import bronze, ledger, merge, snapshots, tables, visited


def _landed_at():
    return F.lit("2026-05-01 10:30:00").cast("timestamp_ntz")


def _landed(spark, sf_dir):
    root = scratch(spark, "bronze")
    bronze.land(shop_books(spark, sf_dir).withColumn("supplement", F.col("url")), root, _landed_at())
    return root


_READ_SQL = f"""
WITH {SHOP_SQL}
SELECT url, nb_avis, CASE event_type WHEN 'signup' THEN 'bad' ELSE strftime(moment, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END
  AS date_scraping, url AS supplement FROM shop
"""


@query(_READ_SQL)
def bronze_read(spark, sf_dir):
    """Landed records read back; an unknown key that is asked for is a column."""
    df, _ = bronze.split_corrupt(bronze.read_bronze(spark, _landed(spark, sf_dir), extras=["supplement"]))
    return df.select("url", F.col("nb_avis").cast("bigint").alias("nb_avis"), "date_scraping", "supplement")


@query(_READ_SQL)
def bronze_read_single_scan(spark, sf_dir):
    """The same from the map that holds all unknown keys."""
    lines = bronze.parse_lines(bronze.read_lines(spark, _landed(spark, sf_dir)))
    return lines.select(
        "url", F.col("nb_avis").cast("bigint").alias("nb_avis"), "date_scraping",
        F.col(bronze.EXTRAS)["supplement"].alias("supplement"),
    )


@query(f"""
WITH {SHOP_SQL}
SELECT 'books_toscrape_com' AS source_key, '2026-05-01-10' AS ingest_hour,
  CASE event_type WHEN 'click' THEN 'Poetry' WHEN 'view' THEN 'Add_a_comment' WHEN 'purchase' THEN 'Science_Fiction'
    WHEN 'signup' THEN 'unknown' ELSE '_Travel_' END AS categorie_key, count(*) AS lignes
FROM shop GROUP BY 1, 2, 3
""")
def bronze_land(spark, sf_dir):
    """Rows per folder of the landing zone."""
    landed = spark.read.schema("url string, source_key string, ingest_hour string, categorie_key string").json(
        _landed(spark, sf_dir)
    )
    return landed.groupBy("source_key", "ingest_hour", "categorie_key").agg(F.count("*").alias("lignes"))


def _damaged(spark, sf_dir):
    """Events as lines, some of them broken, blank or a list."""
    root = scratch(spark, "lines")
    (
        table(spark, sf_dir, "events")
        .selectExpr(
            "CASE event_type WHEN 'error' THEN concat('{\"titre\": \"', user_id) WHEN 'view' THEN '  ' "
            "WHEN 'signup' THEN concat('[', user_id, ']') "
            "ELSE to_json(named_struct('titre', event_type, 'url', event_id)) END AS value"
        )
        .write.text(f"{root}/lines.json")
    )
    return spark.read.option("recursiveFileLookup", True).text(root)


@query("""
SELECT CASE event_type WHEN 'error' THEN '{"titre": "' || user_id WHEN 'signup' THEN '[' || user_id || ']' END AS corrompu,
  CASE WHEN event_type IN ('click', 'purchase') THEN CAST(event_id AS VARCHAR) END AS url
FROM events WHERE event_type <> 'view'
""")
def bronze_corrupt_split(spark, sf_dir):
    """Good lines with their fields, bad lines as they are, blank lines gone."""
    rows = bronze.parse_lines(_damaged(spark, sf_dir))
    return rows.select(F.col(bronze.CORRUPT).alias("corrompu"), "url")


@query("""
SELECT count(*) FILTER (WHERE event_type IN ('click', 'purchase')) AS lignes_lues,
  count(*) FILTER (WHERE event_type IN ('error', 'signup')) AS lignes_ignorees FROM events
""")
def bronze_corrupt_report(spark, sf_dir):
    return bronze.corrupt_report(bronze.parse_lines(_damaged(spark, sf_dir), required=("titre", "url")).drop("_names"))


@query("""
SELECT s_suppkey, s_suppkey + 1 AS k_last, (s_suppkey % 7 + 1500)::INTEGER AS n FROM supplier
""")
def bronze_many_fields(spark, sf_dir):
    """Records with more than 1,500 unknown fields keep them all."""
    lines = spread(table(spark, sf_dir, "supplier")).selectExpr(
        "concat('{\"url\":\"', s_suppkey, '\"', array_join(transform(sequence(1, 1499 + s_suppkey % 7), "
        "i -> concat(',\"k', i, '\":', i)), ''), ',\"k_last\":', s_suppkey + 1, '}') AS value"
    )
    rows = bronze.parse_lines(lines, required=("url",))
    extras = F.col(bronze.EXTRAS)
    return rows.select(
        F.col("url").cast("bigint").alias("s_suppkey"), extras["k_last"].cast("bigint").alias("k_last"), F.size(extras).alias("n")
    )


def _damage(spark, folder):
    """Make the files of a folder unreadable: their bytes no longer fit their checksums. (Local files have some.)"""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        sums = files.getRawFileSystem().create(files.getChecksumFile(status.getPath()))
        sums.write(bytearray(b"crc\0" + (512).to_bytes(4, "big") + bytes(4)))
        sums.close()


@query("""
SELECT event_type AS fichier, event_type IN ('error', 'view') AS ignore,
  CASE WHEN event_type IN ('error', 'view') THEN 0 ELSE count(*) END::BIGINT AS lignes
FROM events GROUP BY event_type
""")
def bronze_skipped_files(spark, sf_dir):
    """Files by kind of event, of which two kinds cannot be read. The files are noted while their lines are counted."""
    root = scratch(spark, "kinds")
    events = table(spark, sf_dir, "events").selectExpr("coalesce(event_type, '') AS kind", "event_id")
    events.repartition("kind").write.partitionBy("kind").json(root)
    for kind in ("error", "view"):
        _damage(spark, f"{root}/kind={kind}")
    files, kind = bronze.ReadFiles(spark), F.regexp_extract("path", "/kind=([^/]*)/", 1).alias("fichier")
    lines = bronze.read_lines(spark, root, "path").select("path", kind)
    counted = {r["fichier"]: r["n"] for r in files.watch(lines, "path").groupBy("fichier").agg(F.count(F.lit(1)).alias("n")).collect()}
    listed = bronze.listed_files(spark, root).select(kind).distinct()
    lost = files.skipped(root).select(kind).distinct().withColumn("ignore", F.lit(True))
    read = spark.createDataFrame(list(counted.items()), "fichier string, lignes bigint")
    joined = listed.join(lost, "fichier", "left").join(read, "fichier", "left")
    return joined.select("fichier", F.coalesce("ignore", F.lit(False)).alias("ignore"), F.coalesce("lignes", F.lit(0)).alias("lignes"))


def _silver_path(spark, sf_dir):
    path = scratch(spark, "silver")
    tables.write_silver(shop_silver(spark, sf_dir), path)
    return path


@query(f"WITH {SHOP_SQL} SELECT {SILVER_LIST} FROM shop_silver")
def silver_read(spark, sf_dir):
    return plain(tables.read_silver(spark, _silver_path(spark, sf_dir)))


@query(f"""
WITH {SHOP_SQL}
SELECT titre, url, categorie, CASE categorie WHEN 'Poetry' THEN 0 ELSE qualite_score END AS qualite_score FROM shop_silver
""")
def silver_write(spark, sf_dir):
    """A second batch that holds one category replaces that category only."""
    path = _silver_path(spark, sf_dir)
    again = shop_silver(spark, sf_dir).filter("categorie = 'Poetry'").withColumn("qualite_score", F.lit(0))
    tables.write_silver(again, path)
    return tables.read_silver(spark, path).select("titre", "url", "categorie", "qualite_score")


@query(f"WITH {SHOP_SQL} SELECT url, isbn, nb_avis FROM (SELECT * FROM shop_latest WHERE trim(titre) = '')")
def quarantine_write(spark, sf_dir):
    root = scratch(spark, "quarantine")
    rows = shop_books(spark, sf_dir).withColumn("_at", F.try_to_timestamp("date_scraping"))
    _, untitled = split_untitled(keep_latest(rows, "url", "_at").drop("_at"))
    tables.write_quarantine(untitled, root, SHOP_FOLDER, RUN_TS)
    back = spark.read.schema(BOOK_RAW).option("recursiveFileLookup", True).json(root)
    return back.select("url", trim_ws(F.col("isbn")).alias("isbn"), F.col("nb_avis").cast("bigint").alias("nb_avis"))


_GOLD_SQL = f"""
WITH {SHOP_SQL}
SELECT categorie, count(titre) AS nb_livres, round_even(avg(prix), 2) AS prix_moyen, round_even(min(prix), 2) AS prix_min,
  round_even(max(prix), 2) AS prix_max, round_even(avg(note_etoiles), 2) AS note_moyenne,
  CAST(coalesce(sum(nb_avis), 0) AS BIGINT) AS total_avis, '{SHOP_FOLDER}' AS source, '{RUN_TS}' AS date_gold
FROM shop_silver GROUP BY categorie
"""


@query(_GOLD_SQL)
def gold_write(spark, sf_dir):
    """A Gold table is replaced as a whole: the first version leaves no rows."""
    root = scratch(spark, "gold")
    kpi = gold.kpi_by_category(shop_silver(spark, sf_dir), source=SHOP_FOLDER, run_ts=RUN_TS)
    tables.write_gold(kpi.withColumn("nb_livres", F.lit(0).cast("bigint")), root, "kpi_par_categorie")
    tables.write_gold(kpi, root, "kpi_par_categorie")
    return tables.read_gold(spark, root, "kpi_par_categorie")


@query(_GOLD_SQL + " ORDER BY nb_livres DESC, categorie")
def gold_read(spark, sf_dir):
    root = scratch(spark, "gold")
    kpi = gold.kpi_by_category(shop_silver(spark, sf_dir), source=SHOP_FOLDER, run_ts=RUN_TS)
    tables.write_gold(kpi, root, "kpi_par_categorie")
    return tables.read_gold(spark, root, "kpi_par_categorie", ordered=True)


@query(f"""
WITH {SHOP_SQL}
SELECT categorie AS genre, count(*) AS nb_livres, {half_up('avg(prix)')} AS prix_moyen, min(prix) AS prix_min,
  max(prix) AS prix_max, {half_up('avg(note_etoiles)')} AS note_moyenne,
  {half_up("100.0 * sum(CASE WHEN disponibilite = 'available' THEN 1 ELSE 0 END) / count(*)")} AS pct_disponible
FROM shop_silver GROUP BY 1
""")
def star_rebuild(spark, sf_dir):
    """The star written and rebuilt over itself; its genre aggregate read back."""
    root = scratch(spark, "star")
    for _ in range(2):
        medallion.write_star(spark, shop_silver(spark, sf_dir), root)
    return snapshots.snapshot(spark, root).table("agg_genre_stats")


@query(f"""
WITH {SHOP_SQL}, versions(version, moved) AS (VALUES ('old', false), ('new', true))
SELECT version, categorie AS genre, count(*) AS nb_livres, (SELECT count(DISTINCT categorie) FROM shop_silver) AS genres,
  (SELECT count(*) FROM shop_silver WHERE NOT moved OR categorie = 'Poetry') AS faits
FROM shop_silver, versions WHERE NOT moved OR categorie = 'Poetry' GROUP BY ALL
""".replace("(SELECT count(DISTINCT categorie) FROM shop_silver)", "(SELECT count(DISTINCT categorie) FROM shop_silver WHERE NOT moved OR categorie = 'Poetry')"))
def star_snapshot(spark, sf_dir):
    """A reader that began before a rebuild, of one category only, and one that begins after it: each sees tables of its
    own version, facts, dimension and aggregate, though both read after the rebuild."""
    root, silver = scratch(spark, "star"), shop_silver(spark, sf_dir)
    medallion.write_star(spark, silver, root)
    before = snapshots.snapshot(spark, root)
    medallion.write_star(spark, silver.filter("categorie = 'Poetry'"), root)
    seen = []
    for version, pinned in (("old", before), ("new", snapshots.snapshot(spark, root))):
        genres = pinned.table("dim_categorie").agg(F.count(F.lit(1)).alias("genres"))
        facts = pinned.table("fact_scraping").agg(F.count(F.lit(1)).alias("faits"))
        counts = cleaning.merge_single_rows(genres, facts).withColumn("version", F.lit(version))
        stats = pinned.table("agg_genre_stats").withColumn("version", F.lit(version))
        seen.append(stats.join(counts, "version").select("version", "genre", "nb_livres", "genres", "faits"))
    return seen[0].unionByName(seen[1])


@query(f"""
WITH {SHOP_SQL}
SELECT url, titre, CASE categorie WHEN 'Poetry' THEN 'Moved' ELSE categorie END AS categorie,
  CASE WHEN categorie = 'Poetry' THEN 'Moved' WHEN categorie = 'Science Fiction' THEN 'Science_Fiction' ELSE categorie END AS dossier
FROM shop_silver
""")
def silver_merge(spark, sf_dir):
    """Every book of one category moves to another; its old folder is left by all, and no folder holds a stale row."""
    path, index = scratch(spark, "silver"), scratch(spark, "index")
    silver = shop_silver(spark, sf_dir)
    merge.merge_silver(silver, path, index)
    moved = silver.filter("categorie = 'Poetry'").withColumns({"categorie": F.lit("Moved"), PARTITION_KEY: F.lit("Moved")})
    merge.merge_silver(moved, path, index)
    rows = tables.read_parquet(spark, path, SILVER)
    return rows.select("url", "titre", "categorie", F.col(PARTITION_KEY).alias("dossier"))


@query(f"""
WITH {SHOP_SQL}
SELECT l.url, l.titre, n.n AS versions, l.moment AS date_scraping
FROM shop_latest AS l JOIN (SELECT url, count(*) AS n FROM shop GROUP BY url) AS n ON l.url = n.url
""")
def bronze_incremental(spark, sf_dir):
    """Three runs over a folder that grows, one of which dies before it commits and one finds nothing; as one run over all."""
    prefix, root = scratch(spark, "arriving"), scratch(spark, "incremental")
    books = shop_books(spark, sf_dir)
    part = F.pmod(F.xxhash64("url", "date_scraping", "nb_avis"), F.lit(3))
    for n in range(3):
        books.filter(part == n).write.mode("append").option("ignoreNullFields", False).json(prefix)
        if n == 1:
            ledger.stage_run(spark, prefix, root)
        ledger.ingest(spark, prefix, root)
    ledger.ingest(spark, prefix, root)
    rows = ledger.read_versions(spark, root)
    return rows.select("url", "titre", F.col("n_versions").alias("versions"), utc_wall_clock(safe_timestamp(F.col("date_scraping"))).alias("date_scraping"))


@query("""
SELECT (count(*) + count(*) FILTER (event_type = 'error'))::BIGINT AS lignes, count(*) FILTER (event_type = 'error') AS cassees,
  3 AS passes FROM events
""")
def bronze_ledger(spark, sf_dir):
    """Lines and broken lines by the ledger, after three runs; a broken line follows each record of one kind."""
    prefix, root = scratch(spark, "arriving"), scratch(spark, "incremental")
    events = table(spark, sf_dir, "events").selectExpr("event_id AS url", "event_type AS categorie", "coalesce(event_id % 3, 0) AS part")
    for n in range(3):
        arrived = events.filter(F.col("part") == n)
        broken = F.coalesce(F.col("categorie") == "error", F.lit(False))
        arrived.filter(~broken).write.mode("append").json(prefix)
        arrived.filter(broken).write.mode("append").option("lineSep", "\n{same\n").json(prefix)
        ledger.ingest(spark, prefix, root)
    page = ledger.read_ledger(spark, root)
    return page.agg(F.sum("lines").alias("lignes"), F.sum("broken").alias("cassees"), F.lit(len(folders(spark, f"{root}/ledger"))).alias("passes"))


@query("""
SELECT user_id || '/' || CAST(ts AS DATE) AS url, 1::BIGINT AS lignes FROM events GROUP BY 1
""")
def visited_urls(spark, sf_dir):
    """Three rounds over a visited set, which is compacted after the first: a round skips what those before it had, and
    only adds what is new."""
    path = scratch(spark, "visited")
    events = table(spark, sf_dir, "events").selectExpr("concat_ws('/', user_id, CAST(ts AS date)) AS url", "event_type")
    rounds = (events.filter("event_type = 'click'"), events.filter("event_type <> 'click'"), events)
    for n, arrivals in enumerate(rounds):
        visited.append_visited(visited.unvisited(arrivals.select("url"), path, "url"), path, "url")
        if n == 0:
            visited.compact_visited(spark, path, arrivals.schema["url"])
    kept = visited.read_visited(spark, path, events.schema["url"])
    return kept.groupBy("url").agg(F.count(F.lit(1)).alias("lignes"))


@query("""
SELECT '{"user_id":' || user_id || ',"event_type":' ||
  CASE event_type WHEN 'error' THEN 'null' ELSE '"' || event_type || '"' END || '}' AS value FROM events
""")
def event_payload(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("user_id", "nullif(event_type, 'error') AS event_type")
    return tables.event_payload(rows)


def _run(spark, sf_dir):
    """A run over the records of both sources; some lines of the shop's are broken, and one file cannot be read."""
    config = medallion.layout(scratch(spark, "lake"))
    root = config.shop.bronze.rsplit("/", 1)[0]
    books = shop_books(spark, sf_dir)
    travel = F.coalesce(F.col("categorie") == " Travel ", F.lit(False))
    bronze.land(books.filter(~travel), root, _landed_at())
    bronze.land(library_books(spark, sf_dir), root, _landed_at())
    # a broken line follows each of these records
    damaged = books.filter(travel).write.option("lineSep", "\n{same\n").option("ignoreNullFields", False)
    damaged.json(f"{config.shop.bronze}/damaged")
    books.limit(1).write.json(f"{config.shop.bronze}/unreadable")
    _damage(spark, f"{config.shop.bronze}/unreadable")
    return config, medallion.run(spark, config, RUN_TS)


@query(f"WITH {SHOP_SQL}, {LIBRARY_SQL} "
       f"SELECT {SILVER_LIST} FROM shop_silver UNION ALL SELECT {SILVER_LIST} FROM library_silver")
def silver_full(spark, sf_dir):
    """Bronze files of both sources to Silver files."""
    config, _ = _run(spark, sf_dir)
    shop = tables.read_silver(spark, config.shop.silver)
    return plain(shop.unionByName(tables.read_silver(spark, config.library.silver)))


_FLAT = ("titre, auteur, prix, note_etoiles, categorie, disponibilite, isbn, nb_avis, langue, annee_publication, "
         "source, qualite_score, date_scraping, url")


@query(f"WITH {SHOP_SQL}, {LIBRARY_SQL} "
       f"SELECT {_FLAT}, '{RUN_TS}' AS date_gold FROM shop_silver "
       f"UNION ALL SELECT {_FLAT}, '{RUN_TS}' AS date_gold FROM library_silver")
def medallion_run(spark, sf_dir):
    """The whole run; its flat Gold table."""
    config, _ = _run(spark, sf_dir)
    flat = tables.read_gold(spark, config.gold, "livres_flat")
    return flat.withColumn("date_scraping", utc_wall_clock(F.col("date_scraping")))


@query(f"""
WITH {SHOP_SQL}, {LIBRARY_SQL}
SELECT 'shop' AS source, (SELECT count(*) FROM shop) AS rows_read, (SELECT count(*) FROM shop_latest) AS rows_deduplicated,
  count(*) AS rows_written, (SELECT count(*) FROM shop_latest) - count(*) AS rows_quarantined,
  (SELECT count(*) FROM events WHERE event_type = 'error') AS skipped_lines, 1 AS skipped_files FROM shop_silver
UNION ALL SELECT 'library', count(*), count(*), count(*), 0, 0, 0 FROM library_silver
""")
def medallion_reports(spark, sf_dir):
    config, reports = _run(spark, sf_dir)
    columns = ["source", "rows_read", "rows_deduplicated", "rows_written", "rows_quarantined", "skipped_lines", "skipped_files"]
    shop = reports[config.shop.name].withColumn("source", F.lit("shop"))
    library = reports[config.library.name].withColumn("source", F.lit("library"))
    return shop.unionByName(library).select(*columns)


@query("SELECT * EXCLUDE (source, date_gold) FROM (" + _GOLD_SQL + ")")
def gold_incremental(spark, sf_dir):
    """The KPI state after three batches of versions: each takes back the rows that newer versions replace."""
    books = shop_books(spark, sf_dir).withColumn("_at", F.try_to_timestamp("date_scraping"))
    part = F.pmod(F.xxhash64("url", "date_scraping", "nb_avis"), F.lit(3))
    state, before = spark.createDataFrame([], gold_delta.STATE), None
    for n in range(3):
        valid, _ = split_untitled(keep_latest(books.filter(part <= n), "url", "_at").drop("_at"))
        path = scratch(spark, "silver")
        cleaning.to_silver(valid, cleaning.clean_shop, RUN_TS).write.parquet(path)
        after = spark.read.parquet(path)
        changed = gold_delta.changes(after.limit(0) if before is None else before, after)
        path = scratch(spark, "gold-state")
        gold_delta.apply_changes(state, changed, after).write.parquet(path)
        state, before = spark.read.parquet(path), after
    return gold_delta.kpi_of_state(state)
