"""`events` as a file stream, run until its input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelake.operators.cleaning import clean_shop
from quirelake.plans.catalogue import query, table
from quirelake.plans.catalogue.bindings import RUN_TS, SHOP_SQL, shop_books
from quirelake.plans.catalogue.silver import plain
from quirelake.schemas import BOOK_RAW, SILVER
from quirelake.session import scratch
from quirelake.sources import bronze, tables
from quirelake.streaming import jobs


def _events(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return jobs.read_stream(spark, "parquet", {"pathGlobFilter": "events.parquet"}, schema, sf_dir)


@query("""
SELECT event_id, user_id, event_type AS categorie FROM events
""")
def stream_bronze(spark, sf_dir):
    """Two streams with a checkpoint each land in the same folders of one hour, which are read back."""
    root = scratch(spark, "bronze")
    landed_at = F.lit("2026-05-01 10:30:00").cast("timestamp_ntz")
    for condition in ("coalesce(event_id % 2 = 0, true)", "event_id % 2 <> 0"):
        records = _events(spark, sf_dir).filter(condition).selectExpr(
            "event_id", "user_id", "event_type AS categorie", "'events' AS source"
        )
        jobs.to_bronze(records, root, scratch(spark, "checkpoint"), landed_at).awaitTermination()
    back = bronze.parse_lines(bronze.read_lines(spark, root), required=("event_id", "user_id", "categorie"))
    return back.selectExpr("CAST(event_id AS bigint) AS event_id", "CAST(user_id AS bigint) AS user_id", "categorie")


def _batches(spark, sf_dir):
    """Folders of events that arrive one after the other: some kinds by themselves, the first one once more, and at last
    all other events. Each arrival is written by the tasks that read it."""
    root = scratch(spark, "arrivals")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    kinds = ("click", "purchase", "view", "signup", "error")
    arrivals = [F.col("event_type") == kind for kind in (*kinds, "click")]
    for arrival in [*arrivals, ~F.coalesce(F.col("event_type").isin(*kinds), F.lit(False))]:
        events.filter(arrival).write.mode("append").parquet(root)
        yield jobs.read_stream(jobs.stream_session(spark), "parquet", {}, events.schema, root)


def _checkpoints(spark, batches, renewed):
    """Streams with their checkpoints: from batch number `renewed` on a new one takes the place of the old."""
    checkpoint = scratch(spark, "checkpoint")
    for n, stream in enumerate(batches):
        if n == renewed:
            checkpoint = scratch(spark, "checkpoint")
        yield n, stream, checkpoint


@query("SELECT user_id, CAST(ts AS DATE) AS jour, count(*) AS lignes FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS ts "
       "FROM events) GROUP BY 1, 2")
def stream_dedup(spark, sf_dir):
    """Users per day; a key that an earlier batch had must not pass again."""
    path, checkpoint = scratch(spark, "seen"), scratch(spark, "checkpoint")
    for events in _batches(spark, sf_dir):
        keys = events.selectExpr("user_id", "CAST(ts AS date) AS jour")
        (
            jobs.unseen(keys, ["user_id", "jour"]).writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        )
    seen = spark.read.schema("user_id bigint, jour date").parquet(path)
    return seen.groupBy("user_id", "jour").agg(F.count(F.lit(1)).alias("lignes"))


@query("""
SELECT user_id AS url, count(*) AS lignes FROM (
  SELECT DISTINCT user_id, ts >= TIMESTAMP '2024-01-15 00:00:00' FROM events) GROUP BY 1
""")
def stream_dedup_bounded(spark, sf_dir):
    """The first half of the events, the same again, one event a year later, and the second half two years later.

    Events without a time come with the second half. The repeated half is dropped; by the time of the last batch its keys are forgotten and pass once more.
    """
    root, path, checkpoint = scratch(spark, "arrivals"), scratch(spark, "seen"), scratch(spark, "checkpoint")
    events = table(spark, sf_dir, "events").selectExpr("user_id AS url", "CAST(ts AS timestamp) AS ts")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp")
    first = events.filter(F.col("ts") < cut)
    late = events.filter(F.coalesce(F.col("ts") >= cut, F.lit(True))).withColumn("ts", F.expr("ts + INTERVAL 2 YEARS"))
    tick = events.agg(F.lit(-1).cast("bigint").alias("url"), F.expr("max(ts) + INTERVAL 1 YEAR").alias("ts"))
    for arrivals in (first, first, tick, late):
        arrivals.write.mode("append").parquet(root)
        stream = jobs.read_stream(jobs.stream_session(spark), "parquet", {}, events.schema, root)
        (
            jobs.unseen_recently(stream, ["url"], "ts", "60 days").select("url").writeStream.format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            .awaitTermination()
        )
    seen = spark.read.schema("url bigint").parquet(path)
    return seen.filter("url >= 0").groupBy("url").agg(F.count(F.lit(1)).alias("lignes"))


def _lines(spark, sf_dir):
    """Shop records as JSON lines in two folders, for one stream each to pick up."""
    books = shop_books(spark, sf_dir).withColumn("supplement", F.col("url"))
    broken = table(spark, sf_dir, "events").filter("event_type = 'error'").selectExpr("concat('{', event_id) AS value")
    lines = tables.event_payload(books).unionByName(broken)
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    for part in (0, 1):
        root = scratch(spark, "lines")
        lines.filter(half == part).write.text(root)
        yield jobs.read_stream(spark, "text", {}, path=root)


def _silver_stream(spark, sf_dir):
    """Two streams, each with a checkpoint of its own, write the same tables."""
    silver, quarantine = scratch(spark, "silver"), scratch(spark, "quarantine")
    for lines in _lines(spark, sf_dir):
        jobs.to_silver_batches(
            lines, silver, quarantine, scratch(spark, "checkpoint"), clean_shop, RUN_TS
        ).awaitTermination()
    return silver, quarantine


@query(f"""
WITH {SHOP_SQL}
SELECT url, prix, note_etoiles, disponibilite, categorie, description, isbn, nb_avis, langue FROM shop
WHERE trim(titre) <> ''
""")
def stream_silver(spark, sf_dir):
    silver, _ = _silver_stream(spark, sf_dir)
    return plain(spark.read.schema(SILVER).parquet(f"{silver}/*")).select(
        "url", "prix", "note_etoiles", "disponibilite", "categorie", "description", "isbn", "nb_avis", "langue"
    )


@query(f"WITH {SHOP_SQL} SELECT url, url AS supplement FROM shop WHERE trim(titre) <> ''")
def stream_silver_extras(spark, sf_dir):
    """Fields outside the schema stay in the streamed Silver."""
    silver, _ = _silver_stream(spark, sf_dir)
    rows = spark.read.schema("url string, _extras map<string,string>").parquet(f"{silver}/*")
    return rows.select("url", F.col("_extras")["supplement"].alias("supplement"))


@query(f"WITH {SHOP_SQL} SELECT url, count(*) AS lignes FROM shop WHERE trim(titre) = '' GROUP BY url")
def stream_quarantine(spark, sf_dir):
    _, quarantine = _silver_stream(spark, sf_dir)
    rows = spark.read.schema(BOOK_RAW).option("recursiveFileLookup", True).json(quarantine)
    return rows.groupBy("url").agg(F.count("*").alias("lignes"))


@query("SELECT '{' || event_id AS corrompu FROM events WHERE event_type = 'error'")
def stream_corrupt(spark, sf_dir):
    """Lines that are no records are kept beside the quarantine."""
    _, quarantine = _silver_stream(spark, sf_dir)
    rows = spark.read.schema("ligne string").option("recursiveFileLookup", True).json(f"{quarantine}-corrupt")
    return rows.select(F.col("ligne").alias("corrompu"))


@query("""
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def stream_upsert_latest(spark, sf_dir):
    """Fed in seven batches, compacted after the third; the checkpoint is replaced before the fifth, which then holds
    everything again. Read from the base and the batches after it."""
    path = scratch(spark, "latest")
    key, ties = ["user_id"], [F.col("event_id")]
    schema = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value").schema
    for n, stream, checkpoint in _checkpoints(spark, _batches(spark, sf_dir), 4):
        jobs.upsert_latest(stream, path, checkpoint, key, "ts", ties).awaitTermination()
        if n == 2:
            jobs.compact_latest(spark, path, schema, key, "ts", ties)
    latest = jobs.read_latest(spark, path, schema, key, "ts", ties)
    return latest.select("user_id", "event_id", "ts", "event_type", "value")


@query("""
SELECT CAST(ts AS DATE) AS date_val, event_type AS source, count(*) + CASE event_type WHEN 'click' THEN count(*) ELSE 0 END
  AS nb_livres FROM events WHERE ts IS NOT NULL GROUP BY 1, 2
""")
def stream_daily_volumes(spark, sf_dir):
    """Seven batches, of which the sixth repeats a kind; every batch writes the days it changes. The checkpoint is
    replaced before the fourth, which counts all again and replaces the counts so far."""
    path = scratch(spark, "volumes")
    for _, events, checkpoint in _checkpoints(spark, _batches(spark, sf_dir), 3):
        rows = events.selectExpr("CAST(ts AS timestamp) AS ts", "event_type")
        jobs.write_daily_volumes(rows, path, checkpoint, "ts", "event_type", delay="60 days").awaitTermination()
    return jobs.read_daily_volumes(spark, path)
