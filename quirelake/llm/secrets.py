"""Secret scan with multipart credential linking. DataFrame functions only.

Strong spans are reported wherever they stand: assignments of a value to a secret's name, access identifiers, and long
runs of hexadecimal digits. Weak ones are the parts of a credential, none of which says much alone: an account name given
as `user=...` (`login`), a long token of mixed letters and digits (`key`), the address of a service (`endpoint`). A text
falls into scopes, which end at blank lines. Within a scope, parts are joined to those in reach (at most `REACH` code
points between them): a login and a key are reported if the other, or a strong span that can take its place, is in reach;
an endpoint only if both an identifier and a secret are. An access identifier counts as an identifier, an assignment and a
hexadecimal run as a secret; a weak part that overlaps a strong span is that span and isn't reported again.

The join is a sweep over the parts of a text in their order: each needs the nearest part of every class on either side
only, so no pairs are formed and a text with many parts costs no more than sorting them. Matches are cut out of the text
with what stands before them, so their places are running sums of lengths; texts without any match are never shuffled.

All matches are leftmost, non-overlapping ones of their kind. Null and empty texts have no span. Texts are searched in
whole, however long; all spans of one text are one result row. Of equal starts the kinds' order decides, then the end.
Repeated rows and ids give a row each; an empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelake.llm.common import LOCATOR, located, stored

#: Fixed patterns; `_long_enough` says what else a match needs.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
VALUE = r"""(?s)^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
#: A run's match is the same with its least length in the pattern: shorter runs hold no longer ones.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LOGIN = r"""(?i:user_?name|user_?id|user|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]{3,}"""
KEY = r"[A-Za-z0-9+/_-]{20,}={0,2}"
ENDPOINT = r"(?i:https?|ftps?|s3|jdbc:[a-z]{2,20}|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D\"'<>]+"
BREAK = r"\n[\x20\x09\x0B-\x0D]*\n"
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "login": LOGIN, "key": KEY, "endpoint": ENDPOINT}
KINDS = list(PATTERNS)
STRONG = KINDS[:3]
LEAST_VALUE = 6
REACH = 200
#: Which kinds can take which part.
IDENTIFIERS, SECRETS, ENDPOINTS = ("access", "login"), ("assign", "hex", "key"), ("endpoint",)


def _long_enough(kind: str, match: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_replace(match, VALUE, "")) >= LEAST_VALUE
    if kind == "key":
        return match.rlike("[0-9]") & match.rlike("[a-z]") & match.rlike("[A-Z]")
    return F.lit(True)


NO_PIECES = "array<struct<kind:string,size:bigint,own:bigint,valid:boolean>>"


def _pieces(text: Column, kind: str, pattern: str) -> Column:
    r"""(kind, size, own, valid) per match: `own` is its length, `size` that and all that stands between it and the last.

    Each match starts where the last one ended (\G) and takes as little as it can before the pattern, so matches are the
    leftmost ones and the text is read once.
    """
    found = F.regexp_extract_all(text, F.lit(rf"\G[\s\S]*?(?:{pattern})"), F.lit(0))

    def piece(x: Column) -> Column:
        match = F.regexp_extract(x, pattern, 0)
        return F.struct(
            F.lit(kind).alias("kind"), F.length(x).cast("bigint").alias("size"), F.length(match).cast("bigint").alias("own"),
            _long_enough(kind, match).alias("valid"),
        )

    return F.when(text.rlike(pattern), F.transform(found, piece)).otherwise(F.array().cast(NO_PIECES))


def matched(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """__locator, doc_id, pieces: one row per document, read once; the texts themselves are left behind."""
    rows = located(docs).select(LOCATOR, F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    body = F.col("__text")
    rows = rows.select(LOCATOR, "doc_id", body, *[_pieces(body, kind, pattern).alias(f"__{kind}") for kind, pattern in PATTERNS.items()])
    weak = F.size(F.concat(*[F.col(f"__{kind}") for kind in KINDS[len(STRONG):]])) > 0
    breaks = F.when(weak, _pieces(body, "break", BREAK)).otherwise(F.array().cast(NO_PIECES))
    return stored(rows.select(LOCATOR, "doc_id", F.concat(*[F.col(f"__{kind}") for kind in KINDS], breaks).alias("pieces")), "pieces")


def _kind(*kinds: str) -> Column:
    return F.col("kind").isin(list(kinds))


def placed(found: DataFrame) -> DataFrame:
    """__locator, doc_id, kind, start, end of every match; the kind of one that is too short is null.

    All that follows partitions by the document, or more finely, so this is the only exchange.
    """
    rows = found.filter(F.size("pieces") > 0).repartition(LOCATOR).select(LOCATOR, "doc_id", F.posexplode("pieces").alias("nth", "piece"))
    so_far = Window.partitionBy(LOCATOR, "piece.kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("piece.size").over(so_far)
    return rows.select(LOCATOR, "doc_id", F.when(F.col("piece.valid"), F.col("piece.kind")).alias("kind"), (end - F.col("piece.own")).alias("start"), end.alias("end"))


def linked(spans: DataFrame) -> DataFrame:
    """`spans` with `reported`: strong spans are, weak ones with their counterparts in reach."""
    order = [F.col("start"), F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.coalesce("kind", F.lit(""))), F.col("end")]

    def sweeps(*keys):
        earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        later = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
        return earlier, later

    earlier, later = sweeps(LOCATOR)
    rows = spans.withColumn("scope", F.count(F.when(_kind("break"), 1)).over(earlier))
    rows = rows.withColumn("__left", F.max(F.when(_kind(*STRONG), F.col("end"))).over(earlier))
    rows = rows.withColumn("__right", F.min(F.when(_kind(*STRONG), F.col("start"))).over(later))
    covered = F.coalesce(F.col("__left") > F.col("start"), F.lit(False)) | F.coalesce(F.col("__right") < F.col("end"), F.lit(False))
    rows = rows.withColumn("kind", F.when(_kind(*STRONG) | ~covered, F.col("kind")))
    earlier, later = sweeps(LOCATOR, "scope")
    parts = {"identifier": IDENTIFIERS, "secret": SECRETS}
    for name, kinds in parts.items():
        rows = rows.withColumn(f"__{name}_left", F.max(F.when(_kind(*kinds), F.col("end"))).over(earlier))
    for name, kinds in parts.items():
        rows = rows.withColumn(f"__{name}_right", F.min(F.when(_kind(*kinds), F.col("start"))).over(later))

    def in_reach(name: str) -> Column:
        left, right = F.col("start") - F.col(f"__{name}_left"), F.col(f"__{name}_right") - F.col("end")
        return F.coalesce(left <= REACH, F.lit(False)) | F.coalesce(right <= REACH, F.lit(False))

    told = (
        _kind(*STRONG) | (_kind("login") & in_reach("secret")) | (_kind("key") & in_reach("identifier"))
        | (_kind(*ENDPOINTS) & in_reach("identifier") & in_reach("secret"))
    )
    return rows.select(LOCATOR, "doc_id", "kind", "start", "end", "scope", F.coalesce(told, F.lit(False)).alias("reported"))


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(F.sort_array(spans), lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked: one row per document."""
    found = matched(docs, text, doc_id)
    number = (F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.coalesce("kind", F.lit(""))) - 1).cast("int")
    span = F.struct("start", number.alias("kind"), "end")
    per_text = linked(placed(found)).groupBy(LOCATOR, "doc_id").agg(
        *[F.count(F.when(_kind(k), 1)).alias(f"n_{k}") for k in STRONG],
        F.collect_list(F.when(_kind(*STRONG), span)).alias("base"),
        F.collect_list(F.when(F.col("reported"), span)).alias("all"),
    )
    some = per_text.select(
        "doc_id", *[f"n_{k}" for k in STRONG], F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("all")).alias("spans"), (F.size("all") - F.size("base")).cast("bigint").alias("n_linked"),
    )
    zero = F.lit(0).cast("bigint")
    none = found.filter(F.size("pieces") == 0).select(
        "doc_id", *[zero.alias(f"n_{k}") for k in STRONG], F.sha2(F.lit("").cast("binary"), 256).alias("base_sha256"),
        F.lit("").alias("spans"), zero.alias("n_linked"),
    )
    return some.unionByName(none)
