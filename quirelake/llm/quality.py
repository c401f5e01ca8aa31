"""Quality rules as a ledger of failure bits, with versioned policies over the bits. DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one long whose bit i says that rule i
failed; a policy is a mask over the bits, so that another policy, or an ablation of one, reads the ledger and never the
texts again.

Null text counts as empty and fails `few_words`. Rows are handled one by one: repeated rows and ties give equal rows,
an empty table gives an empty ledger. Further columns of the input are left alone (`measure` keeps them only when asked).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.llm.common import unique_name

SPACE_CHARS = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL condition over the measurements


#: A rule's place in this list is its bit; append only, so that stored ledgers stay readable.
RULES = [
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 5 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
]
BASE_RULES = ("few_words", "repeated_words")


def mask_of(names) -> int:
    known = [r.name for r in RULES]
    return sum(1 << known.index(n) for n in names)


#: Policies by version: the rules that reject a document.
POLICIES = {
    "base-1": mask_of(BASE_RULES),
    "web-1": mask_of(r.name for r in RULES),
    "lenient-1": mask_of(["few_words", "repeated_words", "symbols"]),
}
PRODUCTION_POLICY = "web-1"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _covered(positions: Column) -> Column:
    """Words under windows that start at these ascending positions."""
    reach = F.transform(positions, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(positions, j + 1) - p, F.lit(WINDOW))))
    return F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns and the measurements of every whole text.

    Each array is referred to more than once where it is used, so that the optimizer doesn't inline its making into a
    function that runs per element.
    """
    rows = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("__t"))
    rows = rows.withColumn("__words", F.array_remove(F.split("__t", SPACES), ""))
    rows = rows.withColumn(
        "__lines", F.filter(F.split("__t", "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    )
    rows = rows.select(
        *keep,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count("__t", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__h"),
    )
    h = F.col("__h")
    rows = rows.withColumn(
        "__w",
        F.transform(
            F.slice(h, F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]),
        ),
    ).drop("__h")
    w = F.col("__w")
    # Only texts in which a window occurs twice are sorted: equal windows become neighbours.
    twice = F.size(F.array_distinct(w)) < F.size(w)
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    rows = rows.withColumn(
        "__s",
        F.when(twice, F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).otherwise(none),
    ).drop("__w")
    s = F.col("__s")

    def same(x: Column, j: Column) -> Column:
        return F.coalesce(x["h"] == F.get(s, j)["h"], F.lit(False))

    marked = F.transform(s, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"]))
    rows = rows.withColumn("__p", F.sort_array(F.filter(marked, lambda i: i.isNotNull()))).drop("__s")
    p = F.col("__p")
    return rows.withColumn("n_repeat_words", F.when(F.size(p) > 0, _covered(p)).otherwise(F.lit(0).cast("long"))).drop("__p")


def failure_bits() -> Column:
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(RULES)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return total


def ledger(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, the measurements and `failed`, the bits of the rules that failed."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    return measure(rows, "__text").withColumn("failed", failure_bits())


def passes(failed: Column, policy: str = PRODUCTION_POLICY) -> Column:
    return failed.bitwiseAND(F.lit(POLICIES[policy]).cast("long")) == 0


def apply_policy(ledger_rows: DataFrame, policy: str = PRODUCTION_POLICY) -> DataFrame:
    return ledger_rows.withColumn(
        "base_failed", ~passes(F.col("failed"), "base-1")
    ).withColumn("kept", passes(F.col("failed"), policy))


def ablations(ledger_rows: DataFrame, policy: str = PRODUCTION_POLICY) -> DataFrame:
    """One row per rule of the policy: documents it fails, and documents only it rejects (kept without it).

    One aggregation over the ledger: documents are first counted per bit pattern (at most 2^rules), then the patterns
    are read bitwise.
    """
    mask = POLICIES[policy]
    patterns = ledger_rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
        for i, r in enumerate(RULES) if mask >> i & 1
    ])
    each = patterns.select("bits", "n", F.explode(rules).alias("r"))
    return each.groupBy(F.lit(policy).alias("policy"), F.col("r.rule").alias("rule"), F.col("r.bit").alias("bit")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
    )


def filter_documents(docs: DataFrame, text: str = "text", policy: str = PRODUCTION_POLICY) -> DataFrame:
    """The documents that the policy keeps, with the columns they came with."""
    row = unique_name(docs.columns, "__row")
    inner = unique_name([*docs.columns, row], "__body")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), F.col(text).alias(inner))
    # The row number pins the measurements below the filter: pushed down, the condition would compute them many times.
    pin = unique_name([*docs.columns, row, inner], "__pin")
    measured = measure(rows, inner, (row,)).withColumn(pin, F.monotonically_increasing_id())
    judged = measured.filter(passes(failure_bits(), policy) & (F.col(pin) >= 0))
    return judged.select(*[F.col(row)[c].alias(c) for c in docs.columns])
