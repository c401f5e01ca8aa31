"""The pipeline, stage by stage, against brute force."""

from __future__ import annotations

import importlib.util

from tests.llm.helpers import documents, odd_rows
from tests.llm.test_dedup import near_groups
from tests.llm.test_text import assert_packed, measures

import corpus_pipeline
import __spark_entry__ as driver
from quirelake.llm import langid
from quirelake.llm.common import stored

SF_DIR = "/root/testdata/sf0.001"


def passes_quality(text):
    """All six rules of the production policy, by plain loops over the whole text."""
    n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat = measures(text)
    return not (
        n_words < 10 or 100 * n_repeat > 20 * n_words or 10 * n_symbols > 3 * n_words or 10 * n_dup_lines > 5 * n_lines
        or word_chars < 2 * n_words or word_chars > 20 * n_words
    )


def test_stages_and_the_whole_run(spark):
    docs = first = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    by_name = dict(corpus_pipeline.STAGES)
    assert list(by_name) == ["language_id", "quality_rules", "exact_dedup", "near_dedup", "best_fit_packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), name)
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    model = langid.fit(first)
    judged = {r["doc_id"]: (r["text"], model.judge(r["text"])) for r in first.collect()}
    assert kept["language_id"] == {i: t for i, (t, (lang, _, known)) in judged.items() if lang != "und" and known >= langid.LEAST_KNOWN}
    assert kept["quality_rules"] == {i: t for i, t in kept["language_id"].items() if passes_quality(t)}
    assert 0 < len(kept["quality_rules"]) < len(kept["language_id"])
    newest = {}
    for i, text in kept["quality_rules"].items():
        newest[text] = max(i, newest.get(text, -1))
    assert set(kept["exact_dedup"]) == set(newest.values())
    ids = list(kept["exact_dedup"])
    groups = near_groups(list(kept["exact_dedup"].values()))
    assert set(kept["near_dedup"]) == {max(ids[i] for i in g) for g in groups}
    packed = corpus_pipeline.pack_sequences(spark, docs, SF_DIR).collect()
    assert_packed(packed, list(kept["near_dedup"].items()), 1024)
    pieces = sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed)
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in whole) == pieces


def test_stages_on_odd_and_empty_tables(spark):
    docs = documents(spark, [(*r, "en") for r in odd_rows()])
    left = {}
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = stored(stage(spark, frame, SF_DIR), "odd")
            assert frame.columns == docs.columns
            left.setdefault(name, sorted((r["doc_id"] for r in frame.collect()), key=repr))
        assert (corpus_pipeline.STAGES[-1][1](spark, frame, SF_DIR).count() > 0) == (frame.count() > 0)
    # Nulls, blanks and signs go first, short texts then; of the copies, and of the near copies, the largest id stays.
    assert not {3, 4, 7, 11} & set(left["language_id"]) and not {8, 9, 10} & set(left["quality_rules"])
    assert set(left["near_dedup"]) <= {6, 12} and 6 in left["near_dedup"]


def test_every_operator_has_its_query():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in driver.queries()
    assert importlib.util.find_spec("quirelake.llm").origin
