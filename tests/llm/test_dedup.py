"""Exact, near and line dedup against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirelake.llm import exact_dedup, line_dedup, order_minhash, queries
from quirelake.llm.common import Workspace
from tests.llm.helpers import bag, documents, odd_rows, sentence


def exact_expected(rows):
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[r[1] or ""].append(r[0])
    return [
        (r[0], max((x for x in groups[r[1] or ""] if x is not None), default=None), len(groups[r[1] or ""])) for r in rows
    ]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.length(t).cast("string")])
def test_exact_dedup_of_odd_rows(spark, digest):
    """A digest that often collides gives the same result as a strong one: bytes decide."""
    rows = odd_rows()
    if digest is not exact_dedup.sha256:
        rows += [(20, "abc"), (21, "abd"), (22, "abc"), (23, "xbd"), (24, "abd"), (25, "eno")]
    found = exact_dedup.exact_dedup(documents(spark, rows), digest=digest)
    assert bag(found, "doc_id", "keep_id", "group_size") == sorted(exact_expected(rows), key=repr)
    assert found.filter("kept").count() == len({r[1] or "" for r in rows})


def test_state_lives_across_batches(spark):
    """One file per trigger: a copy that comes batches later still hits its entry."""
    rows = [(i, f"text {i % 5}") for i in range(40)]
    found = exact_dedup.exact_dedup(documents(spark, rows).repartition(8), max_files=1)
    assert bag(found, "doc_id", "keep_id", "group_size") == sorted(exact_expected(rows), key=repr)


def test_keep_one_returns_the_columns_of_its_input(spark):
    docs = documents(spark, odd_rows())
    for keep in (exact_dedup.keep_one, order_minhash.keep_one):
        left = keep(docs)
        assert left.columns == docs.columns
        assert left.count() < docs.count()


def test_empty_tables(spark):
    docs = documents(spark, [(1, "x")]).filter("doc_id > 5")
    assert exact_dedup.exact_dedup(docs).count() == 0
    assert order_minhash.near_duplicates(docs).count() == 0
    assert line_dedup.deduplicate(docs).count() == 0


def shingles(text):
    words = text.lower().split()
    return [tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))] if words else []


def common(a, b):
    last = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(last[j] + 1 if x == y else max(last[j + 1], now[j]))
        last = now
    return last[-1]


def near_groups(texts):
    """Groups of texts by brute force over all pairs."""
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    cut = [shingles(t or "") for t in texts]
    bags = [Counter(c) for c in cut]
    for i in range(len(texts)):
        for j in range(i):
            total = len(cut[i]) + len(cut[j])
            most = sum((bags[i] & bags[j]).values())  # no alignment has more in common
            if cut[i] and cut[j] and most >= 0.8 * (total - most) - 1e-9:
                w = common(cut[i], cut[j])
                if w >= 0.8 * (len(cut[i]) + len(cut[j]) - w) - 1e-9:
                    parent[find(i)] = find(j)
    groups = defaultdict(set)
    for i in range(len(texts)):
        groups[find(i)].add(i)
    return {frozenset(g) for g in groups.values()}


def test_near_duplicates_equal_all_pairs(spark):
    """Chains, where neighbours are similar and ends are not, a big group around one text, and unrelated texts."""
    rng = random.Random(11)
    texts = [" ".join(sentence(rng, rng.randint(1, 90))) for _ in range(30)]
    base = sentence(rng, 120)
    for _ in range(25):
        words = list(base)
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = "changed" + str(rng.randrange(1000))
        texts.append(" ".join(words))
    chain = sentence(rng, 150)
    for k in range(8):
        chain = chain[8:] + sentence(rng, 8)
        texts.append(" ".join(chain))
    texts += [None, "", "  ", "A b", "a B", texts[0].upper()]
    found = order_minhash.near_duplicates(documents(spark, list(enumerate(texts))))
    groups = defaultdict(set)
    for r in found.collect():
        groups[r["class_id"]].add(r["doc_id"])
        assert r["kept"] == (r["doc_id"] == r["keep_id"])
    assert {frozenset(g) for g in groups.values()} == near_groups(texts)


def test_a_shared_passage_makes_few_pairs_and_loses_no_link(spark, monkeypatch):
    """Texts that share most of their words without being similar, and some pairs among them that are."""
    rng = random.Random(21)
    passage, texts = sentence(rng, 60), []
    for i in range(120):
        own = sentence(rng, 25)
        texts.append(" ".join(own + passage))
        if i % 10 == 0:
            texts.append(" ".join([*own[:-1], "changed", *passage]))
        if i % 15 == 0:
            texts.append(" ".join([*own[:3], *own[5:], *passage]))
    pairs = []
    compare = order_minhash._compare

    def counted(found, *rest):
        pairs.append(found.count())
        return compare(found, *rest)

    monkeypatch.setattr(order_minhash, "_compare", counted)
    found = order_minhash.near_duplicates(documents(spark, list(enumerate(texts))))
    groups = defaultdict(set)
    for r in found.collect():
        groups[r["class_id"]].add(r["doc_id"])
    assert {frozenset(g) for g in groups.values()} == near_groups(texts)
    # Each bucket's first round is at most one pair per member and bucket; after it, hardly any.
    assert sum(pairs[1:]) < len(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=25), st.lists(st.integers(0, 9), min_size=1, max_size=25), st.sampled_from([0.5, 0.8]))
def test_similar_texts_meet_in_their_prefixes(a, b, s):
    """Under any order of windows, the first common one lies in both prefixes and leaves room for what must be common."""
    x, y = (set(order_minhash.labelled(np.array(v, dtype=np.uint64)).tolist()) for v in (a, b))
    shared = len(x & y)
    if shared >= s * (len(x) + len(y) - shared) - 1e-9:
        left, right = sorted(x), sorted(y)
        first = min(x & y)
        i, j = left.index(first), right.index(first)
        assert i < order_minhash.prefix_length(len(x), s) and j < order_minhash.prefix_length(len(y), s)
        assert 1 + min(len(x) - 1 - i, len(y) - 1 - j) >= s / (1 + s) * (len(x) + len(y)) - 1e-9


def test_scratch_tables_are_deleted(spark):
    """What stays behind is the input's copy and the result."""
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    rows = [(i, " ".join(sentence(random.Random(i // 3), 40)) + f" {i}") for i in range(30)]
    before = {p.name for p in shared.iterdir()}
    found = order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert found.select("class_id").distinct().count() == 10
    assert sorted(p.name.split("-")[0] for p in shared.iterdir() if p.name not in before) == ["near", "rows"]


def test_near_duplicates_of_odd_rows(spark):
    rows = odd_rows()
    found = order_minhash.near_duplicates(documents(spark, rows))
    assert found.count() == len(rows)
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert by_id[5]["class_id"] == by_id[6]["class_id"] and by_id[1]["class_id"] == by_id[12]["class_id"]
    assert by_id[3]["group_size"] == 1 and by_id[4]["group_size"] == 1 and by_id[8]["group_size"] == 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=20), st.lists(st.integers(0, 5), min_size=1, max_size=20), st.sampled_from([0.3, 0.5, 0.8]))
def test_band_alignment_is_exact(a, b, s):
    w = common(a, b)
    assert order_minhash.aligned(np.array(a), np.array(b), s) == (w >= s * (len(a) + len(b) - w) - 1e-9)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(500, 300), (400, 500)], "a bigint, b bigint")
    nodes = edges.selectExpr("a id").union(edges.selectExpr("b id")).distinct()
    with Workspace(spark) as space:
        labels = {r["id"]: r["label"] for r in order_minhash.components(edges, order_minhash.alone(nodes), space).collect()}
    assert all(labels[i] == 0 for i in range(201)) and {labels[i] for i in (300, 400, 500)} == {300}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 8), max_size=15), st.lists(st.integers(0, 8), max_size=15))
def test_patience_aligns_equal_lines_in_order(a, b):
    pairs = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    if a == b:
        assert len(pairs) == len(a)


def lines_expected(rows):
    """Every key's earliest holder aligned with every later holder, with plain strings."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    lines = [["" if not x.strip(" ") else x for x in (r[1] or "").split("\n")] for r in rows]
    holders = defaultdict(list)
    for i in order:
        full = [x for x in lines[i] if x]
        keys = {("line", x) for x in full} | {("run", *full[k : k + 3]) for k in range(len(full) - 2)}
        if 0 < len(full) < 3:
            keys.add(("all", *full))
        for k in keys:
            holders[k].append(i)
    gone = defaultdict(set)
    for found in holders.values():
        for i in found[1:]:
            gone[i] |= set(line_dedup.common_lines(lines[found[0]], lines[i], ""))
    return [(r[0], len(lines[i]), len(gone[i])) for i, r in enumerate(rows)]


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(3)
    pool = [" ".join(sentence(rng, 6)) for _ in range(40)] + ["", " "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for i in range(60)]
    rows += [(100 + i, "a menu\n" + " ".join(sentence(rng, 9))) for i in range(20)] + [(200 + i, "same\ntext") for i in range(15)]
    rows += [(300, None), (301, ""), (302, "\n\n")]
    found = line_dedup.deduplicate(documents(spark, rows))
    assert bag(found, "doc_id", "n_lines", "n_removed") == sorted(lines_expected(rows), key=repr)
    left = {r["doc_id"]: r["text"] for r in found.collect()}
    assert not left[114].startswith("a menu\n") and left[200] == "same\ntext" and left[214] == ""


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=15), st.lists(st.integers(0, 9), max_size=15))
def test_signs_for_other_lines_leave_the_alignment(a, b):
    """Lines 0 are blank; lines that only one side has are left out and stand for runs."""
    whole = line_dedup.common_lines([str(x) if x else "" for x in a], [str(x) if x else "" for x in b], "")

    def short(own, other, side):
        places = [i for i, x in enumerate(own) if x and x in other]
        blanks = [i for i, x in enumerate(own) if not x]
        return line_dedup.spelled(places, [(own[i], 1) for i in places], blanks, len(own), side)

    left, _ = short(a, b, line_dedup.LEFT)
    right, numbers = short(b, a, line_dedup.RIGHT)
    assert [numbers[j] for j in line_dedup.common_lines(left, right, line_dedup.BLANK)] == whole


def test_line_dedup_of_odd_rows(spark):
    rows = odd_rows()
    found = line_dedup.deduplicate(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    assert sum(r["n_removed"] > 0 for r in found if r["doc_id"] in (1, 2, None)) == 3


def test_line_dedup_query_pairs_holders_of_frequent_lines(spark, tmp_path):
    """Passages of one and two lines that many documents hold, among lines of their own."""
    rng = random.Random(8)
    own = [[" ".join(sentence(rng, 8)) for _ in range(4)] for _ in range(30)]
    rows = [(i, "\n".join([*x[:2], "one shared line", x[2], "shared twice", "and again", x[3]])) for i, x in enumerate(own)]
    rows += [(100 + i, f"one shared line\n{i} alone") for i in range(3)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op3_line_dedup(spark, str(tmp_path))
    assert bag(found, "doc_id", "n_removed") == sorted([(0, 0), *((i, 3) for i in range(1, len(own))), *((100 + i, 1) for i in range(3))], key=repr)


def test_line_dedup_moves_texts_the_same_way_at_every_size(spark):
    """What is removed grows with the corpus: it is shuffled to the texts also where it is small enough to broadcast."""
    rows = [(i, f"first {i}\nshared one\nshared two\nlast {i}") for i in range(20)]
    left = line_dedup.deduplicate(documents(spark, rows))
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert sorted(r["n_removed"] for r in left.collect()) == [0] + [2] * 19
