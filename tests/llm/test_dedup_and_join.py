"""Exact and near duplicates against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import nasty_texts

from strata.llm import exact_dedup, jaccard_join
from strata.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_components(rows, n, num, den):
    sets = {d: shingle_set(t, n) for d, t in rows}
    root = {d: d for d in sets}
    links = defaultdict(set)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and den * len(x & y) >= num * len(x | y):
                p, q = top(a), top(b)
                root[max(p, q)] = min(p, q)
                if x != y:
                    links[a].add(y)
                    links[b].add(x)
    return {d: (len(sets[d]), top(d), len(links[d])) for d in ids}


@pytest.mark.parametrize("n,num,tokens", [(3, 90, 2_000_000), (3, 90, 2000), (5, 80, 2_000_000), (2, 50, 3000)])
def test_components_are_exact(spark, sf, n, num, tokens):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()], n, num, 100)
    got = jaccard_join.components(docs, n, num, 100, task_tokens=tokens).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in got} == want


def test_near_copies_in_a_large_group(spark):
    """A group of near copies that only link through their original is found whole, in parts too."""
    words = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(words))]
    for i in range(1, 60):
        w = list(words)
        w[i * 2] = f"x{i}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows, 3, 90, 100)
    for tokens in (2_000_000, 1000):
        got = jaccard_join.components(docs, 3, 90, 100, task_tokens=tokens).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in got} == want
    assert {v[1] for v in want.values()} == {0}


def test_no_link_is_lost_between_small_sets(spark):
    """Pairs just over 0.8, of every size from 10 to 40, each pair alone in its words; a set meets its pair only."""
    rng, rows = random.Random(5), []
    for size in range(10, 41):
        for k in range(25):
            more = rng.randint(0, size // 9)
            drop = (size + more) * 20 // 180 - more  # as many as the bar allows
            words = [f"{size}.{k}.{i}" for i in range(size)]
            other = words[: size - max(drop, 0)] + [f"{size}.{k}.x{i}" for i in range(more + max(drop, 0))]
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.components(docs, 1, 80, 100).collect()}
    sets = {d: set(t.split()) for d, t in rows}
    linked = [d for d in range(0, len(rows), 2) if 100 * len(sets[d] & sets[d + 1]) >= 80 * len(sets[d] | sets[d + 1])]
    assert len(linked) > 500
    assert got == {d: d - 1 if d % 2 and d - 1 in set(linked) else d for d in sets}


def test_signatures_of_linked_sets_reach_the_bound():
    """Every linked pair shares as many signatures as the smaller need of both."""
    rng = np.random.default_rng(11)
    for size in range(1, 60):
        for _ in range(40):
            k = int(rng.integers(0, size * 20 // 100 + 1))
            a = rng.integers(0, 1 << 63, size, np.uint64)
            b = np.concatenate([a[: size - k], rng.integers(0, 1 << 63, int(rng.integers(0, size * 20 // 100 + 1)), np.uint64)])
            x, y = np.unique(a), np.unique(b)
            if 100 * len(np.intersect1d(x, y)) < 80 * len(np.union1d(x, y)):
                continue
            (ox, nx), (oy, ny) = (([set(s[d == 0].tolist()) for d, s, _ in sig], [int(n[0]) for _, _, n in sig])
                                  for sig in (jaccard_join.signatures(np.array([0, len(v)]), v, 80, 100) for v in (x, y)))
            pairs = [(len(ox[i] & oy[j]), nx[i], ny[j]) for i in (0, 1) for j in (0, 1) if ox[i] & oy[j]]
            assert any(n >= p and n >= q for n, p, q in pairs), (size, k)


def test_join_on_nasty_documents(nasty, empty):
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in jaccard_join.components(nasty).collect()), key=str)
    group = {1: 1, 7: 1, 8: 1, 10: 5}
    want = sorted(((d is None, d or 0, len(shingle_set(t, 3)), group.get(d, d)) for d, t in nasty_texts()), key=str)
    assert got == want
    assert jaccard_join.components(empty).count() == 0
    kept = jaccard_join.drop_near_duplicates(nasty, 3, 90, 100)
    assert kept.columns == nasty.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, d) for d in (1, 2, 3, 4, 5, 6, 9, 11)] + [(True, 0)] * 2


def test_ids_with_several_texts_join_their_groups(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (4, b), (9, "other words here")], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in jaccard_join.components(docs).collect()}
    assert got == {(3, 3), (5, 3), (4, 3), (9, 9)}


def test_exact_dedup(spark, sf, nasty, empty):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    groups = defaultdict(list)
    for r in docs.collect():
        groups[r["text"] or ""].append(r["doc_id"])
    kept = exact_dedup.drop_duplicates(docs, fan_in_bits=1)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(max(v) for v in groups.values())
    out = exact_dedup.duplicates(nasty).collect()
    assert len(out) == len(nasty_texts())
    by = defaultdict(list)
    for r in out:
        by[r["text_sha256"]].append(r)
    assert set(by) == {hashlib.sha256((t or "").encode()).hexdigest() for _, t in nasty_texts()}
    for rows in by.values():
        assert sum(r["kept"] for r in rows) == 1 and {r["group_size"] for r in rows} == {len(rows)}
        assert {r["keep_id"] for r in rows} == {max((r["doc_id"] for r in rows if r["doc_id"] is not None), default=None)}
    stay = exact_dedup.drop_duplicates(nasty)
    assert stay.columns == nasty.columns
    assert sorted((r["doc_id"] or 0) for r in stay.collect()) == [0, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    assert exact_dedup.duplicates(empty).count() == 0 and exact_dedup.drop_duplicates(empty).count() == 0


def test_tree_merge_over_many_runs(spark):
    rows = spark.range(0, 5000, 1, 37).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('t', id % 700) END AS text")
    got = exact_dedup.duplicates(rows, fan_in_bits=1).filter("kept").collect()
    assert len(got) == 701 and max(r["group_size"] for r in got) == 1667
    assert next(r for r in got if r["group_size"] == 1667)["doc_id"] == 4998


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (200, 100), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
