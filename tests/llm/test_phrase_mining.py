"""Phrase mining against counting every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import nasty_texts
from pyspark.sql import functions as F

from strata.llm import phrase_mining as M

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def brute(docs, least, top):
    counts, n = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for words in pieces(text):
            n[lang] += len(words)
            f.update(tuple(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in (near(candidates, p) if len(p) == 2 else ())):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def near(candidates, p):
    return [(q, b) for q, b in candidates.items() if len(q) == 3 and p in (q[:2], q[1:])]


def mined(docs, **kw):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in M.collocations(docs, **kw).collect())


def test_words_end_where_pieces_and_texts_do():
    rng = random.Random(6)
    texts = ["".join(rng.choice(["Ab", "é", " ", "\t", ".", ",", "\n", "\r", "x", "\u00a0", "-"]) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    array = pa.array(["zz", *texts])[1:]
    text, last, codes, words = M.piece_words(array)
    names = words.to_pylist()
    got = {}
    for t, end, c in zip(text, last, codes):
        got.setdefault(t, [[]])[-1].append(names[c].decode())
        if end:
            got[t].append([])
    assert {t: p[:-1] for t, p in got.items()} == {i: [p for p in pieces(t) if p] for i, t in enumerate(texts) if any(pieces(t))}


@pytest.mark.parametrize("least", [1, 3, 10])
def test_quicksort_counts_every_frequent_prefix(least):
    rng = np.random.default_rng(least)
    for _ in range(30):
        rows = rng.integers(0, rng.integers(2, 9), (int(rng.integers(1, 400)), 3)).astype(np.int32)
        rows[:, 1][rows[:, 0] == 0] = 0
        rows[:, 2][rows[:, 1] == 0] = 0
        weights = rng.integers(1, 5, len(rows))
        want = Counter()
        for row, n in zip(rows.tolist(), weights.tolist()):
            for k in (1, 2, 3):
                if row[k - 1]:
                    want[tuple(row[:k])] += n
        got = [(tuple(rows[at, :k].tolist()), n) for k, at, n in M.multikey_quicksort(rows, weights, least)]
        assert len(got) == len(dict(got)) and dict(got) == {p: n for p, n in want.items() if n >= least}


def test_blobs_and_their_merging():
    words = pa.array([b"a", b"b", b"c", b"d"], pa.binary())
    rows = np.array([[1, 2, 0], [4, 4, 4], [1, 2, 0]], np.int32)
    blob, _ = M.to_blob(*M.merged(rows, np.array([1, 2, 3])), words)
    other, _ = M.to_blob(np.array([[3, 1, 2]], np.int32), np.array([1 << 33]), words)
    got, n, names = M.from_blobs([blob, other, blob])
    got, n = M.merged(got, n)
    text = {tuple(names[c - 1].as_py().decode() if c else "" for c in row): k for row, k in zip(got.tolist(), n.tolist())}
    assert text == {("a", "b", ""): 8, ("d", "d", "d"): 4, ("c", "a", "b"): 1 << 33}


def corpus(n, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "The", "of"]
    out = []
    for i in range(n):
        words = [rng.choice(vocabulary[: 6 + i % 57]) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", ". ", ",", "\n", "\t"]) for w in words)
        out.append((rng.choice(["en", "de", None, ""]), "New York City is big. " + text if i % 3 == 0 else text))
    return out


@pytest.mark.parametrize("top,bucket_bytes", [(2000, M.BUCKET_BYTES), (40, 3000)])
def test_collocations_are_exact(spark, top, bucket_bytes):
    """Whole counts, also when buckets are dealt again, and with one passage in a third of all texts."""
    rows = corpus(700)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n int, word string").repartition(5)
    assert mined(docs, top=top, bucket_bytes=bucket_bytes) == brute(rows, 10, top)


def test_scores_pass_64_bits(spark):
    big = 999_999_999_999_989
    cases = [(big, big, big), (big - 1, big, big), (10, 10, big), (123_456_789_012, 987_654_321_098_765, 123_456_789_013), (7, 7, 7), (10, 1000, 100), (big // 3, big, big // 3 + 1)]
    rows = spark.createDataFrame(cases, "a long, l long, r long").select("a", "l", "r", M.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert [r["s"] for r in rows] == [1_000_000 * r["a"] ** 2 // (r["l"] * r["r"]) for r in rows]


def test_nasty_rows_and_empty_tables(nasty, empty):
    rows = [("en", t) for _, t in nasty_texts()]
    assert mined(nasty, least=2) == brute(rows, 2, 2000)
    assert mined(empty) == []
