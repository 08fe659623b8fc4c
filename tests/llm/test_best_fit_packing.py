"""Packing: every piece once, ids of the library, no sequence overfull, and as few sequences as a search finds."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from llm_cases import nasty_texts
from tokenizers import Tokenizer

from strata.llm import best_fit_packing as P
from strata.llm.queries import QUERIES

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


def best_fit(lengths, capacity):
    """Number of sequences that plain best-fit decreasing needs."""
    room = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= x]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - x)
        else:
            room.append(capacity - x)
    return len(room)


def test_chunks_encode_like_the_library():
    lib, own, rng = Tokenizer.from_file(PATH), P.ChunkEncoder(PATH), random.Random(2)
    bits = ["a", "It's", "don't", " ", "  ", "\n", "\t\t", "\r\n", "42", "3.14", "é", "中文", "<|endoftext|>", "!!", "\u00a0", "\u2003", "\x0b", "\x1c", "\x85", "😀", "\u200b", "x" * 50, "\u0301"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + [t or "" for _, t in nasty_texts()]
    assert own.by_chunk
    assert [bytes(x) for x in own.encode(pa.array(texts))] == [np.array(e.ids, "<u4").tobytes() for e in lib.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("seed", range(12))
def test_plan_uses_every_length_and_beats_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 100, 1024])
    kind = seed % 4
    draw = {0: lambda: rng.randint(1, capacity), 1: lambda: min(capacity, 1 + int(rng.expovariate(12 / capacity))), 2: lambda: rng.choice([capacity * 2 // 3, capacity // 3, 1, 2]),
            3: lambda: rng.choice([rng.randint(1, capacity), capacity * 7 // 10])}[kind]
    lengths = [draw() for _ in range(rng.randint(1, 1500))]
    plan = P.plan_sequences(Counter(lengths), capacity)
    used = Counter()
    for p in plan:
        assert p.times > 0 and sum(p.lengths) <= capacity
        for x in p.lengths:
            used[x] += p.times
    assert used == Counter(lengths)
    n = sum(p.times for p in plan)
    assert n >= -(-sum(lengths) // capacity)
    assert n <= best_fit(lengths, capacity) + 1


def test_index_of_pair_sums():
    rng = random.Random(4)
    for _ in range(12):
        counts = Counter(rng.randint(1, 20) for _ in range(rng.randint(1, 14)))
        index = P.Complements(counts, 20)
        while left := {x: int(n) for x, n in enumerate(index.left) if n}:
            sums = {sum(c) for k in (1, 2, 3) for c in combos(left, k)}
            for gap in range(1, 21):
                assert index.pairs[gap] == sum(1 for a in left for b in left if a < b and a + b == gap) + (left.get(gap / 2, 0) > 1)
                got = index.filling(gap, Counter())
                assert (got is not None) == (gap in sums)
                assert got is None or (sum(got) == gap and all(left[x] >= n for x, n in Counter(got).items()))
            x = rng.choice(list(left))
            index.use([x] * rng.randint(1, left[x]), 1)


def combos(left, k):
    import itertools

    return [c for c in itertools.combinations_with_replacement(sorted(left), k) if all(left[x] >= n for x, n in Counter(c).items())]


def check(rows, docs):
    """Rows of the result against the documents, encoded by the library."""
    lib = Tokenizer.from_file(PATH)
    want = Counter()
    for doc, text in docs:
        ids = np.array([*lib.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = (len(ids) - 1) % 1024 + 1
        begins = [0, *range(first, len(ids), 1024)]
        for k, a in enumerate(begins):
            b = begins[k + 1] if k + 1 < len(begins) else len(ids)
            want[doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by)


def test_query_packs_whole_tables(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = QUERIES["op11_best_fit_packing"](spark, sf).collect()
    n = check(rows, docs)
    assert n <= best_fit([r["length"] for r in rows], 1024) and n <= -(-sum(r["length"] for r in rows) // 1024) + 2


def test_packing_nasty_rows(spark, nasty, empty):
    docs = nasty_texts()
    check(P.pack(nasty, PATH, 2).collect(), docs)
    assert P.pack(empty, PATH, 2).count() == 0
    hot = spark.createDataFrame([(i, "one text" if i % 3 == 0 else f"w{i % 40} " * (i % 300)) for i in range(6000)], "doc_id long, text string").repartition(7)
    check(P.pack(hot, PATH, 2).collect(), [(r["doc_id"], r["text"]) for r in hot.collect()])
