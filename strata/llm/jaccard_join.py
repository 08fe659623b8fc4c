"""N-gram Jaccard join by T-occurrence search with DivideSkip.

A document's set is its distinct word shingles.  Two documents link when
``den * |intersection| >= num * |union|`` (``num / den`` is the similarity).

1. *Blocks.*  Equal sets become one first.  Sets of sizes a <= b that link differ in at most
   k = (a + b)(den - num)/(den + num) elements.  For each size class, with the sizes just above it
   that can link into it, the element space is dealt into m > k parts by hash; linked sets agree on
   at least m - k parts.  Each set emits a signature per part that isn't empty (of all parts, if
   m - k or more of its own are empty, so agreement on empty parts alone isn't missed either).
   Within a class, sets that share a signature are chained into blocks; every link lies inside a
   block, and a set is in two blocks at most.  Sets that share fewer signatures with all others
   together than any partner would share (m - k less their empty parts; 1 if they emit those) are
   left out first.
2. *T-occurrence search.*  In a block, every set
   queries the inverted lists of its elements: it must share T elements with a
   partner, so the L longest lists are set aside, the short ones are merged,
   and only sets found T - L times there are probed in the long lists by
   binary search.  A block of more than ``task_tokens`` elements is dealt into parts, and every pair of
   parts is searched as a task of its own: nothing is dropped.
3. Links are joined into components.

Only sets in shared blocks are read again; links and signatures stay in
Spark.  Elements, words and sets are compared by 64- and 128-bit fingerprints.

Defined results: a null text is empty; empty texts have no shingles and link
with nothing; a text of fewer words than a shingle is one shingle; rows with a null id are
returned with a null component and link with nothing; rows that share an id
count as one document with all their links; other columns are ignored by
``components`` and passed through by ``drop_near_duplicates``."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.bpe import binary_rows
from strata.llm.components import connected_components
from strata.llm.ship import ship_package
from strata.llm.words import bounded, give_back, hash_words, mix, shingles, split_words, texts_of
from strata.session import scratch_path

TASK_TOKENS = 2_000_000


class SizeClasses:
    """Size classes, the largest size that links into each class from above,
    and the number of parts for each class with the one above it.

    Classes are one and a half times (or the quotient of linked sizes, if
    that is more) wide: wider ones need more parts, narrower ones put more
    sets into two classes; this is near the fewest signatures in all."""

    def __init__(self, num: int, den: int, largest: int):
        self.first = [1]  # smallest size of each class
        while self.first[-1] <= largest:
            self.first.append(max(self.first[-1] * den // num, self.first[-1] * 3 // 2) + 1)
        tops = [x - 1 for x in self.first[1:]]
        self.reach = [top * den // num for top in tops]
        self.allowed = [(top + reach) * (den - num) // (den + num) for top, reach in zip(tops, self.reach)]
        self.parts = [k + 1 + (0 if k < 3 else 2 + k // 10) for k in self.allowed]

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(np.array(self.first), sizes, "right") - 1


def signatures(offsets: np.ndarray, values: np.ndarray, num: int, den: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, signature) rows of all sets, and the number of signatures
    that each set shares with any partner at least: first for the size class
    of each set with the one above, then for the class below with its own."""
    sizes = np.diff(offsets)
    classes = SizeClasses(num, den, int(sizes.max(initial=1)))
    own = classes.of(np.maximum(sizes, 1))
    doc = np.repeat(np.arange(len(sizes)), sizes)
    out = []
    for back in (0, 1):  # as a member of its own class and as the larger set of the class below
        cls = own - back
        use = (sizes > 0) & (cls >= 0)
        if back:
            use &= sizes <= np.array(classes.reach)[np.maximum(cls, 0)]
        parts = np.where(use, np.array(classes.parts)[np.maximum(cls, 0)], 0)
        allowed = np.where(use, np.array(classes.allowed)[np.maximum(cls, 0)], 0)
        begin = np.concatenate([[0], np.cumsum(parts)]).astype(np.int64)
        keep = use[doc]
        d, v = doc[keep], values[keep]
        at = begin[d] + (mix(v + (cls[d].astype(np.uint64) << np.uint64(32))) % parts[d].astype(np.uint64)).astype(np.int64)
        total = np.zeros(int(begin[-1]), np.uint64)
        np.add.at(total, at, mix(v))
        filled = np.bincount(at, minlength=len(total)) > 0
        owner = np.repeat(np.arange(len(sizes)), parts)
        empty = np.bincount(owner[~filled], minlength=len(sizes))
        agree = parts - allowed
        emit = filled | (empty >= agree)[owner]
        # a partner that doesn't emit its empty parts has fewer than ``agree`` of them, so one filled part agrees at least
        need = np.where(empty >= agree, 1, agree - empty)
        part = np.arange(len(total)) - begin[owner]
        key = mix(total ^ mix(part.astype(np.uint64) + (cls[owner].astype(np.uint64) << np.uint64(32)) + np.uint64(1)))
        out.append((owner[emit], key[emit], need))
    return out


def fold(texts: pa.Array) -> pa.Array:
    """A-Z lower-cased."""
    return pc.ascii_lower(texts)


def sets_of(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    offsets, codes, words = split_words(fold(texts))
    hashes = hash_words(words)
    return shingles(hashes[codes] if len(words) else np.empty(0, np.uint64), offsets, n)


def _digest(part: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(part.tobytes())


def _sketch(n: int, num: int, den: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            offsets, values = sets_of(texts_of(batch.column("text")), n)
            digests = [_digest(values[a:b]) for a, b in zip(offsets, offsets[1:])]
            cols = []
            for doc, sig, need in signatures(offsets, values, num, den):
                cols.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(offsets))), pa.int32()), pa.array(sig.view(np.int64))))
                cols.append(pa.array(need, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("place"), pa.array(np.diff(offsets), pa.int64()), pa.array(digests, pa.binary()), *cols],
                                             ["doc_id", "place", "n_shingles", "digest", "own", "own_need", "below", "below_need"])
    return run


def _sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, signature) rows; of the nodes with one signature in a batch, the first is ``sent``, and all are ``shared`` if there are several."""
    for batch in batches:
        place, nodes, keys = batch.column("place").to_numpy(), [], []
        for above, name in enumerate(("own", "below")):
            lists = batch.column(name)
            keys.append(lists.flatten().to_numpy(zero_copy_only=False))
            nodes.append(np.repeat(place * 2 + above, lists.value_lengths().to_numpy(zero_copy_only=False)))
        node, key = np.concatenate(nodes), np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        node, key = node[order], key[order]
        first = np.append(True, key[1:] != key[:-1])[: len(key)]
        group = np.cumsum(first) - 1
        shared = (np.bincount(group) > 1)[group] if len(key) else first
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(key, pa.int64()), pa.array(first), pa.array(shared)], ["node", "s", "sent", "shared"])
    give_back()


def _sets(n: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            offsets, values = sets_of(texts_of(batch.column("text")), n)
            digests = [_digest(values[a:b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(digests, pa.binary()), binary_rows(offsets, values).cast(pa.binary())],
                                             ["doc_id", "digest", "elements"])
    return run


def occurrence_search(sets: list[np.ndarray], num: int, den: int, side: np.ndarray | None = None,
                      above: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(i, partners before i) for every set, by size.

    ``sets`` hold distinct elements and are sorted by size, then as given.
    With ``side`` only partners of the other side are sought.  Two sets that
    are both ``above`` (of the larger size class) are left to that class's own block."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.lexsort((owner, flat))
    owner, flat = owner[order], flat[order]
    begin = np.flatnonzero(np.append(True, flat[1:] != flat[:-1])) if len(flat) else np.empty(0, np.int64)
    end = np.append(begin[1:], len(flat))
    number = np.empty(len(flat), np.int64)  # list of each element, in the order of the sets
    number[order] = np.repeat(np.arange(len(begin)), end - begin)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for i, size in enumerate(sizes):
        smallest = -(-size * num // den)
        first = int(np.searchsorted(sizes, smallest))
        if first >= i or size == 0:
            continue
        lists = number[starts[i]:starts[i + 1]]
        lists = lists[end[lists] - begin[lists] > 1]
        length = end[lists] - begin[lists]
        need = -(-num * size // den)  # least overlap with any partner that is no larger
        if len(lists) < need:
            continue
        lists = lists[np.argsort(length, kind="stable")]
        aside = int(min(need - 1, need / (0.02 * np.log2(length.max() + 1) + 1)))  # the longest lists, set aside
        short, long = lists[: len(lists) - aside], lists[len(lists) - aside:]
        merged = np.concatenate([owner[b:e] for b, e in zip(begin[short], end[short])]) if len(short) else np.empty(0, np.int64)
        merged = merged[(merged >= first) & (merged < i)]
        found, count = np.unique(merged, return_counts=True)
        keep = count >= need - aside
        found, count = found[keep], count[keep]
        if side is not None:
            keep = side[found] != side[i]
            found, count = found[keep], count[keep]
        if above is not None and above[i]:
            keep = ~above[found]
            found, count = found[keep], count[keep]
        if not len(found):
            continue
        # overlap that each candidate needs, given its own size
        least = -(-num * (size + sizes[found]) // (num + den))
        left = aside
        for b, e in zip(begin[long], end[long]):  # from the shortest of the long lists on
            spot = b + np.searchsorted(owner[b:e], found)
            count += (spot < e) & (owner[np.minimum(spot, e - 1)] == found)
            left -= 1
            keep = count + left >= least
            found, count, least = found[keep], count[keep], least[keep]
            if not len(found):
                break
        found = found[count >= least]
        if len(found):
            yield i, found


def _search(num: int, den: int) -> Callable:
    def run(key: tuple, block: pa.Table) -> pa.Table:
        ids = block.column("place").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in block.column("elements").to_pylist()]
        order = np.lexsort((ids, [len(s) for s in sets]))
        ids, sets = ids[order], [sets[k] for k in order]
        parts = block.column("part").to_numpy()[order]
        side = parts if key[1].as_py() != key[2].as_py() else None
        above = block.column("above").to_numpy(zero_copy_only=False)[order].astype(bool)
        label = np.arange(len(ids))
        links = np.zeros(len(ids), np.int64)
        for i, partners in occurrence_search(sets, num, den, side, above):
            links[i] += len(partners)
            links[partners] += 1
            met = np.unique(np.append(label[partners], label[i]))
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
        used = links > 0
        return pa.table({"a": pa.array(ids[used], pa.int64()), "b": pa.array(ids[label[used]], pa.int64()), "n_links": pa.array(links[used], pa.int64())})
    return run


def _kept(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SKETCH = "doc_id long, place long, n_shingles long, digest binary, own array<long>, own_need long, below array<long>, below_need long"


def _nodes(different: DataFrame, lists: str, above: int) -> DataFrame:
    """A set as a member of its own size class, or of the one below."""
    return different.filter(F.size(lists) > 0).select((F.col("place") * 2 + above).alias("node"), "place", "doc_id", "digest", "n_shingles",
                                                      F.lit(bool(above)).alias("above"), F.col(f"{lists}_need").alias("need"))


def _blocks(different: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, block): the sets that share a signature, chained.

    A signature that occurs again in its batch is known to be shared there: one of its nodes
    goes on to be counted with the other batches', the others stay.  So a signature that a third
    of all sets share is one row per batch in the only exchange of all signatures."""
    signed = different.mapInArrow(_sign, "node long, s long, sent boolean, shared boolean")
    counted = signed.filter("sent").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("s"))).filter("shared or n > 1")
    shared = _kept(counted.select("node", "s").unionByName(signed.filter("not sent").select("node", "s")), "shared")
    # a set that shares too few signatures with all others together has no partner
    enough = shared.groupBy("node").agg(F.count(F.lit(1)).alias("n")).join(nodes.select("node", "need"), "node").filter("n >= need").select("node")
    shared = _kept(shared.join(enough, "node", "left_semi"), "signed")
    least = shared.groupBy("s").agg(F.min("node").alias("least"))
    edges = shared.join(least, "s").filter("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    return _kept(connected_components(edges).select("node", F.col("component").alias("block")), "blocks")


def components(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text",
               task_tokens: int = TASK_TOKENS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest
    doc_id reachable by links) and n_links (linked different sets)."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    numbered = rows.withColumn("place", F.monotonically_increasing_id())
    sketch = _kept(numbered.mapInArrow(_sketch(n, num, den), SKETCH), "sketch")
    # equal sets are one from here on: the copies of a text neither sign nor meet again
    known = sketch.filter("doc_id is not null and n_shingles > 0")
    first = known.groupBy("digest").agg(F.min(F.struct("doc_id", "place")).alias("least"))
    different = _kept(known.join(first.select(F.col("least.place").alias("place")), "place", "left_semi"), "different")
    nodes = _kept(_nodes(different, "own", 0).unionByName(_nodes(different, "below", 1)), "nodes")
    classes = nodes.join(_blocks(different, nodes), "node").groupBy("block", "place").agg(
        F.first("doc_id").alias("doc_id"), F.first("digest").alias("digest"), F.first("n_shingles").alias("n_shingles"), F.min("above").alias("above"))
    classes = _kept(classes, "classes")
    sizes = classes.groupBy("block").agg(F.sum("n_shingles").alias("tokens"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    dealt = classes.join(sizes.select("block", F.ceil(F.col("tokens") / task_tokens).alias("parts")), "block")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("place"), "parts"))
    sets = rows.join(dealt.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(_sets(n), "doc_id long, digest binary, elements binary")
    # a block in parts: each pair of parts meets once, a part with itself too
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda p: F.struct(F.least("part", p).alias("x"), F.greatest("part", p).alias("y")))
    tasks = dealt.join(sets.dropDuplicates(["doc_id", "digest"]), ["doc_id", "digest"]).select(
        "block", "place", "elements", "above", "part", F.explode(pairs).alias("p"))
    tasks = tasks.select("block", "p.x", "p.y", "place", "elements", "above", "part")
    found = _kept(tasks.groupBy("block", "x", "y").applyInArrow(_search(num, den), "a long, b long, n_links long"), "links")
    # an id with several texts joins the sets of all
    named = known.select("doc_id", "digest").distinct().join(first.select("digest", F.col("least.place").alias("place")), "digest")
    several = named.groupBy("doc_id").agg(F.min("place").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    same = named.join(several, "doc_id").select("a", F.col("place").alias("b"))
    joined = connected_components(found.select("a", "b").unionByName(same))
    counts = found.groupBy("a").agg(F.sum("n_links").alias("n_links"))
    of_set = (first.select("digest", "least.doc_id", "least.place").join(joined, F.col("place") == F.col("node"), "left")
              .join(counts, F.col("place") == F.col("a"), "left")
              .select("digest", "doc_id", F.coalesce("component", "place").alias("component"), "n_links"))
    of_set = _kept(of_set, "of-set")
    name = of_set.groupBy("component").agg(F.min("doc_id").alias("name"))
    named = known.select("doc_id", "digest").distinct().join(of_set.drop("doc_id").join(name, "component"), "digest")
    per_doc = named.groupBy("doc_id").agg(F.min("name").alias("component"), F.sum("n_links").alias("n_links"))
    out = sketch.select("doc_id", "n_shingles").join(per_doc, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"))


def drop_near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest id."""
    drop = components(docs, n, num, den, id_col, text_col).filter("doc_id <> component_id").select(F.col("doc_id").alias("dropped_id"))
    drop = _kept(drop.distinct(), "near")
    return docs.join(drop, docs[id_col].cast("long") == drop["dropped_id"], "left_anti")
