"""Phrase collocation mining by multikey three-way quicksort of suffix pointers.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
those into words.  Every word begins a suffix of its piece; a suffix pointer
names its first ``depth`` words.

1. *Words.*  Counts of the leading words, for each language: the first
   partitions of the sort, made globally by a group-by.
2. *Routing.*  Suffixes go to buckets by their language and first two words, as
   blobs: distinct suffixes of a batch with their counts, over a dictionary of the
   blob's own words.  A phrase that stands in a third of all texts is one
   entry per batch.  A bucket above ``bucket_bytes`` is dealt again: its blobs are
   merged in groups of that size, equal suffixes made one, and routed on by another hash.
3. *Sort.*  In a bucket the pointers are partitioned at the word of their depth
   into less, equal and greater, all open partitions at once.  The equal part
   goes on at the next depth, and its weight is the count of its phrase.  A
   partition of less weight than ``least`` is abandoned: no phrase in it is frequent.
4. Cuts are scored by joins of phrases with their parts' counts, in exact
   decimal arithmetic; phrases inside longer ones that take half of their count
   are dropped, and each language's best are ranked (a partial top-k before the shuffle).

Defined results: a null text is empty, a null language is ``und``; rows that
repeat count again each; an empty table gives an empty result; other columns
are ignored, whatever their names."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.ship import ship_package
from strata.llm.words import bounded, give_back, hash_words, mix, texts_of
from strata.session import scratch_path

DEPTH = 3
LEAST = 10
TOP = 2000
HALF = 50  # percent of a phrase's count that a longer one must reach to take its place
SCALE = 1_000_000
BATCH_BYTES = 6 << 20
BUCKET_BYTES = 16 << 20  # before compression
MOST_BUCKETS = 4096

# Bytes that end a piece, bytes between words.
ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# --- words -----------------------------------------------------------------------------------------


def piece_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(text of each word, whether it ends its piece, codes, words): words in reading order, coded
    in the order of their bytes, which keeps a blob's own words short when packed."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(bytes(memoryview(raw)[offsets[0]:offsets[-1]]).translate(LOWER) if raw else b"", np.uint8)
    offsets -= offsets[0]
    kind = np.zeros(256, np.uint8)
    kind[np.frombuffer(BLANKS, np.uint8)] = 1
    kind[np.frombuffer(ENDS, np.uint8)] = 2
    kind = kind[data]
    inside = kind == 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    begins[first] = inside[first]  # a text's first byte begins a word of its own
    begins = np.flatnonzero(begins)
    held = np.concatenate([np.zeros(1, np.int32), np.cumsum(inside, dtype=np.int32)])
    ends = np.append(held[begins], held[-1]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[inside].tobytes())]).dictionary_encode()
    text = np.searchsorted(offsets, begins, "right") - 1
    breaks = np.cumsum(kind == 2, dtype=np.int32)[begins] if len(begins) else np.empty(0, np.int64)
    last = np.ones(len(begins), bool)
    last[:-1] = (text[1:] != text[:-1]) | (breaks[1:] != breaks[:-1])
    order = pc.sort_indices(words.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return text, last, rank[words.indices.to_numpy(zero_copy_only=False)], words.dictionary.take(pa.array(order))


def suffixes(codes: np.ndarray, last: np.ndarray, depth: int) -> np.ndarray:
    """Rows of ``depth`` word codes (from 1; 0 behind the end of the piece) of the suffix at each word."""
    out = np.zeros((len(codes), depth), np.int32)
    open_ = np.ones(len(codes), bool)
    for d in range(depth):
        n = len(codes) - d
        if n <= 0:
            break
        out[:n, d] = np.where(open_[:n], codes[d:] + 1, 0)
        open_[:n] &= ~last[d:]
    return out


def merged(rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows with their summed weights, in order."""
    if not len(rows):
        return rows, weights
    base = int(rows.max()) + 1
    if base ** rows.shape[1] < 1 << 63:
        key = rows[:, 0].astype(np.int64)
        for d in range(1, rows.shape[1]):
            key = key * base + rows[:, d]
        order = np.argsort(key)
    else:
        order = np.lexsort(rows.T[::-1])
    rows, weights = rows[order], weights[order]
    new = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
    return rows[new], np.add.reduceat(weights, new)


# --- blobs -----------------------------------------------------------------------------------------


PACKED = pa.ipc.IpcWriteOptions(compression="zstd")


def to_blob(rows: np.ndarray, weights: np.ndarray, words: pa.Array) -> tuple[bytes, int]:
    """Suffixes with their counts and their own words, as a compressed Arrow stream, and its bytes unpacked.

    The rows come sorted, so their columns are mostly runs and small steps."""
    used, local = np.unique(rows, return_inverse=True)
    if not len(used) or used[0] != 0:
        used, local = np.append(0, used), local + 1
    kind = np.uint16 if len(used) <= 1 << 16 else np.uint32
    local = local.reshape(rows.shape)
    own = words.take(pa.array(used[1:] - 1))
    sink = pa.BufferOutputStream()
    columns = {f"w{d}": pa.array(local[:, d].astype(kind)) for d in range(rows.shape[1])}
    tables = (pa.table({**columns, "n": pa.array(weights.astype(np.uint32 if weights.max(initial=0) < 1 << 32 else np.uint64))}), pa.table({"word": own}))
    for table in tables:
        with pa.ipc.new_stream(sink, table.schema, options=PACKED) as out:
            out.write_table(table)
    return sink.getvalue().to_pybytes(), sum(t.nbytes for t in tables)


def from_blobs(blobs: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(rows, weights, words) of several blobs, over one dictionary."""
    parts, weights, words = [], [], []
    for blob in blobs:
        source = pa.BufferReader(blob)
        table, own = pa.ipc.open_stream(source).read_all(), pa.ipc.open_stream(source).read_all()
        parts.append(np.stack([table.column(d).to_numpy() for d in range(table.num_columns - 1)], axis=1))
        weights.append(table.column("n").to_numpy().astype(np.int64))
        words.append(own.column("word").combine_chunks())
    coded = pa.chunked_array(words, pa.binary()).combine_chunks().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    codes, at, rows = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), 0, []
    for part, own in zip(parts, words):
        rows.append(np.append(0, codes[at:at + len(own)] + 1).astype(np.int32)[part])
        at += len(own)
    return np.concatenate(rows), np.concatenate(weights), coded.dictionary


def route(rows: np.ndarray, hashes: np.ndarray, lang: int, salt: int, buckets: int) -> np.ndarray:
    """Bucket of each suffix, by language and first two words; ``hashes`` are those of the words, 0 first."""
    seed = mix(np.array([lang ^ (salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)], np.uint64))
    return (mix(mix(hashes[rows[:, 0]] ^ seed) ^ hashes[rows[:, 1]]) % np.uint64(buckets)).astype(np.int64)


def word_hashes(words: pa.Array) -> np.ndarray:
    return np.append(np.uint64(0), hash_words(words.to_pylist()))


ROUTED = "lang string, bucket long, size long, blob binary"
ROUTED_ARROW = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("size", pa.int64()), ("blob", pa.binary())])


def _blobs(lang: str, rows: np.ndarray, weights: np.ndarray, words: pa.Array, bucket: np.ndarray) -> Iterator[dict]:
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            blob, size = to_blob(rows[part], weights[part], words)
            yield {"lang": lang, "bucket": int(bucket[part[0]]), "size": size, "blob": blob}


def _scan(depth: int, buckets: int) -> Callable:
    """Bucket -1: a batch's words with their counts; other buckets: its suffixes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, max_bytes=BATCH_BYTES):
            text, last, codes, words = piece_words(texts_of(batch.column("text")))
            langs = pc.fill_null(batch.column("lang"), "und").dictionary_encode()
            of_word = langs.indices.to_numpy(zero_copy_only=False)[text]
            rows = suffixes(codes, last, depth)
            hashes = word_hashes(words)
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                here = of_word == k
                own, n = np.unique(codes[here], return_counts=True)
                if not len(own):
                    continue
                seed = int(hash_words([lang])[0])
                both = rows[here & (rows[:, 1] > 0)] if depth > 1 else rows[:0]
                both, weights = merged(both, np.ones(len(both), np.int64))
                blob, size = to_blob(own[:, None] + 1, n, words)
                yield pa.RecordBatch.from_pylist([{"lang": lang, "bucket": -1, "size": size, "blob": blob}, *_blobs(lang, both, weights, words, route(both, hashes, seed, 0, buckets))], ROUTED_ARROW)
    return run


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, blob in zip(batch.column("lang").to_pylist(), batch.column("blob").to_pylist()):
            rows, weights, words = from_blobs([blob])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), words.take(pa.array(rows[:, 0] - 1)).cast(pa.string()), pa.array(weights)], ["lang", "word", "n"])


def _deal_again(salt: int, buckets: int) -> Callable:
    """Merge a group of one bucket's blobs and route its suffixes on."""
    def run(key: tuple, group: pa.Table) -> pa.Table:
        lang, bucket = key[0].as_py(), key[1].as_py()
        rows, weights, words = from_blobs(group.column("blob").to_pylist())
        rows, weights = merged(rows, weights)
        to = route(rows, word_hashes(words), int(hash_words([lang])[0]), salt, buckets)
        out = pa.Table.from_pylist(list(_blobs(lang, rows, weights, words, bucket * buckets + to)), ROUTED_ARROW)
        del rows, weights, words, to
        give_back()
        return out
    return run


# --- the sort --------------------------------------------------------------------------------------


def multikey_quicksort(rows: np.ndarray, weights: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, pointer, count) of every phrase of at least ``least`` occurrences; the pointer is a row that begins with it.

    All open partitions are split at once.  Only weights are asked for, so the
    three parts need no common order and are kept as lists of partitions by depth."""
    found = []
    pointers = np.flatnonzero(rows[:, 0] > 0)
    sizes, depths = np.array([len(pointers)], np.int64), np.zeros(1, np.int64)
    while len(pointers):
        begins = np.cumsum(sizes) - sizes
        part = np.repeat(np.arange(len(sizes)), sizes)
        words = rows[pointers, depths[part]]
        pivots = np.sort(words[np.stack([begins, begins + sizes // 2, begins + sizes - 1])], axis=0)[1]  # the median of three
        side = (words > pivots[part]).astype(np.int8) - (words < pivots[part])
        parts = []
        for which in (-1, 0, 1):
            here = side == which
            weight = np.bincount(part[here], weights[pointers[here]], len(sizes)).astype(np.int64)
            size = np.bincount(part[here], minlength=len(sizes))
            keep = weight >= least
            depth = depths
            if which == 0:
                keep &= pivots > 0  # equal at the end of the piece: no phrase
                heads = np.full(len(sizes), -1, np.int64)
                heads[part[here]] = pointers[here]
                found += zip((depths[keep] + 1).tolist(), heads[keep].tolist(), weight[keep].tolist())
                depth = depths + 1
                keep &= depth < rows.shape[1]
            chosen = here & keep[part]
            parts.append((pointers[chosen], size[keep], depth[keep]))
        pointers, sizes, depths = (np.concatenate(x) for x in zip(*parts))
    return found


def _sorted_phrases(least: int, depth: int) -> Callable:
    def run(key: tuple, group: pa.Table) -> pa.Table:
        rows, weights, words = from_blobs(group.column("blob").to_pylist())
        found = [f for f in multikey_quicksort(rows, weights, least) if f[0] > 1]
        lengths, heads, counts = (np.array(x, np.int64) for x in (zip(*found) if found else ([], [], [])))
        out = {"lang": pa.array([key[0].as_py()] * len(heads), pa.string()), "length": pa.array(lengths.astype(np.int32)), "n": pa.array(counts)}
        for d in range(depth):
            code = np.where(lengths > d, rows[heads, d], 0) if len(heads) else np.empty(0, np.int64)
            out[f"w{d}"] = words.take(pa.array(code - 1, mask=code == 0)).cast(pa.string())
        del rows, weights, words
        give_back()
        return pa.table(out)
    return run


def _kept(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def phrase_counts(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, lang_col: str = "lang", text_col: str = "text",
                  bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, word, n) of every word, and (lang, length, n, w0, w1, ...) of every phrase of 2 to ``depth``
    words that occurs ``least`` times or more."""
    spark = docs.sparkSession
    ship_package(spark)
    fan = min(MOST_BUCKETS, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    scanned = _kept(rows.mapInArrow(_scan(depth, fan), ROUTED), "suffixes")
    words = scanned.filter("bucket = -1").mapInArrow(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    open_, closed, salt = scanned.filter("bucket >= 0"), None, 0
    while True:  # deal buckets again until each fits a task; one round unless the corpus is far larger than the bucket count
        sizes = _kept(open_.groupBy("lang", "bucket").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("blobs")), "sizes")
        large = sizes.filter((F.col("total") > bucket_bytes) & (F.col("blobs") > 1))
        again = large.limit(1).count() > 0
        fits = open_.join(large.select("lang", "bucket"), ["lang", "bucket"], "left_anti") if again else open_
        closed = fits if closed is None else closed.unionByName(fits)
        if not again:
            break
        salt += 1
        share = F.pmod(F.xxhash64("blob"), F.ceil(F.col("total") / bucket_bytes))
        groups = open_.join(large, ["lang", "bucket"]).withColumn("share", share).groupBy("lang", "bucket", "share")
        open_ = _kept(groups.applyInArrow(_deal_again(salt, fan), ROUTED), "suffixes")
    schema = "lang string, length int, n long, " + ", ".join(f"w{d} string" for d in range(depth))
    return words, _kept(closed.groupBy("lang", "bucket").applyInArrow(_sorted_phrases(least, depth), schema), "phrases")


# --- collocations ----------------------------------------------------------------------------------


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (l * r)), exact for counts of up to 15 digits.

    The quotient is at most SCALE, as no part is rarer than its phrase, so a division
    of doubles is off by one at most; products of decimals (38 digits) decide."""
    a, left, right = (c.cast("decimal(15,0)") for c in (a, left, right))
    above, below = (a * a).cast("decimal(30,0)") * F.lit(SCALE).cast("decimal(7,0)"), (left * right).cast("decimal(30,0)")
    near = F.floor(above.cast("double") / below.cast("double")).cast("long")
    exact = [((near + d).cast("decimal(7,0)") * below <= above) for d in (1, 0)]
    return F.when(exact[0], near + 1).when(exact[1], near).otherwise(near - 1)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, lang_col: str = "lang", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Each language's ``top`` phrases of 2 to 3 words: lang, rank, phrase, a, l, r, n, score."""
    words, phrases = phrase_counts(docs, least, DEPTH, lang_col, text_col, bucket_bytes)
    words = _kept(words, "words")
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    often = words.filter(F.col("n") >= least)
    two = phrases.filter("length = 2").select("lang", F.col("w0").alias("x"), F.col("w1").alias("y"), F.col("n").alias("a"))
    three = phrases.filter("length = 3").select("lang", F.col("w0").alias("x"), F.col("w1").alias("y"), F.col("w2").alias("z"), F.col("n").alias("a"))

    def of_word(name: str, out: str) -> DataFrame:
        return often.select("lang", F.col("word").alias(name), F.col("n").alias(out))

    def of_pair(x: str, y: str, out: str) -> DataFrame:
        return two.select("lang", F.col("x").alias(x), F.col("y").alias(y), F.col("a").alias(out))

    inside = three.groupBy("lang", "x", "y").agg(F.max("a").alias("longer")).unionByName(
        three.groupBy("lang", F.col("y").alias("x"), F.col("z").alias("y")).agg(F.max("a").alias("longer"))).groupBy("lang", "x", "y").agg(F.max("longer").alias("longer"))
    pairs = (two.join(inside, ["lang", "x", "y"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < HALF * F.col("a")))
             .join(of_word("x", "l"), ["lang", "x"]).join(of_word("y", "r"), ["lang", "y"])
             .select("lang", F.concat_ws(" ", "x", "y").alias("phrase"), "a", "l", "r", score(F.col("a"), F.col("l"), F.col("r")).alias("score")))
    triples = (three.join(of_word("x", "l1"), ["lang", "x"]).join(of_pair("y", "z", "r1"), ["lang", "y", "z"])
               .join(of_pair("x", "y", "l2"), ["lang", "x", "y"]).join(of_word("z", "r2"), ["lang", "z"])
               .withColumns({f"s{k}": score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")) for k in (1, 2)}))
    second = F.col("s2") < F.col("s1")
    triples = triples.select("lang", F.concat_ws(" ", "x", "y", "z").alias("phrase"), "a", *[F.when(second, F.col(f"{c}2")).otherwise(F.col(f"{c}1")).alias(name)
                                                                                            for c, name in (("l", "l"), ("r", "r"), ("s", "score"))])
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = pairs.unionByName(triples).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
