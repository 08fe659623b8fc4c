"""BPE encoding and decoding with a public tokenizer file.

Method: tree concatenation.  A long text is cut into leaves that are encoded
in parallel as rows of their own; neighbours are then concatenated pairwise,
level by level.  At each join a window around the cut is encoded again and
grown until it holds a unit (a word or token with the same span and ids)
that the left half has too and, behind it, one that the right half has too;
the halves are spliced there.  Pieces of byte-pair encoding do not look
across an agreed token, so the result is the encoding of the whole text.

Words of plain Latin letters go to the library's BPE model directly, each
distinct word once per batch (with a bounded cache per worker); all other
words go through the library's whole pipeline.  A tokenizer whose pipeline
is not of this word-splitting kind is given whole texts instead.

Defined results: a null text is encoded as the empty text (no ids); row
order, ties and repeated rows don't matter (each row is encoded on its own);
an empty table gives an empty table; columns other than the two named are
ignored, whatever their names."""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.ship import ship_package
from strata.llm.words import bounded, split_words, spread, texts_of

LEAF_CHARS = 32_768
FIRST_WINDOW = 64
CACHE_WORDS = 200_000
CACHE_TAILS = 20_000
BATCH_BYTES = 4 << 20
LEAF_BATCH_BYTES = 1 << 20
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# The normaliser and splitter for which words can be encoded one by one.
WORD_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def byte_letters() -> list[str]:
    """The printable letter that byte-level BPE uses for each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in plain]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
    return [letters[b] for b in range(256)]


def pack(ids: Iterable[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    ids = list(ids)
    return struct.pack(f"<{len(ids)}I", *ids)


class Codec:
    """A tokenizer file with its word cache (one per Python worker)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        spec = json.loads(self.lib.to_str())
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
        self.by_word = (spec.get("normalizer") == WORD_NORMALIZER and split[0].get("type") == "Split"
                        and split[0].get("pattern") == {"Regex": WORD_PATTERN} and split[0].get("behavior") == "Removed"
                        and split[0].get("invert") is True and split[1].get("type") == "ByteLevel"
                        and not split[1].get("add_prefix_space") and not split[1].get("use_regex")
                        and not any(c.isspace() for t in spec["added_tokens"] for c in t["content"])
                        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]))
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.model = self.lib.model
        self.table = dict(enumerate(byte_letters()))
        # lower-case letters, words as they stand and runs of signs -> packed ids
        self.cache: dict[str, bytes] = {}
        self.seen: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        size = self.lib.get_vocab_size(with_added_tokens=True)
        self.vocab_size = 1 + max(self.lib.get_vocab(with_added_tokens=True).values(), default=size - 1)
        self.tokens = None
        if spec.get("decoder") is None:  # the library then joins the token strings by blanks
            self.tokens = pa.array([self.lib.id_to_token(i) or "" for i in range(self.vocab_size)], pa.large_string())

    def letters(self, word: str) -> bytes | None:
        """Ids of a word of Latin letters, perhaps with ASCII signs behind; None for any other word."""
        core = word.rstrip(SIGNS)
        if not core.isalpha():
            return None
        low = core.lower()
        ids = self.cache.get(low)
        if ids is None:
            if low.isascii():
                mapped = low
            elif max(core) < "\u0180" and low.isalpha():
                mapped = low.encode().decode("latin-1").translate(self.table)
            else:
                return None
            ids = pack([t.id for t in self.model.tokenize(mapped)])
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[low] = ids
        return ids + self.signs(word[len(core):]) if len(core) < len(word) else ids

    def signs(self, tail: str) -> bytes:
        ids = self.tails.get(tail)
        if ids is None:
            ids = pack(self.lib.encode(tail, add_special_tokens=False).ids)
            if len(self.tails) < CACHE_TAILS:
                self.tails[tail] = ids
        return ids

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, flat ids) of the words, one after another."""
        out = list(map(self.seen.get, words))
        new = [i for i, ids in enumerate(out) if ids is None]
        rest = []
        if len(self.seen) >= CACHE_WORDS:
            self.seen.clear()
        for i in new:
            ids = out[i] = self.letters(words[i])
            if ids is None:
                rest.append(i)
            else:
                self.seen[words[i]] = ids
        for i, e in zip(rest, self.lib.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
            out[i] = pack(e.ids)
        return np.fromiter(map(len, out), np.int64, len(out)) // 4, np.frombuffer(b"".join(out), "<u4")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of whole texts."""
        if self.by_word:
            offsets, codes, words = split_words(texts)
            return spread(codes, offsets, *self.words(words))
        out = [e.ids for e in self.lib.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64)
        return offsets, np.fromiter((x for ids in out for x in ids), np.uint32, int(offsets[-1]))

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The library's ``decode(ids, skip_special_tokens=False)`` of each sequence."""
        if self.tokens is not None:
            strings = self.tokens.take(pa.array(ids.astype(np.int32)))
            return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), strings), pa.scalar(" ", pa.large_string()))
        parts = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
        return pa.array(self.lib.decode_batch(parts, skip_special_tokens=False), pa.large_string())

    def units(self, text: str, base: int = 0) -> "Units":
        """The encoding of one stretch of text, with the spans of its words or tokens."""
        starts, ends, ids = [], [], []
        for first, word in _words_at(text) if self.by_word else [(0, text)]:
            if self.by_word and (known := self.letters(word)) is not None:
                starts.append(first + base)
                ends.append(first + base + len(word))
                ids.append(struct.unpack(f"<{len(known) // 4}I", known))
            else:
                e = self.lib.encode(word, add_special_tokens=False)
                for i, (a, b) in zip(e.ids, e.offsets):
                    if ids and ends[-1] > first + base + a:  # tokens that share a character form one unit
                        ends[-1] = max(ends[-1], first + base + b)
                        ids[-1] += (i,)
                    else:
                        starts.append(first + base + a)
                        ends.append(first + base + b)
                        ids.append((i,))
        return Units(starts, ends, ids)


class Units:
    """Words or tokens with their spans in the whole text."""

    def __init__(self, starts: list[int], ends: list[int], ids: list[tuple]):
        self.starts, self.ends, self.ids = starts, ends, ids

    def part(self, first: int, last: int) -> "Units":
        return Units(self.starts[first:last], self.ends[first:last], self.ids[first:last])

    def __add__(self, other: "Units") -> "Units":
        return Units(self.starts + other.starts, self.ends + other.ends, self.ids + other.ids)

    def flat(self) -> np.ndarray:
        return np.array([i for ids in self.ids for i in ids], np.uint32)


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def _words_at(text: str) -> Iterator[tuple[int, str]]:
    at = 0
    for word in text.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" "):
        if word:
            yield at, word
        at += len(word) + 1


def _stable(c: str) -> bool:
    """No character before ``c`` can combine with it under NFC."""
    return c < "̀" or "㐀" <= c <= "鿿" or "가" <= c <= "힣"


def safe_cut(text: str, at: int, step: int) -> int:
    """The nearest position from ``at`` on (downwards for ``step`` -1) where the text may be cut."""
    while 0 < at < len(text) and not _stable(text[at]):
        at += step
    return min(max(at, 0), len(text))


def leaves(text: str, size: int) -> list[int]:
    """Cut positions of a text: equal leaves of about ``size`` characters, a power of two of them."""
    n = 1
    while len(text) > n * size:
        n *= 2
    cuts = [safe_cut(text, len(text) * i // n, 1) for i in range(n + 1)]
    return sorted(set(cuts) | {0, len(text)})


def join_units(codec_: Codec, text: str, left: Units, right: Units, lo: int, cut: int, hi: int,
               window: int = FIRST_WINDOW) -> Units:
    """Exact units of ``text[lo:hi]`` from those of its halves at ``cut``."""
    while True:
        a, b = max(lo, safe_cut(text, max(lo, cut - window), -1)), min(hi, safe_cut(text, min(hi, cut + window), 1))
        w = codec_.units(text[a:b], a)
        known = {s: k for k, s in enumerate(left.starts) if s >= a} if a > lo else {}
        keep, first = (0, 0) if a == lo else (-1, -1)  # keep: units of the left half; first: of the window
        for k, (s, e, ids) in enumerate(zip(w.starts, w.ends, w.ids)):
            j = known.get(s)
            if j is not None and e <= cut and left.ends[j] == e and left.ids[j] == ids:
                keep, first = j, k
        if first >= 0:
            known = {s: k for k, s in enumerate(right.starts) if s < b} if b < hi else {}
            if b == hi:
                return left.part(0, keep) + w.part(first, len(w.ids))
            for k in range(first, len(w.ids)):
                j = known.get(w.starts[k])
                if j is not None and right.ends[j] == w.ends[k] and right.ids[j] == w.ids[k]:
                    return left.part(0, keep) + w.part(first, k) + right.part(j, len(right.ids))
        window *= 2


def join_tree(codec_: Codec, text: str, cuts: list[int], parts: list[Units]) -> Units:
    """Concatenate the leaves pairwise, level by level."""
    while len(parts) > 1:
        out, at = [], [cuts[0]]
        for i in range(0, len(parts) - 1, 2):
            out.append(join_units(codec_, text, parts[i], parts[i + 1], cuts[i], cuts[i + 1], cuts[i + 2]))
            at.append(cuts[i + 2])
        if len(parts) % 2:
            out.append(parts[-1])
            at.append(cuts[len(parts)])
        parts, cuts = out, at
    return parts[0] if parts else Units([], [], [])


def binary_rows(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    """Rows of raw little-endian values."""
    raw = np.ascontiguousarray(values)
    ends = (offsets * raw.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])


def _encode_short(path: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in bounded(batches, max_bytes=BATCH_BYTES):
            offsets, ids = c.encode(texts_of(b.column("text")))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), binary_rows(offsets, ids.astype("<u4")).cast(pa.binary()),
                 c.decode(offsets, ids).cast(pa.string())], ["doc_id", "ids", "decoded"])
            pa.default_memory_pool().release_unused()
    return run


def _cut_long(size: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches):
            for row, doc, text in zip(b.column("row"), b.column("doc_id"), b.column("text").to_pylist()):
                cuts = leaves(text, size)
                n = len(cuts) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row.as_py()] * n, pa.int64()), pa.array([doc.as_py()] * n, pa.int64()), pa.array(range(n), pa.int32()),
                     pa.array([text[x:y] for x, y in zip(cuts, cuts[1:])], pa.string())], ["row", "doc_id", "leaf", "text"])
    return run


def _encode_leaves(path: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in bounded(batches, max_bytes=LEAF_BATCH_BYTES):
            rows = []
            for text in b.column("text").to_pylist():
                u = c.units(text)  # one leaf's words at a time: they are many small objects
                rows.append([np.array(x, "<i4").tobytes() for x in (u.starts, u.ends, [len(i) for i in u.ids], u.flat())])
            cols = [pa.array(x, pa.binary()) for x in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*b.schema.names, "starts", "ends", "lens", "ids"])
    return run


def _join_leaves(path: str) -> Callable:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = codec(path)
        pdf = pdf.sort_values("leaf")
        text, cuts, parts = "".join(pdf["text"]), [0], []
        for r in pdf.itertuples():
            starts, ends, lens, ids = (np.frombuffer(x, "<i4").astype(np.int64) for x in (r.starts, r.ends, r.lens, r.ids))
            at = np.concatenate([[0], np.cumsum(lens)])
            ids = ids.tolist()
            parts.append(Units((starts + cuts[-1]).tolist(), (ends + cuts[-1]).tolist(), [tuple(ids[x:y]) for x, y in zip(at, at[1:])]))
            cuts.append(cuts[-1] + len(r.text))
        ids = join_tree(c, text, cuts, parts).flat()
        decoded = c.decode(np.array([0, len(ids)]), ids)[0].as_py()
        out = pd.DataFrame({"doc_id": pdf["doc_id"].iloc[:1].to_numpy(), "ids": [ids.astype("<u4").tobytes()], "decoded": [decoded]})
        return out
    return run


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``ids`` (little-endian
    unsigned 32-bit integers, no special tokens added) and ``decoded`` (the
    ids decoded again).  ``tokenizer`` is the path of a tokenizers file."""
    ship_package(docs.sparkSession)
    schema = "doc_id long, ids binary, decoded string"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    short = rows.filter(F.length("text") <= leaf_chars).mapInArrow(_encode_short(tokenizer), schema)
    # the leaves of a long text are rows dealt over all tasks; only its own leaves meet again
    cut = (rows.withColumn("row", F.monotonically_increasing_id()).filter(F.length("text") > leaf_chars)
           .mapInArrow(_cut_long(leaf_chars), "row long, doc_id long, leaf int, text string"))
    coded = cut.repartition(F.col("row"), F.col("leaf")).mapInArrow(
        _encode_leaves(tokenizer), "row long, doc_id long, leaf int, text string, starts binary, ends binary, lens binary, ids binary")
    long = coded.groupBy("row").applyInPandas(_join_leaves(tokenizer), schema)
    return short.unionByName(long)
