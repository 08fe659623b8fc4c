"""Encoding and token files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import nasty_texts
from tokenizers import Tokenizer

from strata.llm import bpe, token_files
from strata.llm.queries import QUERIES, tokenizer_path
from strata.session import scratch_path


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(tokenizer_path())


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_query_is_the_librarys(spark, sf, lib):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {}
    for d in docs:
        ids = lib.encode(d["text"] or "", add_special_tokens=False).ids
        want[d["doc_id"]] = (len(ids), hashlib.sha256(packed(ids)).hexdigest(),
                             hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op8_bpe"](spark, sf).collect()}
    assert got == want
    start, files = 0, {r["doc_id"]: r for r in QUERIES["op2_token_files"](spark, sf).collect()}
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        ids = lib.encode(d["text"] or "", add_special_tokens=False).ids + [1]
        r = files[d["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(packed(ids)))
        start += len(ids)


def test_tree_concatenation_is_exact(lib):
    rng = random.Random(11)
    codec = bpe.codec(tokenizer_path())
    kinds = [list("abcdefghijklmnopqrstuvwxyz"), list("abc  \n.,'!?<|>019éßİŐΣς́가😀 ") + ["'s", "'re", "<|endoftext|>", "tion"],
             list("!'s<|>ab") + ["<|endoftext|>"], list("éá가ᅡ中😀💒b")]
    for k in range(300):
        text = "".join(rng.choice(kinds[k % 4]) for _ in range(rng.randint(0, 400)))
        want = lib.encode(text, add_special_tokens=False).ids
        offsets, ids = codec.encode(pa.array([text]))
        assert ids.tolist() == want
        assert codec.decode(offsets, ids)[0].as_py() == lib.decode(want, skip_special_tokens=False)
        for size in (16, 50):
            cuts = bpe.leaves(text, size)
            parts = [codec.units(text[a:b], a) for a, b in zip(cuts, cuts[1:])]
            assert bpe.join_tree(codec, text, cuts, parts).flat().tolist() == want


def test_nasty_documents(spark, nasty, empty, lib):
    want = sorted((d is None, d or 0, packed(lib.encode(t or "", add_special_tokens=False).ids)) for d, t in nasty_texts())
    for leaf in (bpe.LEAF_CHARS, 1000):
        got = bpe.encode_decode(nasty, tokenizer_path(), leaf_chars=leaf).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, bytes(r["ids"])) for r in got) == want
    assert bpe.encode_decode(empty, tokenizer_path()).count() == 0
    out = scratch_path(spark, "files")
    rows = token_files.token_digests(spark, nasty, tokenizer_path(), out, 1).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted([d for d, _ in nasty_texts()], key=lambda d: (d is not None, d or 0))
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows]).tolist()[:-1]]
    assert token_files.token_digests(spark, empty, tokenizer_path(), scratch_path(spark, "files"), 1).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 7, 11, 15, 16, 17, 20])
def test_packing_round_trip_and_random_access(tmp_path, bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 1003).astype(np.uint32)
    assert (token_files.unpack_bits(token_files.pack_bits(ids, bits), bits, len(ids)) == ids).all()
    fs, folder = token_files.open_folder(str(tmp_path))
    ends = np.array([0, 10, 10, 500, 1003])
    token_files.write_file(fs, f"{folder}/f", np.arange(5), ends, ids, bits, 33, "try")
    f = token_files.TokenFile(fs, f"{folder}/f")
    for k in range(5):
        assert (f.document(k) == ids[ends[k - 1] if k else 0:ends[k]]).all()
    assert (f.ids(498, 777) == ids[498:777]).all()


def test_bits():
    assert [token_files.bits_for(n) for n in (1, 2, 3, 256, 257, 49408, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]
    with pytest.raises(ValueError):
        token_files.pack_bits(np.array([8], np.uint32), 3)
