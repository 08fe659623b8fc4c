"""Decontamination, personal data, toxicity, licences, URLs and chat windows: brute force, planted cases and nasty rows."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import nasty_texts
from pyspark.sql import functions as F

from strata.llm import chat_format, decontaminate, license_scan, pii, toxicity, url_filter
from strata.llm.queries import QUERIES, severity_grade

# --- decontamination -----------------------------------------------------------------------------


def brute_tiles(doc, item, n):
    """Greedy string tiling by its definition: mark the longest unmarked common run, again and again."""
    marked_doc, marked_item, tiles = set(), set(), []
    while True:
        best = None
        for j in range(len(item)):
            for i in range(len(doc)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and i + k not in marked_doc and j + k not in marked_item:
                    k += 1
                if k >= n and (best is None or k > best[2]):
                    best = (i, j, k)
        if best is None:
            return sorted(tiles)
        tiles.append(best)
        marked_doc.update(range(best[0], best[0] + best[2]))
        marked_item.update(range(best[1], best[1] + best[2]))


def test_tiling_is_greedy():
    rng = random.Random(4)
    for _ in range(150):
        item = [rng.choice("abcd") for _ in range(rng.randint(5, 25))]
        doc = [rng.choice("abcdx") for _ in range(rng.randint(5, 30))] + item[5:12] + ["x"] + item[:6]
        items = decontaminate.Items(((1, " ".join(item)),), 3)
        offsets, ids = items.word_ids(pa.array([" ".join(doc)]))
        _, _, at, place, length = items.matches(offsets, ids)
        got = decontaminate.tile(at, place, length, 3)
        assert sum(k for _, _, k in got) == sum(k for _, _, k in brute_tiles(doc, item, 3))
        assert all(doc[i:i + k] == item[j:j + k] for i, j, k in got)
        assert len({j + x for _, j, k in got for x in range(k)}) == sum(k for _, _, k in got)


def test_repeated_words_take_memory_for_their_diagonals_only(monkeypatch):
    rng = random.Random(7)
    for hits in (1 << 18, 3):
        monkeypatch.setattr(decontaminate, "HITS", hits)
        for _ in range(60):  # a few words often: many places on both sides
            item = [rng.choice("aab") for _ in range(rng.randint(4, 20))]
            docs = [[rng.choice("aaabx") for _ in range(rng.randint(0, 40))] for _ in range(3)]
            items = decontaminate.Items(((1, " ".join(item)),), 4)
            offsets, ids = items.word_ids(pa.array([" ".join(d) for d in docs]))
            doc, _, at, place, length = items.matches(offsets, ids)
            for k, words in enumerate(docs):
                mine = doc == k
                got = decontaminate.tile(at[mine] - offsets[k], place[mine], length[mine], 4)
                assert sum(x for _, _, x in got) == sum(x for _, _, x in brute_tiles(words, item, 4))
    monkeypatch.undo()
    items = decontaminate.Items(((1, "buffalo " * 60),), 5)
    batch = pa.RecordBatch.from_pydict({"text": ["buffalo " * 200_000]})
    offsets, ids = items.word_ids(batch.column("text"))
    assert len(items.matches(offsets, ids)[0]) == 200_000 + 60 - 2 * 5 + 1  # one for each diagonal of at least five words
    assert list(decontaminate._matches(items, batch, "text", 0.5)) == [(0, 1, 60, [(0, 0, 60)], 60)]


def test_query_finds_all_whole_items(spark, sf):
    docs = {r["doc_id"]: decontaminate.plain_words(r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r["item_id"]: decontaminate.plain_words(r["text"] or "") for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = {(d, i) for d, w in docs.items() for i, t in items.items() if f" {' '.join(t)} " in f" {' '.join(w)} "}
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in QUERIES["op3_decontaminate"](spark, sf).collect()}
    assert want and {k for k, c in got.items() if c == 1.0} >= want
    for (d, i), c in got.items():
        if len(docs[d]) < 400:
            assert sum(k for _, _, k in brute_tiles(docs[d], items[i], 5)) == round(c * len(items[i]))


def test_reordered_passages_blocks_and_nasty_rows(spark, nasty, empty):
    item = [f"q{i}" for i in range(40)]
    moved = " ".join(["start", *item[20:], "between", *item[:20], "end"]).title()
    part = " ".join(["clean", *item[:15], "clean"])
    docs = nasty.unionByName(spark.createDataFrame([(20, moved), (21, part)], "doc_id long, text string"), allowMissingColumns=True)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "one two"), (4, "one two three four five six seven")], "item_id long, text string")
    want = {(20, 1), (1, 4), (7, 4), (8, 4)}
    for size in (1 << 20, 100):
        found = decontaminate.contaminated(docs, bench, block_bytes=size).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == want and len(found) == 5
    assert [len(r["tiles"]) for r in found if r["doc_id"] == 20] == [2]
    kept = decontaminate.drop_contaminated(docs, bench, block_bytes=100)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 5
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_long_passages_and_short_items(spark):
    long = [f"w{i}" for i in range(130)]
    docs = spark.createDataFrame([(1, "x y " + " ".join(long[30:90]) + " z"), (2, "x " + " ".join(long[:20]) + " z"), (3, "so The quick, Brown fox ran"), (4, "the quick fox"), (5, "Hello world!"),
                                  (6, "say hello world"), (7, " x ".join(" ".join(long[i:i + 5]) for i in range(0, 60, 5)))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(long)), (2, "the quick brown fox"), (3, "hello world"), (4, "...")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): (r["item_words"], r["covered_words"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert found == {(1, 1): (130, 60), (3, 2): (4, 4), (5, 3): (2, 2)}
    assert {r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench).collect()} == {2, 4, 6, 7}


# --- personal data ---------------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def plain_base(text):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def test_base_spans_are_the_contracts(spark, sf):
    rng = random.Random(8)
    texts = ["".join(rng.choice(["a@b.c", "@", ".", "1.2.3.4", "256.1.1.1", "+1 (555) 123-4567", "4111 1111 1111 1111", "12-", " ", "x_y", "é", "+", "9", "a.b-c@d.e.f", "%", "\n"])
                     for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    for t in texts:
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(t)] == plain_base(t), t
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op7_pii"](spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        base = plain_base(rows[r["doc_id"]])
        counts = Counter(k for k, _, _ in base)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [counts[k] for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(filter(None, r["spans"].split(",")))


def test_contexts_discover_unseen_identifiers(spark, nasty, empty):
    rows = [(i, f"please ring hotline +1 555 000 {1000 + i} today word{i} number {i} rooms") for i in range(30)]
    rows += [(100, "please ring hotline 555-7788 today"), (101, "we have number 7 rooms and hotline phone"), (102, "then tel 555-7788 again"), (103, "hotline 020/4455 rest")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: [(pii.KINDS[s["kind"]], s["start"], s["end"]) for s in r["added"]] for r in pii.find_personal_data(docs).collect()}
    assert found[100] == [("phone", 20, 28)] and found[103] == [("phone", 8, 16)]
    assert not found[101] and not any(found[i] for i in range(30))
    out = pii.find_personal_data(nasty).collect()
    assert len(out) == len(nasty_texts()) and not any(r["base"] or r["added"] for r in out)
    assert pii.find_personal_data(empty).count() == 0


def added_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["added"] for r in pii.find_personal_data(docs).collect()}
    return [[(pii.KINDS[s["kind"]], t[s["start"]:s["end"]]) for s in found[i]] for i, t in enumerate(texts)]


def test_unseen_and_copied_values_dont_switch_discovery_off(spark):
    seeds = [f"ring hotline +1 555 000 {1000 + i} today, on floor +1 555 111 {1000 + i}" for i in range(30)]
    unseen = ["so ring hotline 555-7788 now"] * 200 + [f"so ring hotline 555-{8000 + i} now" for i in range(60)]
    other = [f"on floor {i} there" for i in range(60)] + [f"on floor 2024-01-{10 + i} there" for i in range(15)]
    got = added_of(spark, seeds + unseen + other)
    assert got[30:290] == [[("phone", t.split()[3])] for t in unseen] and not any(got[:30]) and not any(got[290:])


def test_spans_cover_whole_identifiers(spark):
    seeds = [f"ring hotline +1 555 000 {1000 + i} today" for i in range(30)] + [f"mail me: user{i}@host.org today" for i in range(30)]
    cases = ["call hotline 020 7946 0958 then", "call hotline (020) 7946 0958 then", "call hotline 020.7946.0958", "please mail me: joe.doe at host dot example dot org"]
    want = [[("phone", "020 7946 0958")], [("phone", "(020) 7946 0958")], [("phone", "020.7946.0958")], [("email", "joe.doe at host dot example dot org")]]
    assert added_of(spark, seeds + cases)[60:] == want
    assert [t[a:b] for t in ("a 4111 1111 1111 1112 b", "x1 22 33") for _, a, b in pii.candidates(t, [])] == ["4111 1111 1111 1112", "x1", "22 33"]


def test_very_long_words_and_digit_runs(spark):
    """Words of any length behind a confident context neither end the JVM nor take quadratic time."""
    seeds = [f"from node 10.0.{i}.7 today" for i in range(30)]
    dump = ":".join(f"{i % 256:02x}" for i in range(7000))
    cases = [f"from node {dump} today", "from node " + ".".join(["1"] * 30_000) + "x today", "7" * 1_000_000, "1." + "2" * 400_000 + "." + "3" * 400_000 + ".x"]
    start = time.time()
    assert pii.base_spans(cases[2]) == [] and pii.base_spans(cases[3]) == []
    assert time.time() - start < 5
    got = added_of(spark, seeds + cases)
    assert got[30] == [("ip", dump)] and got[32:] == [[], []]


def test_forms_of_unseen_identifiers(spark):
    values = ["a@b", "joe at host", "1.2.3", "1.2", "..", "fe80::1", "12:ab:ff", "4111 1111 1111 1112", "555-7788", "2024-01-10", "10.1.2024", "x1.2.3"]
    rows = spark.createDataFrame([(v,) for v in values], "v string").select(F.array(*pii.forms(F.col("v"))).alias("f")).collect()
    got = {v: "".join(k[0] for k, x in zip(pii.KINDS, r["f"]) if x) for v, r in zip(values, rows)}
    assert got == {"a@b": "e", "joe at host": "e", "1.2.3": "i", "1.2": "", "..": "", "fe80::1": "i", "12:ab:ff": "i", "4111 1111 1111 1112": "c",
                   "555-7788": "p", "2024-01-10": "", "10.1.2024": "", "x1.2.3": ""}


# --- toxicity --------------------------------------------------------------------------------------


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(0)
    x = (rng.random((3000, 12)) < 0.3).astype(float)
    true = np.array([2.5, 2, 1.5, -2, -1.5] + [0.0] * 7)
    score = x @ true + rng.logistic(size=3000)
    grades = np.digitize(score, [0.5, 2.5, 4.5])
    rows, cols = np.nonzero(x)
    w, theta = toxicity.fit_ordinal(rows, cols, 3000, 12, grades, penalty=0.002)
    assert np.abs(w[:5] - true[:5]).max() < 0.4 and np.abs(w[5:]).max() < 0.15
    assert np.all(np.diff(theta) > 0) and np.abs(theta - [0.5, 2.5, 4.5]).max() < 0.4


def test_severity_on_held_out_labels(spark, sf, nasty, empty):
    insults = ["vilegrub", "rotbrain", "scumlet"]
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]

    def text(grade):
        w = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        for _ in range(2 * grade):
            w[rng.randrange(len(w))] = rng.choice(insults) + rng.choice(["", "s", "ly", "ing"])
        return " ".join(w)

    rows = [(i, text(i % 3 if i % 4 == 0 else 0), i % 3 if i % 4 == 0 else 0) for i in range(900)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:600]] + [(5000, 1), (None, 2), (3, None)], "doc_id long, grade int")
    model = toxicity.fit(docs, labels, F.col("grade"))
    out = {r["doc_id"]: r for r in toxicity.severity(docs, model).collect()}
    held = rows[600:]
    hits = sum(out[i]["toxic"] for i, _, g in held if g)
    assert hits >= 0.9 * sum(g > 0 for _, _, g in held) and not any(out[i]["toxic"] for i, _, g in held if not g)
    mean = [np.mean([out[i]["expected_severity"] for i, _, g in held if g == k]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2]
    assert toxicity.drop_toxic(nasty, model).columns == nasty.columns
    assert toxicity.severity(nasty, model).count() == len(nasty_texts())
    assert toxicity.severity(empty, model).count() == 0 and toxicity.drop_toxic(empty, model).count() == 0
    none = toxicity.fit(docs, labels.limit(0), F.col("grade"))
    assert [r["expected_severity"] for r in toxicity.severity(nasty, none).collect()] == [0.0] * len(nasty_texts())
    got = QUERIES["op10_toxicity"](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    lab = spark.createDataFrame([(0, 1), (1, 1), (1, 0), (None, 1)], "toxic int, quality int")
    assert [r[0] for r in lab.select(severity_grade()).collect()] == [0, 1, 2, None]


# --- licences --------------------------------------------------------------------------------------


def brute_license(text, threshold=license_scan.THRESHOLD):
    idf, unknown, rows = license_scan.template_weights()
    vectors = {}
    for t, w, x in rows:
        vectors.setdefault(t, {})[w] = x
    best = None
    for segment in {text, *re.split(r"\r?\n|\r", text), *re.split(r"\n\s*\n", text)}:
        c = Counter(license_scan.template_words(segment))
        norm = math.sqrt(sum((n * idf.get(w, unknown)) ** 2 for w, n in c.items()))
        for t, v in vectors.items():
            s = round(sum(n * idf.get(w, unknown) * v.get(w, 0) for w, n in c.items()) / norm, 6) if norm else 0
            if s >= threshold:
                best = min(best or (0, "~"), (-s, t.split("#")[0]))
    return best


def test_license_statements_and_inheritance(spark, nasty, empty):
    files = [("repo/LICENSE", "Released under the MIT License.\nsome other words that do not matter here at all"),
             ("repo/a/b/x.py", "# Licensed under the Apache License, Version 2.0.\nprint(1)"), ("repo/a/b/y.py", "print(2)"),
             ("repo/a/COPYING", "This work is licensed under the GNU General Public License, version 3."), ("repo/z.py", "print(3)"),
             ("other/q.py", "the mit license is mentioned in this longer sentence about many other things"), (None, None), ("top.py", "")]
    got = {r["path"]: r for r in license_scan.scan_licenses(spark.createDataFrame(files, "path string, text string")).collect()}
    assert [(got[p]["license"], got[p]["origin"], got[p]["license_dir"]) for p in ("repo/a/b/x.py", "repo/a/b/y.py", "repo/z.py", "other/q.py", "top.py", "")] == [
        ("Apache-2.0", "own", None), ("GPL-3.0", "inherited", "repo/a"), ("MIT", "inherited", "repo"), (None, "none", None), (None, "none", None), (None, "none", None)]
    assert license_scan.scan_licenses(nasty).count() == len(nasty_texts()) and license_scan.scan_licenses(empty).count() == 0


def test_license_anchors_lose_nothing(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op1_license_scan"](spark, sf).collect()}
    for r in rows:
        best = brute_license(r["text"] or "")
        own = got[r["doc_id"]]
        assert (own["origin"] == "own") == (best is not None)
        if best:
            assert own["license"] == best[1] and own["score"] == pytest.approx(-best[0], abs=2e-6)


def test_licenses_stay_with_their_files_after_a_shuffle(spark):
    files = [(f"d{i}/f.py", "Licensed under the Apache License, Version 2.0." if i % 3 == 0 else f"print({i}) " * (i % 50)) for i in range(900)]
    rows = spark.createDataFrame(files, "path string, text string").repartition(40).dropDuplicates(["path"])
    got = {r["path"]: r["license"] for r in license_scan.scan_licenses(rows).collect()}
    assert got == {p: "Apache-2.0" if t.startswith("Licensed") else None for p, t in files}


def licenses_of(spark, texts):
    files = spark.createDataFrame([(f"d{i}/f.py", t) for i, t in enumerate(texts)], "path string, text string")
    got = {r["path"]: r for r in license_scan.scan_licenses(files).collect()}
    return [got[f"d{i}/f.py"]["license"] for i in range(len(texts))]


def test_license_statements_in_running_text(spark):
    filler = "zorg blat quux frob wibble snark plugh xyzzy grault garply"
    cases = [("Copyright (c) 2021 Jane Doe. Released under the MIT License.", "MIT"),
             (f"{filler}. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
             (f"# {filler} licensed under the Apache License, Version 2.0 {filler}", "Apache-2.0"),
             (f"{filler}\n{filler} this work is licensed under\nthe GNU General Public License, version 3, {filler}", "GPL-3.0"),
             ("// SPDX-License-Identifier: MIT", "MIT"), ("# SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
             (f"/* {filler} SPDX-License-Identifier: Apache-2.0 {filler} */", "Apache-2.0"), (f"{filler} SPDX-License-Identifier: MIT-0 {filler}", "MIT-0"),
             (f"{filler} license {filler}", None)]
    assert licenses_of(spark, [t for t, _ in cases]) == [want for _, want in cases]


def test_license_versions_and_variants(spark):
    def gnu(work, name, version):
        return (f"This {work} is free software; you can redistribute it and/or\nmodify it under the terms of the GNU {name}\nas published by the Free Software Foundation; "
                f"either version {version}\nof the License, or (at your option) any later version.")

    bsd = license_scan.BSD_TEXT.replace("met: Re", "met:\n\n1. Re").replace(". Re", ".\n\n2. Re")
    cases = [(gnu("program", "General Public License", "2"), "GPL-2.0"), (gnu("program", "General Public License", "3"), "GPL-3.0"),
             (gnu("library", "Lesser General Public License", "2.1"), "LGPL-2.1"), (gnu("library", "Lesser General Public License", "3"), "LGPL-3.0"),
             (gnu("program", "Affero General Public License", "3"), "AGPL-3.0"), ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
             ("BSD 3-Clause License", "BSD-3-Clause"), ("BSD 2-Clause License", "BSD-2-Clause"), ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
             ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY 3.0.", None),
             ("Licensed under the Apache License, Version 1.1.", None), (bsd, "BSD-2-Clause"), (bsd + "\n\n3." + license_scan.BSD_NAMES, "BSD-3-Clause"),
             (license_scan.BSD_TEXT + license_scan.BSD_ADVERT + license_scan.BSD_NAMES + license_scan.BSD_END, "BSD-4-Clause"),
             ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
             ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1", "LGPL-2.1"), (license_scan.MIT_TEXT + license_scan.MIT_NOTICE + license_scan.AS_IS, "MIT")]
    assert licenses_of(spark, [t for t, _ in cases]) == [want for _, want in cases]
    assert licenses_of(spark, [t for _, t in license_scan.TEMPLATES]) == [name for name, _ in license_scan.TEMPLATES]


# --- URLs ------------------------------------------------------------------------------------------


def test_url_rules_and_parts(spark):
    urls = ["http://Sub.Example.COM/en/x?y", "https://www.example.com/en/", "http://a.net/fr/#x", "http://a.net/de/", "http://com/", "http://x.com", "no scheme", None,
            "http://notexample.com/en/", "a\nb://h.net/es/?://z", "http://net/es/1", "http://x.com?a/b", "ftp://y.org/p#f?g"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = [tuple(r)[1:] for r in sorted(url_filter.filter_urls(pages).collect())]
    assert got == [("sub.example.com", "/en/x", "example.com/en/", "block"), ("www.example.com", "/en/", "www.example.com/en/", "allow"), ("a.net", "/fr/", "net/fr/", "block"),
                   ("a.net", "/de/", None, "block"), ("com", "/", "com/", "allow"), ("x.com", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
                   ("notexample.com", "/en/", "com/", "allow"), ("h.net", "/es/", "net/es/", "block"), ("net", "/es/1", "net/es/", "block"), ("x.com", "", None, "allow"),
                   ("y.org", "/p", None, "allow")]
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_distrust_flows_back_and_trust_forward(spark):
    links = {"bad.net": [], "farm.org": ["bad.net"], "ring.org": ["farm.org"], "good.com": ["friend.org"], "friend.org": ["bad.net", "good.com"], "far.org": []}
    pages = spark.createDataFrame([(i, f"http://{h}/{'fr' if h == 'bad.net' else 'x'}/", "".join(f"<a class=q HREF='https://{t}/p'>t</a>" for t in ts))
                                   for i, (h, ts) in enumerate(links.items())], "page_id long, url string, html string")
    scores = {r["host"]: r for r in url_filter.host_verdicts(pages).collect()}
    d = url_filter.DAMPING

    def power(edges, seeds):
        now = dict(seeds)
        for _ in range(url_filter.ROUNDS):
            new = dict(seeds)
            for s, ts in edges.items():
                for t in ts:
                    new[t] = new.get(t, 0) + d * now.get(s, 0) / len(ts)
            now = new
        return now

    back = {}
    for s, ts in links.items():
        for t in ts:
            back.setdefault(t, []).append(s)
    trust, distrust = power(links, {"good.com": 1 - d}), power(back, {"bad.net": 1 - d})
    for h, r in scores.items():
        assert r["trust"] == pytest.approx(trust.get(h, 0), abs=1e-12) and r["distrust"] == pytest.approx(distrust.get(h, 0), abs=1e-12)
    assert {h for h, r in scores.items() if r["blocked"]} == {h for h in scores if distrust.get(h, 0) > trust.get(h, 0) and distrust[h] >= 0.5 * (1 - d)}


def test_sql_agrees_on_a_linked_web(spark):
    """The oracle, on pages that link across hosts, absolutely and without a scheme: flows and linkers decide some verdicts."""
    import duckdb
    import pandas as pd

    from strata.llm.oracles import ORACLE

    rng, rows = random.Random(9), []
    for i in range(300):
        host = f"h{i % 60}.org" if i >= 40 else f"s{i % 20}.{rng.choice(['net', 'com'])}"
        into = [f"s{rng.randint(0, 19)}.{rng.choice(['net', 'com', 'net'])}" if rng.random() < 0.5 else f"h{rng.randint(0, 59)}.org" for _ in range(rng.randint(0, 3))]
        html = "".join(f'<a {"class=x " * (i % 2)}href={rng.choice(chr(34) + chr(39))}{rng.choice(["//", "https://", "HTTP://"])}{x}/p">' for x in into)
        rows.append((i, f"http://{host}{rng.choice(['/es/a', '/', '/fr/b?x'])}" if i % 41 else None, html if i % 37 else None))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages).collect())
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
    cur = con.execute(ORACLE["op4_url_filter"])
    names = [c[0] for c in cur.description]
    want = sorted(tuple(r[names.index(c)] for c in ("page_id", "host", "path", "rule", "verdict")) for r in cur.fetchall())
    assert [tuple(x) for x in got] == want
    unruled = [r[4] for r in got if r[3] is None]
    assert unruled.count("block") > 5 and unruled.count("allow") > 5


def test_linkers_are_judged_by_their_own_links(spark):
    links = {"bad.net": [], **{f"farm{i}.org": ["//bad.net/p"] if i % 2 else ["http://bad.net/p"] for i in range(100)}, "ring.org": ["http://farm3.org/"],
             "mixed.org": ["http://bad.net/", "http://a.org/", "http://b.org/"], "a.org": [], "good.com": ["//friend.org/x"], "friend.org": []}
    pages = spark.createDataFrame([(i, f"http://{h}/{'fr' if h == 'bad.net' else 'x'}/", "".join(f"<a href='{t}'>t</a>" for t in ts))
                                   for i, (h, ts) in enumerate(links.items())], "page_id long, url string, html string")
    got = {r["host"]: r["verdict"] for r in url_filter.filter_urls(pages).collect()}
    assert {h for h, v in got.items() if v == "block"} == {"bad.net", "ring.org", *(f"farm{i}.org" for i in range(100))}
    assert {(r["src"], r["dst"]) for r in url_filter.host_edges(pages).collect()} >= {("good.com", "friend.org"), ("farm1.org", "bad.net")}


# --- chat windows ----------------------------------------------------------------------------------


def brute_chat(rows):
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        taught = "".join(x for _, _, role, x in turns if role == "assistant")
        said = "".join(f"{role}\n{x}\n" for _, _, role, x in turns)
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(taught), hashlib.sha256(taught.encode()).hexdigest())
    return out


def chat_rows():
    rng = random.Random(2)
    marks = ["### assistant: ", "</turn>\n", "\\", "\\l", "\\h", "\\\\", "<", "#", ":", "word ", "\n", "é😀 ", ": ", "### "]
    rows = [(c, t, rng.choice(["user", "assistant", "tool:x", "#odd\\", None]) if t else rng.choice(["system", "user"]), "".join(rng.choice(marks) for _ in range(rng.randint(0, 25))))
            for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(500, t, "user" if t % 2 == 0 else "assistant", f"turn {t} " + "w " * (t % 40)) for t in range(400)]
    rows += [(501, 0, "system", "only this"), (None, 1, "assistant", "lost"), (None, 0, None, None), (502, 5, "assistant", "same"), (502, 5, "assistant", "same"), (502, None, "user", "first"),
             (503, 0, "system", "sys " * 30), (503, 1, "user", "long " * 3000), (503, 2, "assistant", "answer")]
    return rows


@pytest.mark.parametrize("budget,history", [(chat_format.BUDGET, chat_format.HISTORY), (120, 40), (60, 0), (10, 5)])
def test_chat_round_trip(spark, budget, history):
    rows = chat_rows()
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(1)).repartition(5)
    windows = chat_format.format_windows(turns, budget, history)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat_format.conversation_digests(windows).collect()}
    assert got == brute_chat(rows)
    longest = max(len((t or "").split()) for _, _, _, t in rows) + chat_format.MARK_TOKENS
    for w in windows.collect():
        assert w["tokens"] <= budget or w["n_turns"] - w["n_repeated"] == 1 or budget < longest and w["tokens"] <= budget + 2 * longest
        assert w["formatted"].count("</turn>\n") == w["n_turns"]
    if budget == 120:
        w = sorted((w for w in windows.collect() if w["conv_id"] == 500), key=lambda w: w["window"])
        assert len(w) > 20 and any(x["n_repeated"] for x in w[1:]) and w[0]["n_repeated"] == 0
        s = sorted((w for w in windows.collect() if w["conv_id"] == 503), key=lambda w: w["window"])
        assert all(x["formatted"].startswith("### system: sys") for x in s) and len(s) > 1
    assert chat_format.format_windows(turns.limit(0)).count() == 0
