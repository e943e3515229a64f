"""Each operator against a plain version of its definition, with the awkward inputs."""

import base64
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from compare import difference, duck
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from foliograph.llm import (
    ball_tree,
    byte_bpe,
    chat_tree,
    license_scan,
    lm_score,
    near_dup,
    packing,
    quality_classifier,
    quality_rules,
    substring_dedup,
    word_pairs,
)
from foliograph.llm.oracles import ORACLES
from foliograph.llm.queries import QUERIES

WORD = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, kept int, n string"


def words(text):
    return re.findall(WORD, text or "")


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, copies, near copies, shared passages, a repeated row, clashing columns."""
    rng = np.random.default_rng(7)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), rng.integers(1, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocabulary, n))

    base, passage = prose(120), prose(60)
    texts = [prose(int(n)) + "\n" + prose(12) for n in rng.integers(1, 200, 30)]
    texts += [base, base, base + " one", base.replace(" ", "  ", 3), base.upper(), "x " + base]
    texts += [prose(30) + "\n" + passage + " " + prose(20), passage, prose(5) + " " + passage]
    texts += ["", None, "   \n\t", "a", "a b c", "b " * 50, "Ü, " * 90, prose(3000), "w" * 3000]
    texts += ["Licensed under the MIT License.\n" + prose(40), "é  x　 y <|endoftext|> 'S 12 漢字 ÀB ªº\x1c z"]
    rows = [(i, t, "en", None if i % 11 == 0 else f"s{i % 3}", None if t is None else len(t), "q", 1, None) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, base, None, None, None, "q", None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert difference(df.columns, [tuple(r) for r in df.collect()], columns, want.fetchall()) is None


def test_quality_rules(docs, rows, empty):
    got = quality_rules.line_rules(docs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    want = collections.Counter()
    for key, text in rows:
        w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
        seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        again = {p for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
        failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
        marks = len(re.findall(r"[#*$%&|<>]", text or ""))
        want[key, len(w), sum(map(len, w)), marks, len(lines) - len(set(lines)), len(again), failed, 0, not failed] += 1
    assert collections.Counter(map(tuple, got.collect())) == want
    assert quality_rules.line_rules(empty).count() == 0


def test_frequent_lines_deplete(spark):
    body = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(40)]
    texts = [f"Site  menu home about\n{b}" for b in body] + [f"site menu HOME about\n{'k ' * 2}" + " ".join(f"z{i}" for i in range(20)) for i in range(2)]
    texts += ["site menu home about\n" * 9 + "tail of this text " + " ".join("qrstuv")] + [body[0]] * 30
    docs = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality_rules.line_rules(docs, max_docs=5).collect()}
    assert got[0]["n_removed_words"] == 4 and got[0]["kept"]
    assert got[42]["n_removed_words"] == 36 and not got[42]["kept"]
    assert got[50]["n_removed_words"] == 0 and got[50]["kept"]  # copies count once
    left = {r["doc_id"]: r["text"] for r in quality_rules.kept_documents(docs, max_docs=5).collect()}
    assert left[0] == body[0] and 42 not in left


def test_chat_tree(spark):
    own = "</s>[INST] ok [/INST] \\[<|end|>\\"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", own), (2, 0, "user", "hi"), (2, 1, "assistant", own), (2, 2, "user", None)]
    rows += [(3, 0, "user", "hi"), (3, 1, "assistant", "other"), (4, 0, None, ""), (None, 0, "assistant", "x"), (5, 1, "user", "b"), (5, 1, "user", "b"), (5, 0, "<|text|>", "a")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("path", F.lit(1))
    nodes, lists = chat_tree.prefix_trees(conv)
    nodes = nodes.cache()
    got = {r["conv_id"]: r for r in chat_tree.read_back(nodes, lists).collect()}
    for key in {r[0] for r in rows}:
        turns = sorted([(t, r or "", x or "") for k, t, r, x in rows if k == key])
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        learned = "".join(x for _, r, x in turns if r == "assistant")
        assert got[key]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (got[key]["n_turns"], got[key]["loss_chars"]) == (len(turns), len(learned))
        assert got[key]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    emitted = nodes.collect()
    assert len(emitted) == 9  # shared first turns once
    for tree in {r["tree"] for r in emitted}:
        own_nodes = sorted([r for r in emitted if r["tree"] == tree], key=lambda r: r["start"])
        at = 0
        for r in own_nodes:
            assert r["start"] == at and r["end"] - r["start"] == len(r["segment"])
            assert r["position"] == sum(x["end"] - x["start"] for x in r["attends"])
            assert all(x["end"] <= r["start"] for x in r["attends"])
            at = r["end"]
    assert chat_tree.read_back(*chat_tree.prefix_trees(conv.limit(0))).count() == 0


def shingled(text, size):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def grouped(rows, size):
    known = [(k, shingled(t, size)) for k, t in rows]
    up = {k: k for k, _ in known if k is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, s) in enumerate(known):
        for b, t in known[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
                p, q = root(a), root(b)
                up[max(p, q)] = min(p, q)
    return known, root


@pytest.mark.parametrize("bound,block", [(near_dup.BROADCAST_IDS, near_dup.BLOCK_ROWS), (0, 2)])
def test_near_duplicates(docs, rows, empty, monkeypatch, bound, block):
    monkeypatch.setattr(near_dup, "BROADCAST_IDS", bound)
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", block)
    known, root = grouped(rows, 4)
    want = collections.Counter((k, len(s), root(k), root(k) == k) for k, s in known if k is not None)
    got = [tuple(r) for r in near_dup.near_duplicates(docs, shingle=4).collect()]
    assert collections.Counter(r for r in got if r[0] is not None) == want
    assert [r[2] for r in got if r[0] is None] == [30]  # its text is that of document 30
    if bound:
        kept = near_dup.one_per_group(docs, shingle=4).select("doc_id").collect()
        assert sorted(r[0] for r in kept if r[0] is not None) == sorted({k for k, *_, own in want if own})
        assert near_dup.near_duplicates(empty).count() == 0


def test_hamming_join_keeps_every_near_pair():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 16, (300, near_dup.CHUNKS * near_dup.PER_CHUNK)).astype(np.uint16)
    b = a.copy()
    for row in b:  # the largest distance that is guaranteed
        row[rng.choice(len(row), 2 * near_dup.CHUNKS - 1, replace=False)] ^= 1
    x, y = near_dup.index_keys(a), near_dup.index_keys(b)
    assert (x == y).any(axis=1).all()
    assert not np.isin(x, near_dup.index_keys(rng.integers(0, 1 << 16, a.shape).astype(np.uint16))).any()


@pytest.mark.parametrize("wide", [substring_dedup.WIDE, 1])
def test_substring_dedup(docs, rows, empty, wide):
    size = 35
    seen = collections.Counter(tuple(w[i : i + size]) for w in (words(t) for _, t in rows) for i in range(len(w) - size + 1))
    want = collections.Counter()
    for key, text in rows:
        w = words(text)
        gone = {p for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for p in range(i, i + size)}
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        want[key, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()] += 1
    got = substring_dedup.without_repeats(docs, size, wide=wide).collect()
    assert collections.Counter(map(tuple, got)) == want
    assert substring_dedup.without_repeats(empty, size).count() == 0


def test_substring_dedup_keeps_texts_of_one_id_apart(spark):
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for i in range(5000):  # about a dozen pairs agree in 20 bits of any hash
        before = [f"{i}-{j}" for j in range(i % 7)]
        texts.append(" ".join(before + (passage if i % 3 else [f"{i}+{j}" for j in range(40)])))
    for key in (None, 1, -(2**63)):
        got = substring_dedup.without_repeats(spark.createDataFrame([(key, t) for t in texts], "doc_id long, text string")).collect()
        want = collections.Counter()
        for i, t in enumerate(texts):
            left = " ".join(words(t)[: i % 7]) if i % 3 else t
            want[key, len(words(t)), 40 if i % 3 else 0, hashlib.sha256(left.encode()).hexdigest()] += 1
        assert collections.Counter(map(tuple, got)) == want


def test_packing(docs, rows, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = packing.pack(docs, path, window=256, packet=64, part_windows=4).toPandas()
    ids = {k: library.encode(t or "", add_special_tokens=False).ids + [1] for k, t in rows}
    times = collections.Counter(k for k, _ in rows)
    for r in got.itertuples():
        key = None if math.isnan(r.doc_id) else int(r.doc_id)
        own = ids[key][r.start : r.start + r.length]
        assert (r.doc_tokens, r.ids_crc32) == (len(ids[key]), zlib.crc32(np.array(own, "<u4").tobytes()))
    assert got.length.sum() == sum(len(ids[k]) * n for k, n in times.items())
    fill = []
    for _, g in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]]
        fill.append(g.length.sum())
    assert max(fill) == 256 and sum(n < 256 for n in fill) <= 1
    assert packing.pack(empty, path).count() == 0


def test_mixture_is_held(spark):
    text = "one two three four five " * 40
    docs = spark.createDataFrame([(i, text, "a" if i % 4 else "b") for i in range(200)], "doc_id long, text string, source string")
    got = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), window=512, packet=128, part_windows=8).toPandas()
    got["b"] = got.doc_id % 4 == 0
    share = (got.length * got.b).groupby(got.sequence_id).sum().cumsum() / got.length.groupby(got.sequence_id).sum().cumsum()
    assert (share.iloc[4:] - 0.25).abs().max() < 0.06


def test_top_inner_products(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, [int(x) for x in rng.integers(-3, 4, 6)]) for i in range(700)]
    df = spark.createDataFrame([*vectors, (900, None), (901, [1, None, 1, 1, 1, 1]), (902, [1, 2]), (None, [1] * 6)], "vec_id long, v array<bigint>")
    got = collections.defaultdict(list)
    asked = df.filter("vec_id % 50 = 0")
    for r in ball_tree.top_inner_products(df.repartition(4), asked, 5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    for key, v in vectors:
        if key % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, u)), i) for i, u in vectors if i != key)[:5]
            assert got[key] == [(i, -s) for s, i in scores]
    assert ball_tree.top_inner_products(df.limit(0), asked, 5).count() == 0
    assert ball_tree.top_inner_products(df, asked.limit(0), 5).count() == 0
    odd = spark.createDataFrame([(1, [0.5, None]), (2, [float("nan"), 1.0]), (3, None), (4, [-0.001, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in ball_tree.scaled(odd, 256).collect()] == [(4, [-1, 256])]


def test_byte_bpe(docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = collections.Counter()
    for key, text in rows:
        ids = library.encode_ordinary(text or "")
        want[key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    got = byte_bpe.encode_decode(docs, path, public_tokenizers.PATTERN).collect()
    assert collections.Counter(map(tuple, got)) == want
    assert byte_bpe.encoded(docs, path, public_tokenizers.PATTERN).count() == len(rows)
    assert byte_bpe.encode_decode(empty, path, public_tokenizers.PATTERN).count() == 0


def test_license_scan(spark, docs, rows, empty):
    got = license_scan.scan(docs).collect()
    assert len(got) == len(rows)
    assert [r["license"] for r in got if r["license"]] == ["mit"]
    text = "Licensed under the Apache License, Version 2.0!  You may not use this file, except in compliance with the License.\nAll rights reserved."
    one = license_scan.scan(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert one[0]["sentence_ids"] == "apache-header,apache-limit,reserved"
    assert one[0]["license"] == "apache-2.0" and one[0]["licenses"].endswith("all-rights-reserved")
    assert (one[1]["n_sentences"], one[1]["license"]) == (0, None)
    assert license_scan.scan(empty).count() == 0


def licensed(spark, texts):
    got = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id")
    return [(r["sentence_ids"], r["license"]) for r in got.collect()]


def test_license_openings(spark):
    said = {
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
        "Released under the MIT License.": "mit",
        "Distributed under the terms of the Mozilla Public License 2.0.": "mpl-2.0",
        "This software is distributed under the Boost Software License, Version 1.0.": "bsl-1.0",
        "This project is licensed under a Creative Commons Attribution 4.0 International License.": "cc-by-4.0",
        "This is free and unencumbered software released into the public domain.": "unlicense",
        "We met under the old license.": None,
    }
    assert [x for _, x in licensed(spark, said)] == list(said.values())


def test_license_wrapped(spark):
    apache = """#
# Copyright 2020 Somebody
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance
# with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
"""
    bsd = """Copyright (c) 2020, Somebody
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
"""
    gpl = "Some prose\n * Licensed under the\r\n * GNU General Public License\n * version 3.\n * More of it"
    apart = "Licensed under the\n\nMIT License. Licensed under the!\nMIT License"
    title = "Released under\nthe\nMIT\nLicense\nAll rights\nreserved"
    assert licensed(spark, [apache, bsd, gpl, apart, title]) == [
        ("apache-header,apache-limit,apache-copy", "apache-2.0"),
        ("reserved,bsd-grant", "bsd"),
        ("gpl3-header", "gpl-3.0"),
        ("mit-title,mit-title", "mit"),
        ("mit-header,reserved", "mit"),
    ]


BSD = """Copyright (c) 2020, Somebody
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
DISCLAIMER = "\nTHIS SOFTWARE IS PROVIDED \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.\n"
MIT = """Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""


def gnu(kind, version):
    return f"""This program is free software; you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation; either version {version} of the License, or
(at your option) any later version.
"""


def test_license_files(spark):
    """Files and notices of the usual licences, plain and as comments."""
    said = {
        BSD + DISCLAIMER: "bsd-2-clause",
        BSD + ENDORSE + DISCLAIMER: "bsd-3-clause",
        "BSD 2-Clause License\n\n" + BSD: "bsd-2-clause",
        "MIT License\n\n" + MIT + DISCLAIMER: "mit",
        MIT: "mit",
        "ISC License\n\nCopyright 2020\n\n" + ISC: "isc",
        ISC: "isc",
        "        Apache License\n  Version 2.0, January 2004\n  http://www.apache.org/licenses/\n": "apache-2.0",
        "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\n Copyright (C) 2007": "gpl-3.0",
        "GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991\n\n Copyright (C) 1989": "gpl-2.0",
        "GNU LESSER GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n": "lgpl-3.0",
        "GNU LESSER GENERAL PUBLIC LICENSE\n   Version 2.1, February 1999\n": "lgpl-2.1",
        "GNU AFFERO GENERAL PUBLIC LICENSE\n   Version 3, 19 November 2007\n": "agpl-3.0",
        "Mozilla Public License Version 2.0\n==================================\n": "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.": "mpl-2.0",
        gnu("", "2"): "gpl-2.0",
        gnu("", "3"): "gpl-3.0",
        gnu("Lesser ", "2.1"): "lgpl-2.1",
        gnu("Affero ", "3"): "agpl-3.0",
        "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
        "SPDX-License-Identifier: GPL-2.0-or-later */": "gpl-2.0",
        "SPDX-License-Identifier: Apache-2.0 OR MIT": "apache-2.0,mit",
        "spdx-license-identifier: (MIT AND BSD-3-Clause)": "mit,bsd-3-clause",
        "SPDX-License-Identifier: ISC OR MIT OR Zlib": "mit,isc,zlib",
        "The terms of the GNU project and of the Apache tribe.": "",
    }
    for mark in ("", "# ", " * ", "// "):
        texts = ["".join(mark + line + "\n" for line in t.splitlines()) for t in said]
        got = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id")
        named = [",".join(x for x in r["licenses"].split(",") if x != "all-rights-reserved") for r in got.collect()]
        assert named == list(said.values()), mark


def test_license_padded(spark):
    padded = "=" * 9000 + " Licensed under " + " *" * 4000 + " the MIT License " + "\t" * 9000 + "#"
    assert licensed(spark, [padded, padded + ".\nx"]) == [("mit-header", "mit")] * 2


@pytest.mark.parametrize("head", [lm_score.HEAD, 50])
def test_lm_score(docs, rows, empty, head):
    tokens = [(k, [*words((t or "").translate(LOWER)), None]) for k, t in rows]
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    counts = collections.Counter(x for k, w in tokens if not held(k) for x in w)
    total, kinds = sum(counts.values()), len(counts)
    want = sorted(
        (-1 if k is None else k, held(k), len(w), sum(counts[x] > 0 for x in w), total, round(sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w), 6))
        for k, w in tokens
    )
    got = lm_score.scored(docs, head=head).collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:5], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    if head > 50:
        assert lm_score.scored(empty).count() == 0


def test_lm_learns(spark):
    """Over unseen texts half a decimal digit a token better than counts of words alone."""
    rows = QUERIES["op9_lm_score"](spark, "/root/testdata/sf0.1").filter("held_out")
    got = rows.agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert got[0] - got[1] > 0.5 * got[2]


def test_lm_score_without_training_texts(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    docs = spark.createDataFrame([(i, t) for i, t in zip(ids, ["a b a", None, ""])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm_score.scored(docs).collect()}
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for _, r in sorted(got.items())] == [
        (4, 0, 0, 0.0), (1, 0, 0, 0.0), (1, 0, 0, 0.0)
    ]
    assert all(r["held_out"] and r["score"] < 0 for r in got.values())


@pytest.mark.parametrize("followed", [2, 64])
@pytest.mark.parametrize("shard_tokens", [40, 1 << 21])
def test_lm_score_plain(docs, rows, monkeypatch, followed, shard_tokens):
    """Every token's probability from dictionaries: its class by all features, and its pair inside the class."""
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", shard_tokens)
    monkeypatch.setattr(lm_score, "FOLLOWED", followed)
    monkeypatch.setattr(lm_score, "CLUSTERED", 100)
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    train = docs.filter((F.crc32(F.col("doc_id").cast("string")) % 7 != 2) | F.col("doc_id").isNull())
    train = train.select(F.coalesce("text", F.lit("")).alias("text"))
    model = lm_score.trained(train, lm_score.word_counts(train))
    split = []
    for k, t in rows:
        raw = (t or "").encode()
        own, at = lm_score.tokens(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        split.append((k, own, lm_score.contexts(own, at)))
    row_of = {w: i for i, w in enumerate(model.words.tolist())}
    clustered = model.classes > 1
    seen, total = collections.Counter(), collections.Counter()
    for k, own, before in split:
        for w, last in zip(own.tolist(), before[0].tolist()) if not held(k) else ():
            i = row_of[w]
            # leading last words know pairs of clustered words only
            if model.classes[i] != 1 and (clustered[i] or last not in model.leaders):
                seen[last, w] += 1
                total[last, model.classes[i]] += 1
    base = (model.counts + 1) / model.mass[model.classes]
    weight, z = dict.fromkeys(seen, 0.0), collections.defaultdict(lambda: 1.0)
    for _ in range(word_pairs.UPDATES):
        more = collections.Counter()
        for (last, w), n in seen.items():
            i = row_of[w]
            group = last, model.classes[i]
            expected = total[group] * base[i] * math.exp(weight[last, w]) / z[group]
            weight[last, w] = max(0.0, weight[last, w] + math.log((n - word_pairs.PENALTY) / expected))
            more[group] += base[i] * math.expm1(weight[last, w])
        for group, m in more.items():
            z[group] = 1 + m
    want = []
    for k, own, before in split:
        buckets, score = lm_score.feature_buckets(before), 0.0
        for j, w in enumerate(own.tolist()):
            i = row_of.get(w)
            c = 0 if i is None else model.classes[i]
            logits = model.prior + sum(model.weights[b[j]].astype(float) for b in buckets)
            score += logits[c] - math.log(np.exp(logits).sum())
            score += math.log(1 / model.mass[0] if i is None else base[i])
            if i is not None and c != 1:
                last = int(before[0][j])
                score += weight.get((last, w), 0.0) - math.log(z[last, c])
        want.append((-1 if k is None else k, score / math.log(10)))
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["score"]) for r in lm_score.scored(docs).collect())
    assert [k for k, _ in got] == [k for k, _ in sorted(want)]
    np.testing.assert_allclose([s for _, s in got], [s for _, s in sorted(want)], rtol=1e-4)


def test_lm_pairs_sum_to_one():
    rng = np.random.default_rng(3)
    first = np.repeat([0, 40, 70], [40, 30, 30])
    mass = rng.integers(1, 90, 100).astype(float)
    base = mass / np.bincount(first, mass)[first] * np.where(first == 0, 0.8, 1)  # a fifth of one class for unseen words
    classes = word_pairs.Classes(base, first)
    last, place = np.divmod(np.unique(rng.integers(0, 20 * 100, 700)), 100)
    keys = word_pairs.pair_keys(last.astype(np.uint64), place)
    order = np.argsort(keys)
    pairs = word_pairs.fitted(keys[order], rng.integers(1, 9, len(keys)), classes)
    for word in range(21):
        every = word_pairs.pair_keys(np.full(100, word, np.uint64), np.arange(100))
        ratio = pairs.log_ratio(every, classes)
        for c in (0, 40, 70):
            own = first == c
            at = np.searchsorted(pairs.groups, every[c])
            z = pairs.log_z[at] if at < len(pairs.groups) and pairs.groups[at] == every[c] else 0.0
            rest = (1 - base[own].sum()) * math.exp(-z)
            assert (base[own] * np.exp(ratio[own])).sum() + rest == pytest.approx(1, abs=1e-5)
    np.testing.assert_array_equal(word_pairs.unpacked(word_pairs.packed(np.sort(keys))), np.sort(keys))


def test_lm_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(lm_score.BUCKETS, lm_score.CLASSES)).astype(np.float32)
    n = 500
    counts, classes = rng.integers(1, 90, n), rng.integers(0, lm_score.CLASSES, n)
    mass = np.bincount(classes, counts + 1, minlength=lm_score.CLASSES)
    mass[0] += 1
    model = lm_score.Model(np.arange(n, dtype=np.uint64), counts, classes, mass, np.zeros(lm_score.CLASSES, np.float32), weights, int(counts.sum()), n)
    log_class = model.log_classes(rng.integers(0, lm_score.BUCKETS, (4, 3)))
    inside = np.append((counts + 1) / mass[classes], 1 / mass[0])
    owner = np.append(classes, 0)
    used = np.unique(owner)
    whole = (np.exp(log_class)[:, owner] * inside).sum(axis=1)
    np.testing.assert_allclose(whole, np.exp(log_class)[:, used].sum(axis=1), rtol=1e-5)


def test_quality_classifier_plain(spark):
    """The same scores from whole matrices: densities by solving and determinants, no factors, no sums over tasks."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r["id"], np.array(r["statistics"])) for r in quality_classifier.statistics_of(docs).collect()]
    label = {r["doc_id"]: r["quality"] for r in labels.collect()}
    fit = [(label[k], x) for k, x in rows if zlib.crc32(str(k).encode()) % 5 and label.get(k) in (0, 1)]
    every = np.array([x for _, x in fit])
    shift, scale = every.mean(axis=0), np.sqrt(np.maximum(every.var(axis=0), 1e-6))
    groups = [(np.array([x for y, x in fit if y == k]) - shift) / scale for k in (0, 1)]
    own = [np.cov(g.T, bias=True) for g in groups]
    pooled = sum(len(g) * c for g, c in zip(groups, own)) / len(fit)
    densities = []
    for g, c in zip(groups, own):
        c = 0.9 * c + 0.1 * pooled
        c = 0.9 * c + 0.1 * np.diag(np.diag(c)) + 1e-3 * np.eye(len(c))
        away = np.clip((np.array([x for _, x in rows]) - shift) / scale, -12, 12) - g.mean(axis=0)
        densities.append(-0.5 * (away * np.linalg.solve(c, away.T).T).sum(axis=1) - 0.5 * np.linalg.slogdet(c)[1])
    odds = math.log((len(groups[1]) + 1) / (len(groups[0]) + 1))
    want = 1 / (1 + np.exp(-np.clip(0.5 * (densities[1] - densities[0]) + odds, -60, 60)))
    got = {r["doc_id"]: r for r in quality_classifier.classified(docs, labels).collect()}
    assert len(got) == len(rows)
    np.testing.assert_allclose([got[k]["score"] for k, _ in rows], want, rtol=1e-6, atol=1e-9)
    assert all(got[k]["predicted"] == (got[k]["score"] >= 0.3) for k, _ in rows)


def test_quality_classifier(spark, docs, rows, empty):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    whole = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = quality_classifier.classified(whole, labels).join(labels, "doc_id").filter("held_out")
    hit = {(r["quality"], r["predicted"]): r["n"] for r in got.groupBy("quality", "predicted").agg(F.count("*").alias("n")).collect()}
    assert hit.get((0, 0), 0) >= 0.95 * (hit.get((0, 0), 0) + hit.get((0, 1), 0))
    assert hit.get((1, 1), 0) >= 0.95 * (hit.get((1, 0), 0) + hit.get((1, 1), 0))
    some = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    scores = quality_classifier.classified(docs, some).collect()
    assert len(scores) == len(rows) and all(0 <= r["score"] <= 1 for r in scores)
    assert {r["score"] for r in quality_classifier.classified(docs, some.limit(0)).collect()} == {0.5}
    assert quality_classifier.classified(empty, some).count() == 0


def test_pipeline_stages(spark, docs, sf, tmp_path):
    held = docs.unionByName(spark.read.parquet(f"{sf}/documents.parquet"), allowMissingColumns=True)
    columns = held.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, held, sf).write.parquet(str(tmp_path / name))
        before, held = held, spark.read.parquet(str(tmp_path / name))
        assert held.count() > 0
        if name != "packing":
            assert held.columns == columns
    kept = before.select("doc_id", "text").collect()
    assert held.select("doc_id").distinct().count() == len({r["doc_id"] for r in kept})
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], docs.schema), sf).count() == 0


ODD_NAMES = "doc_id long, text string, _id int, `a b` int, row int, c0 string, id string, n int, kept boolean, `x.y` int"


def odd_documents(spark, texts):
    rows = [(i, t, i, 1, 2, "c", "d", 3, None, 4) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ODD_NAMES)


def test_stages_with_odd_column_names(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(30))
    docs = odd_documents(spark, [passage, passage, f"{other} {passage}", other + " end", None, ""])
    one = near_dup.one_per_group(docs)
    assert one.dtypes == docs.dtypes and sorted(r["_id"] for r in one.collect()) == [0, 2, 3, 4, 5]
    twice = near_dup.one_per_group(docs.unionByName(docs))
    assert sorted(r["_id"] for r in twice.collect()) == [0, 2, 3, 4, 5]
    cut = substring_dedup.cut_documents(docs)
    assert cut.dtypes == docs.dtypes
    assert {r["_id"]: r["text"] for r in cut.collect()} == {0: "", 1: "", 2: other, 3: other + " end", 4: None, 5: ""}


def test_repeated_rows_cost_no_more_than_their_number(spark):
    """Ten thousand copies of one row: each gets its stretches once."""
    text = " ".join(f"w{i}" for i in range(200))
    docs = spark.range(10_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit(text).alias("text")).repartition(4)
    runs = substring_dedup.repeated_windows(substring_dedup._keyed(docs, "doc_id", "text"), 35)
    held = runs.collect()
    assert len(held) == 1 and len(held[0]["runs"]) <= 40
    got = substring_dedup.without_repeats(docs, 35).groupBy("n_words", "n_removed").count().collect()
    assert [tuple(r) for r in got] == [(200, 200, 10_000)]


@pytest.mark.parametrize("few", [1_000_000, 0])
def test_components(spark, few):
    from foliograph.llm.components import components

    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))]
    links += [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2000 + i) for i in range(50)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    want = {x: find(x) for a, b in links if a != b for x in (a, b)}
    df = spark.createDataFrame(links, "c long, lead long").repartition(3)
    assert {r["node"]: r["component"] for r in components(df, "c", "lead", few).collect()} == want
    assert components(df.limit(0), "c", "lead", few).isEmpty()
