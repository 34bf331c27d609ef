"""Encoding, licences, toxicity and quality: exact round trips, brute force, held-out accuracy."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from statmart.llm import bpe, licences, quality, toxicity

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCABULARY)
    t.no_truncation()
    t.no_padding()
    return t


def test_encoder_equals_library(library):
    rng = random.Random(4)
    enc = bpe.encoder(VOCABULARY)
    pools = ["abcdefghijklmnop ", "the and ing er ß é É İ Σ Σς", "!?.'s 're <|endoftext|>\x1c\x85 ́ 123", "aeiou", "日本語 ひらがな"]
    for _ in range(400):
        pool = rng.choice(pools)
        text = "".join(rng.choice(pool) for _ in range(rng.choice([0, 3, 40, 300])))
        want = library.encode(text, add_special_tokens=False).ids
        ids, decoded = enc.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded.decode() == library.decode(want, skip_special_tokens=False) == enc.decode(want)


@pytest.mark.parametrize("leaf", [1, 2, 7])
def test_tree_equals_whole(monkeypatch, leaf, library):
    monkeypatch.setattr(bpe, "LEAF", leaf)
    enc, rng = bpe.encoder(VOCABULARY), random.Random(leaf)
    for _ in range(150):
        text = "".join(rng.choice("theinaorst"[: 2 + rng.randrange(8)]) for _ in range(rng.randrange(1, 300)))
        assert enc.tree(enc.symbols(text)) == library.encode(text, add_special_tokens=False).ids


def test_pieces_nulls_and_clashing_names(spark, library, monkeypatch):
    long = "thein" * 40 + " and " + "x" * 150 + "! " + "é" * 90
    rows = [(1, "One two", 7), (2, None, 7), (3, "", 7), (4, long, 7), (4, long, 7), (None, " \n ", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = bpe.encoded(df, VOCABULARY, run=50, ids="ids").collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "text", "n_tokens", "ids_sha256", "decoded_sha256", "ids"}
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()
    texts = bpe.decoded(bpe.encoded(df, VOCABULARY, ids="ids"), VOCABULARY, "ids").select("text", "decoded").collect()
    assert all(r.decoded == library.decode(library.encode(r.text or "", add_special_tokens=False).ids, skip_special_tokens=False) for r in texts)
    assert bpe.encoded(df.limit(0), VOCABULARY).count() == 0


def test_licences(spark):
    full = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. More."
    )
    rows = [
        (1, full, ["MIT"]),
        (2, "Text.\nLicensed under the Apache License, Version 2.0.\nAll rights reserved.", ["Apache-2.0", "All-rights-reserved"]),
        (3, "Released under the MIT License. Released under the MIT License.", ["MIT"]),
        (4, "We like the MIT License.", []), (5, None, []), (6, "", []),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, want array<string>")
    for r in licences.scanned(df).collect():
        assert r.licences == r.want, r.doc_id
    assert licences.scanned(df.limit(0)).count() == 0


def test_licence_sentences_of_any_width(spark):
    """A known sentence counts however much stands between its words."""
    words = licences.SENTENCES["as-is"].split()
    rows = [
        (1, "released" + " " * 5000 + "under the mit license", ["mit-released"]),
        (2, "/* " + (" " + "*" * 40 + " ").join(words) + " */", ["as-is"]),
        (3, "-" * 3000 + " All rights reserved " + "=" * 3000, ["reserved"]),
        (4, "x" * 3000 + " all rights reserved", []), (5, "all rights", []),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, want array<string>")
    for r in licences.scanned(df).collect():
        assert r.sentence_ids == r.want, r.doc_id


def test_marginals_by_enumeration():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5):
        odds, moves = np.exp(rng.normal(size=n)), np.exp(rng.normal(size=(2, 2)))
        total, ones, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=n):
            w = np.prod([odds[i] if s else 1 for i, s in enumerate(path)]) * np.prod([moves[a, b] for a, b in zip(path, path[1:])])
            total, ones = total + w, ones + w * np.array(path)
            for a, b in zip(path, path[1:]):
                pairs[a, b] += w
        lengths = np.array([n])
        fwd, back = toxicity.forward_backward(odds, lengths, moves)
        post = fwd * back
        assert np.allclose(post / (1 + post), ones / total)
        assert np.allclose(toxicity.pair_marginals(fwd, back, odds, moves, np.arange(n - 1)), pairs / total)


def test_toxic_spans_and_edges(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(240):
        text = [rng.choice(words) for _ in range(40)]
        if i % 5 == 0:
            text[rng.randrange(40)], text[rng.randrange(40)] = "moron,", "scum"
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    df, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learned(df, lab)
    extra = spark.createDataFrame([(900, None, 1), (901, "", 1), (902, "you moron", 1), (902, "you moron", 1), (None, "a " * 5000, 1)], "doc_id long, text string, score int")
    got = {r.doc_id: r for r in toxicity.scored(extra, model).collect()}
    assert toxicity.scored(extra, model).count() == 5 and got[902].predicted == 1
    assert [(s.start, s.end) for s in got[902].spans] == [(4, 9)]
    assert all(0 <= got[i].score < 0.7 and not got[i].spans for i in (900, 901, None))
    held = [r for r in toxicity.scored(df, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(r.predicted == (r.doc_id % 5 == 0) for r in held)
    nothing = toxicity.learned(df.limit(0), lab.limit(0))
    assert toxicity.scored(df, nothing).filter("predicted = 1").count() == 0


def test_quality_held_out(spark):
    rows = entry.queries()["op3_quality"](spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(rows) == 1000 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in rows)


def test_quality_vote_by_brute_force(spark):
    texts = ["plain words here and there. " * 3, "LOUD!! WORDS!! HERE!! " * 3, "a | b | c | d | e " * 3, "some other plain text. " * 4] * 4
    y = np.array([1, 0, 0, 1] * 4)
    m = quality.fit(texts, y)
    x = np.stack([quality.terms(t) for t in texts])
    got = m.vote(x)
    for i, v in enumerate(m.project(x)):
        sim = m.vectors @ v
        w = np.exp((sim - sim.max()) * 30) * np.maximum(sim, 1e-6)
        assert abs(got[i] - (w * y).sum() / w.sum()) < 1e-3 and (got[i] >= 0.7) == y[i]
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, texts[0], "x"), (3, texts[0], "x")], "doc_id long, text string, predicted string")
    rows = quality.scored(df, m).collect()
    assert len(rows) == 4 and all((r.score == 0.0) == (not r.text) for r in rows)
    assert quality.scored(df.limit(0), m).count() == 0
