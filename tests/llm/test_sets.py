"""Shards, chats, near copies, repeated strings, nearest codes, benchmark overlaps: against brute force."""

import itertools
import random


import pytest
from pyspark.sql import functions as F

from statmart.llm import chat, decontaminate, near_dup, nearest, shards, suffix_dedup


def test_shards(spark):
    rows = [(i, "same text " * 20) for i in range(2000)] + [(i, "t" * (i % 90)) for i in range(2000)] + [(None, None)] * 3 + [(7, "x")] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("old"))
    got = shards.sharded(df, 6, part_bytes=2000).toPandas()
    assert len(got) == len(rows)
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 6 and sums.max() - sums.min() < 0.02 * sums.mean()
    assert all(sorted(s) == list(range(len(s))) for _, s in got.groupby("shard")["slot"])
    keys = got.sort_values(["shard", "slot"])
    keys = list(zip(keys["text_crc32"], keys["doc_id"].fillna(0)))
    assert keys == sorted(keys)
    assert shards.sharded(df.limit(0), 6).count() == 0
    assert shards.sharded(df.limit(1), 6).count() == 1


def test_chat_round_trip(spark):
    texts = ["plain", r"\### Assistant: </turn> ok", "####", "\\", "</turn>\n### user: x", "", None, "a: b </turn> \n", "#" * 7 + "\\#"]
    rows = [(c, t, r, x) for c, x in enumerate(texts) for t, r in enumerate(["user", "assistant"])]
    rows += [(50, 0, "a: ### b", "x"), (51, 0, None, None), (None, 0, "user", "q"), (None, 0, "user", "q"), (52, 0, "system", "s")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(df)).withColumn("learned", chat.learned_text(F.col("segments"))).collect()}
    for c, x in enumerate(texts):
        assert [tuple(t) for t in got[c].turns] == [("user", x or ""), ("assistant", x or "")]
        assert got[c].learned == (x or "") and got[c].valid
    assert [tuple(t) for t in got[50].turns] == [("a: ### b", "x")] and not got[50].valid
    assert [tuple(t) for t in got[51].turns] == [("", "")] and not got[52].valid
    assert len(got[None].turns) == 2 and not got[None].valid
    assert chat.formatted(df.limit(0)).count() == 0


def _linked(x: set, y: set) -> bool:
    return bool(x) and bool(y) and 100 * len(x & y) >= 85 * len(x | y)


def test_near_duplicates(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    docs: list[tuple] = []
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(40, 160))]
        for _ in range(60 if g == 0 else rng.randrange(1, 8)):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append((len(docs), " ".join(copy)))
    line = " ".join(rng.choice(vocabulary) for _ in range(20))
    docs += [(len(docs) + i, line + " " + " ".join(rng.choice(vocabulary) for _ in range(30))) for i in range(80)]
    n = len(docs)
    docs += [(n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, "One two"), (n + 4, "one TWO"), (n + 5, "é É"), (n + 5, "é É"), (None, line)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("kept", F.lit("old"))
    got = near_dup.near_duplicates(df).collect()
    assert len(got) == len(docs)
    sets, lower = {}, str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, t in docs:
        w = (t or "").translate(lower).split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(root, 2):
        if _linked(sets[a], sets[b]):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_crowded_nodes_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "DEPTH", 0)
    monkeypatch.setattr(near_dup, "LEAF", 4)
    monkeypatch.setattr(near_dup, "ROWS", 16)
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    docs = []
    for i in range(60):
        copy = list(base)
        copy[i], copy[7 * i % 120] = f"x{i % 3}", f"z{i}"
        docs.append((i, " ".join(copy)))
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (t.split() for _, t in docs)]
    label, changed = list(range(60)), True
    while changed:
        changed = False
        for a, b in itertools.combinations(range(60), 2):
            if _linked(sets[a], sets[b]) and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(df).collect()}
    assert [got[i] for i in range(60)] == label


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    got = {r.k: r.label for r in near_dup.components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def _brute(docs: list[tuple], span: int) -> dict:
    seen, out = set(), {}
    for i, raw in sorted(docs, key=lambda d: d[0]):
        gone = [False] * len(raw)
        for s in range(len(raw) - span + 1):
            if raw[s : s + span] in seen:
                gone[s : s + span] = [True] * span
            seen.add(raw[s : s + span])
        out[i] = bytes(b for b, g in zip(raw, gone) if not g), sum(1 for g, h in zip(gone, [False, *gone]) if g and not h)
    return out


@pytest.mark.parametrize("span", [40, 100])
def test_repeats(spark, span, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 3)
    rng = random.Random(span)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7))) for _ in range(40)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randrange(10, 60))) for _ in range(5)]
    docs = []
    for i in range(60):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(3)]
        docs.append((i * 3, (" " + rng.choice(passages) + " ").join(parts)))
    docs += [(200, "ab" * 300), (201, "x" * 1500), (202, "ab" * 60), (203, docs[5][1]), (204, ""), (205, "ü" * 90)]
    df = spark.createDataFrame([*docs, (206, None), (203, docs[5][1])], "doc_id long, text string").withColumn("spans", F.lit(1))
    got = suffix_dedup.repeats_removed(df, span=span).collect()
    assert len(got) == len(docs) + 2
    want = _brute([*((i, t.encode()) for i, t in docs), (206, b"")], span)
    for r in got:
        kept, spans = want[r.doc_id]
        assert bytes(r.kept) == kept and len(r.spans) == spans and r.n_bytes - r.n_removed == len(kept), r.doc_id
    for r in suffix_dedup.repeats_removed(df, span=span, whole_characters=True).collect():
        bytes(r.kept).decode()
    assert suffix_dedup.repeats_removed(df.limit(0)).count() == 0


@pytest.mark.parametrize("segments", [4, 8])
def test_nearest(spark, segments):
    rng = random.Random(3)
    codes = [rng.getrandbits(64) for _ in range(60)]
    rows = [(i, codes[i % 60] ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4)) if i >= 60) & (2**64 - 1)) for i in range(220)]
    rows += [(300 + i, codes[0]) for i in range(40)]
    signed = [(i, c - (1 << 64) if c >> 63 else c) for i, c in rows]
    df = spark.createDataFrame([*signed, signed[3], (None, 5), (999, None)], "id long, code long").withColumn("rank", F.lit(1))
    got = nearest.nearest(df, df.filter("id % 50 = 0"), 5, segments=segments).collect()
    for q, c in [r for r in rows if r[0] % 50 == 0]:
        want = sorted(((c ^ d).bit_count(), i) for i, d in rows if i != q)[:5]
        mine = sorted((r.distance, r.id) for r in got if r.query_id == q)
        assert mine == want
    few = df.filter("id < 3")
    assert nearest.nearest(few, few, 5, segments=8).count() == 6
    assert nearest.nearest(df.limit(0), df.limit(0), 5).count() == 0


def test_masks_meet_all_changes():
    for gone in itertools.combinations(range(decontaminate.WIDTH), decontaminate.CHANGED):
        assert any(
            not {o + m for m in mask} & set(gone) for mask in decontaminate.MASKS for o in range(decontaminate.WIDTH - mask[-1])
        ), gone


def test_decontamination(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(14 + i))) for i in range(8)] + [(8, "too short an item"), (None, "x " * 20), (9, None)]
    docs = []
    for i in range(60):
        w = [word() for _ in range(60)]
        if i % 2:
            passage = items[i % 8][1].title().split()
            for at in rng.sample(range(2, 12), 2 if i % 3 else 0):
                passage[at] = word()
            w[20 : 20 + len(passage)] = [p + "," for p in passage]
        docs.append((i, " ".join(w)))
    docs += [(100, None), (101, ""), (None, items[0][1]), (102, "too short an item")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit("old"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.marked(df, bench).collect()}
    assert len(got) == len(docs)
    for i in range(60):
        assert got[i].contaminated == bool(i % 2) and got[i]["items"] == ([i % 8] if i % 2 else [])
        if i % 2:
            (span,) = got[i].spans
            assert 20 <= span.start <= 23 and span.end <= 20 + 14 + i % 8 + 2
    assert got[None].contaminated and not any(got[i].contaminated for i in (100, 101, 102))
    assert decontaminate.clean(df, bench).count() == 33
    assert decontaminate.clean(df.limit(0), bench).count() == 0
    assert decontaminate.clean(df, bench.limit(0)).count() == len(docs)


def test_stretches_take_little_memory():
    """Stretches are found in small pieces of text, whatever a batch or a text holds."""
    import tracemalloc

    import pyarrow as pa

    from statmart.llm import suffix_dedup

    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh ") for _ in range(3 << 20))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), pa.array([0, 0], pa.int32()), pa.array([long, long[: 1 << 20]])], names=["doc", "th", "text"])
    tracemalloc.start()
    try:
        found = list(suffix_dedup._read(iter([batch]), 100))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # The second text repeats the first: its stretches leave the task as removed ranges, but for some at the borders.
    assert sum(b.filter(b.column(1).is_valid()).num_rows for b in found)
    assert peak < 150e6
