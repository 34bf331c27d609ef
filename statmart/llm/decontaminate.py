"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over a few words in a row that ignores some of them. Every position of the
benchmark and of the documents is hashed under each mask; equal hashes are joined, and around
each hit the words of both sides are compared in place, substitutions allowed. The three masks
are chosen so that any two substitutions in twelve words leave one of them untouched, so no
overlap of that kind is missed.

Document positions are tested in a bit array of fixed size before they leave the task that reads
them; only those that may be in the benchmark are exchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import free_name, stored

#: Word offsets that count; the others may differ.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 3, 4, 5, 6, 8), (0, 1, 2, 4, 8, 9))
#: An overlap: so many words in place, of which so many may differ.
WIDTH, CHANGED = 12, 2
#: Bits of the filter that every task holds (2 MB), and words that a worker remembers.
FILTER_BITS, CACHE_WORDS = 1 << 24, 500_000
SPAN = max(m[-1] for m in MASKS) + 1
#: Words around a seed's start that are compared: every overlap that holds the seed lies within.
BEFORE, AFTER = WIDTH - 1, SPAN + WIDTH
CONTEXT = BEFORE + AFTER
_MIX = np.random.default_rng(11).integers(1, 1 << 63, (len(MASKS), SPAN), dtype=np.uint64) | np.uint64(1)
_PLAIN = re.compile(r"[\W_]+")
NO_WORD = {"document": 1, "item": 2}


class Words(dict):
    """Hashes of words by their letters and digits; a word without any stands for itself."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(_PLAIN.sub("", word.lower()) or word)
        if len(word) <= 64:
            self[word] = h
        return h


def _hashes(texts: list[str | None], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts end to end, and the number of words of each."""
    if len(words) > CACHE_WORDS:
        words.clear()
    parts = [(t or "").split() for t in texts]
    counts = np.array([len(p) for p in parts], np.int64)
    flat = np.fromiter((h for p in parts for h in map(words.__getitem__, p)), np.uint64, int(counts.sum()))
    return flat, counts


def _keys(h: np.ndarray, mask: int) -> np.ndarray:
    """The hash of the masked words at each start where the mask fits."""
    n = len(h) - MASKS[mask][-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, mask + 1, np.uint64)
    for o in MASKS[mask]:
        out += h[o : o + n] * _MIX[mask, o]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def _bit_places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(40)) % np.uint64(FILTER_BITS), keys % np.uint64(FILTER_BITS)


def _seeds(ids: list, texts: list, words: Words, side: str, bits: np.ndarray | None) -> pa.RecordBatch:
    """Seeds of a batch: id, key, the seed's start, and the words around it."""
    h, counts = _hashes(texts, words)
    ends = np.cumsum(counts)
    stop = np.repeat(ends, counts)
    rows, keys = [], []
    for m, mask in enumerate(MASKS):
        k = _keys(h, m)
        at = np.arange(len(k))
        ok = at + mask[-1] < stop[: len(k)]
        if bits is not None:
            a, b = _bit_places(k)
            ok &= (bits[(a >> np.uint64(3)).astype(np.int64)] >> (a & np.uint64(7)).astype(np.uint8)) & 1 == 1
            at, k, b = at[ok], k[ok], b[ok]
            ok = (bits[(b >> np.uint64(3)).astype(np.int64)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 == 1
        rows.append(at[ok])
        keys.append(k[ok])
    at, k = np.concatenate(rows), np.concatenate(keys)
    owner = np.searchsorted(ends, at, side="right")
    first, last = (ends - counts)[owner], ends[owner]
    place = at[:, None] + np.arange(-BEFORE, AFTER)
    inside = (place >= first[:, None]) & (place < last[:, None])
    around = np.where(inside, h[np.clip(place, 0, max(len(h) - 1, 0))] if len(h) else 0, NO_WORD[side]).astype("<u8")
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids[i] for i in owner], pa.int64()),
            pa.array(k.astype(np.int64)),
            pa.array((at - first).astype(np.int32)),
            pa.array([r.tobytes() for r in around], pa.binary()),
        ],
        names=["id", "key", "start", "around"],
    )


def _seed_rows(df: DataFrame, id: str, text: str, side: str, bits=None) -> DataFrame:  # noqa: A002
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        own = bits.value if bits is not None else None
        for b in batches:
            # Few texts at a time, so that the words held do not depend on the batch's size.
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                yield _seeds(part.column(0).to_pylist(), part.column(1).to_pylist(), words, side, own)

    rows = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).filter(F.col(text).isNotNull())
    return rows.mapInArrow(run, "id long, key long, start int, around binary")


def _filter_bits(seeds: DataFrame) -> np.ndarray:
    """Bit array over the benchmark's keys: put together by Spark, of the same size for any benchmark."""
    place = F.explode(F.array(F.shiftrightunsigned("key", 40), F.col("key").bitwiseAND(FILTER_BITS - 1))).alias("p")
    word = F.shiftright("p", 6).cast("int").alias("w")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(63).cast("int")).alias("b")
    rows = seeds.select(place).select(word, bit).groupBy("w").agg(F.bit_or("b").alias("b")).collect()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    if rows:
        out[[r[0] for r in rows]] = np.array([r[1] for r in rows], np.int64).astype(np.uint64)
    return out.view(np.uint8)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits whose surroundings hold an overlap, with its word range in the document."""
    for b in batches:
        doc, item, start, mine, theirs = (b.column(i) for i in range(5))
        a = np.frombuffer(b"".join(mine.to_pylist()), "<u8").reshape(-1, CONTEXT)
        t = np.frombuffer(b"".join(theirs.to_pylist()), "<u8").reshape(-1, CONTEXT)
        same = np.zeros((len(a), CONTEXT + 1), np.int32)
        agree = a == t
        np.cumsum(agree, axis=1, out=same[:, 1:])
        good = same[:, WIDTH:] - same[:, :-WIDTH] >= WIDTH - CHANGED
        hit = np.flatnonzero(good.any(1))
        good, agree = good[hit], agree[hit]
        # From the first to the last word that agrees within the windows: a substituted word at an
        # overlap's edge is as likely to be the document's own.
        first, last = good.argmax(1), good.shape[1] - 1 - good[:, ::-1].argmax(1) + WIDTH
        place = np.arange(CONTEXT)
        agree &= (place >= first[:, None]) & (place < last[:, None])
        first, last = agree.argmax(1), CONTEXT - agree[:, ::-1].argmax(1)
        at = start.to_numpy(zero_copy_only=False)[hit] - BEFORE
        yield pa.RecordBatch.from_arrays(
            [
                doc.take(pa.array(hit)),
                item.take(pa.array(hit)),
                pa.array((at + first).astype(np.int32)),
                pa.array((at + last).astype(np.int32)),
            ],
            names=["id", "item", "start", "end"],
        )


@dataclass(frozen=True)
class Columns:
    document: str = "doc_id"
    item: str = "item_id"
    text: str = "text"


def overlaps(docs: DataFrame, benchmark: DataFrame, names: Columns = Columns()) -> DataFrame:
    """One row per contaminated document id: ``items`` found in it and ``spans`` of its words.

    A document is contaminated if twelve of its words in a row stand, at most two substituted, in
    an item in the same places. Words are compared by their letters and digits in lower case.
    Items of fewer than twelve words are too short to be told from chance and find nothing. Rows
    that share an id are judged together, a null id included; null texts have no words; equal
    items are all reported. ``spans`` are merged (start, end) word positions, end exclusive, from the
    first to the last word that agrees.
    """
    texts = benchmark.select(F.col(names.item).cast("long").alias("item"), F.col(names.text).alias("text"))
    seeds = stored(_seed_rows(texts.dropna().distinct(), "item", "text", "item"), "seeds")
    seeds = seeds.withColumnsRenamed({"id": "item", "around": "theirs"}).drop("start")
    bits = docs.sparkSession.sparkContext.broadcast(_filter_bits(seeds))
    hits = _seed_rows(docs, names.document, names.text, "document", bits)
    found = (
        hits.join(seeds, "key")
        .select("id", "item", "start", "around", "theirs")
        .mapInArrow(_verified, "id long, item long, start int, end int")
        .groupBy("id", "item", "start")
        .agg(F.max("end").alias("end"))
    )
    per_doc = found.groupBy("id").agg(
        F.sort_array(F.collect_set("item")).alias("items"), F.sort_array(F.collect_set(F.struct("start", "end"))).alias("raw")
    )
    none = F.array().cast("array<struct<start: int, end: int>>")
    merged = F.aggregate(
        "raw",
        none,
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.try_element_at(done, F.lit(-1))["start"].alias("start"),
                        F.greatest(F.try_element_at(done, F.lit(-1))["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    return per_doc.select(F.col("id").alias(names.document), "items", merged.alias("spans"))


def clean(docs: DataFrame, benchmark: DataFrame, names: Columns = Columns()) -> DataFrame:
    """The rows of ``docs`` whose id has no overlap with the benchmark, all columns kept."""
    bad = overlaps(docs, benchmark, names).select(F.col(names.document).alias(free_name(docs, "llm_bad")))
    return docs.join(bad, F.col(names.document).cast("long").eqNullSafe(bad[bad.columns[0]]), "left_anti")


def marked(docs: DataFrame, benchmark: DataFrame, names: Columns = Columns()) -> DataFrame:
    """``docs`` with ``contaminated``, ``items`` and ``spans`` (empty where nothing was found)."""
    key = free_name(docs, "llm_key")
    kept = docs.drop(*[c for c in docs.columns if c.lower() in {"contaminated", "items", "spans"}])
    found = overlaps(docs, benchmark, names).withColumnRenamed(names.document, key)
    out = kept.join(found, F.col(names.document).cast("long").eqNullSafe(F.col(key)), "left")
    return out.select(
        *[F.col(f"`{c}`") for c in kept.columns],
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start: int, end: int>>")).alias("spans"),
    )
