"""Removal of repeated byte strings with a logarithmic family of suffix arrays.

Every byte covered by a string of 100 bytes that also starts earlier is removed. Not all suffixes
have to be sorted for that: of each string of 100 bytes the least hash among its 36-byte pieces
picks one piece, its anchor, and equal strings pick equal anchors. Successive strings with one
anchor form a stretch (about one for 33 bytes), and the suffixes sampled at stretches are sorted
first, by the hashes of their anchor and of all their bytes.

1. Where a text is read, equal stretches of a batch are reduced to the first; the others are
   repeated for certain. So a very common passage leaves each task once.
2. Stretches are dealt by anchor. Each task keeps a family of sorted levels: a new batch becomes a
   level, levels of equal size are merged, and every merge scans equal neighbours, of which the
   later is repeated. Whatever shares an anchor but not all bytes may still share some strings.
3. For those the bytes are fetched, and all their suffixes go through the same family, each cut to
   100 bytes and ordered by its first eight bytes, then by a hash of all: what follows is only
   asked for equality, and suffixes that are equal so far lie next to each other.

An anchor with very many different stretches is not dealt as a whole: its strings are dealt one
by one, by their own hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import free_name, stored

PIECE = 36
#: Bytes hashed at once, buckets that stretches are dealt to, stretches of an anchor that stay together.
CHUNK, BUCKETS, TOGETHER = 1 << 19, 2_048, 256
#: Entries of a new level, and bytes of text whose stretches are reduced together.
LEVEL, BATCH = 1 << 18, 12 << 20
LAST = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64)
U = np.uint64


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.multiply.accumulate(np.full(n, U(_BASE)))
    down = np.multiply.accumulate(np.full(n, U(pow(_BASE, -1, 1 << 64))))
    return up, down


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(29))) * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(32))


def _stretches(data: np.ndarray, span: int, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of a chunk: anchor hash, content hash, first start and number of strings.

    ``last`` is, for each position, the last start of a string that lies in the same section.
    """
    n, reach = len(data), span - PIECE + 1
    up, down = _powers(CHUNK * 2 + span)
    sums = np.zeros(n + 1, U)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    piece = _mix((sums[PIECE:] - sums[:-PIECE]) * down[: n - PIECE + 1])
    m = len(piece)
    # The least hash in each window of pieces, with the leftmost place that has it.
    ranked = (piece & ~U(0xFFFFFF)) | np.arange(m, dtype=U)
    rows = -(-m // reach)
    padded = np.full(rows * reach, ~U(0))
    padded[:m] = ranked
    blocks = padded.reshape(rows, reach)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = m - reach + 1
    least = np.minimum(right[:count], left[reach - 1 : reach - 1 + count])
    start = np.arange(count)
    valid = start <= last[:count]
    new = valid.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~valid[:-1] | (last[1:count] != last[: count - 1])
    s = np.flatnonzero(new)
    if not len(s):
        return (np.zeros(0, U),) * 2 + (s, s)
    e = np.minimum(np.append(s[1:], count) - 1, last[s])
    at = (least[s] & U(0xFFFFFF)).astype(np.int64)
    anchor = piece[at]
    content = _mix((sums[e + span] - sums[s]) * down[s] + (e - s).astype(U) * U(_BASE) + (at - s).astype(U))
    return anchor, content, s, e - s + 1


def _column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column end to end, and the offsets of its rows (null: empty)."""
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    return np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8), offsets


def _by_bytes(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about as many bytes of text each."""
    _, offsets = _column_bytes(b.column(2))
    at = 0
    while at < b.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BATCH, side="right")) - 1)
        yield b.slice(at, to - at)
        at = to


def _sections(offsets: np.ndarray, span: int) -> Iterator[list[tuple[int, int, int]]]:
    """Chunks of sections (row, start in the row, bytes); long texts become overlapping sections."""
    chunk, size = [], 0
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for x in range(0, b - a - span + 1, CHUNK):
            n = min(b - a - x, CHUNK + span - 1)
            if size and size + n > CHUNK:
                yield chunk
                chunk, size = [], 0
            chunk.append((row, x, n))
            size += n
    if chunk:
        yield chunk


# -- the family -----------------------------------------------------------------------


class Family:
    """Sorted levels of (key, order, payload) with distinct keys; the earliest holder of a key stays.

    A key is two words, and so is an order: the document, and the place in it behind its checksum.

    ``add`` sorts a batch into a level and merges levels of like size; ``finish`` merges the rest.
    Each merge scans equal neighbours and reports the payload rows of the later ones.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.later: list[np.ndarray] = []

    def _scan(self, key: np.ndarray, order: np.ndarray, payload: np.ndarray):
        by = np.argsort(key[:, 0])
        lead = key[by, 0]
        tied = np.append(lead[1:] == lead[:-1], False)
        tied[1:] |= tied[:-1]
        if tied.any():
            # Only where the leading words agree do the others and the order matter.
            some = by[tied]
            by[tied] = some[np.lexsort((order[some, 1], order[some, 0], key[some, 1], key[some, 0]))]
        key, order, payload = key[by], order[by], payload[by]
        if len(key) > 1:
            same = (key[1:] == key[:-1]).all(1)
            if same.any():
                group = np.cumsum(np.append(True, ~same)) - 1
                first = np.flatnonzero(np.append(True, ~same))[group]
                again = np.append(False, same)
                # The same place met twice (a repeated row) is no repetition.
                self.later.append(payload[again & (order != order[first]).any(1)])
                key, order, payload = key[~again], order[~again], payload[~again]
        return key, order, payload

    def add(self, key: np.ndarray, order: np.ndarray, payload: np.ndarray) -> None:
        level = self._scan(key, order, payload)
        while self.levels and len(self.levels[-1][0]) <= 2 * len(level[0]):
            level = self._scan(*map(np.concatenate, zip(self.levels.pop(), level)))
        self.levels.append(level)

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """Payload of the earliest holders in key order, and of all later ones."""
        while len(self.levels) > 1:
            a, b = self.levels.pop(), self.levels.pop()
            self.levels.append(self._scan(*map(np.concatenate, zip(a, b))))
        kept = self.levels[0][2] if self.levels else None
        return kept, np.concatenate(self.later) if self.later else None


_ENTRY = np.dtype([("anchor", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("th", "<u2"), ("start", "<u4"), ("n", "u1")])
_DEALT = "bucket int, doc long, th int, start int, end int, blob binary"
_FOUND = "kind int, route long, doc long, th int, start int, end int"
#: Kinds of rows: removed for certain; strings to compare together; strings to compare one by one.
REMOVED, JOINT, SINGLE = 0, 1, 2


def _order(doc: np.ndarray, th: np.ndarray, start: np.ndarray) -> np.ndarray:
    return np.stack([doc, (th.astype(np.int64) << 32) + start.astype(np.int64)], 1)


def _planes(a: np.ndarray) -> bytes:
    """Entries by byte planes, which compress well where high bytes are zero."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes()


def _entries(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(_ENTRY.itemsize, -1).T).view(_ENTRY).ravel()


def _batch(kinds: str, *columns) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in kinds.split(", ")]
    made = [c if isinstance(c, pa.Array) else pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(made, names=[n for n, _ in fields])


def _read(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    for b in (part for b in batches for part in _by_bytes(b)):
        data, offsets = _column_bytes(b.column(2))
        docs = b.column(0).to_numpy(zero_copy_only=False)
        ths = b.column(1).to_numpy(zero_copy_only=False)
        parts = []
        for chunk in _sections(offsets, span):
            own = np.concatenate([data[offsets[r] + x : offsets[r] + x + n] for r, x, n in chunk])
            ends = np.cumsum([n for _, _, n in chunk])
            sizes = np.array([n for _, _, n in chunk])
            last = np.repeat(ends - span, sizes)
            anchor, content, s, n = _stretches(own, span, last)
            sec = np.searchsorted(ends, s, side="right")
            row = np.array([r for r, _, _ in chunk])[sec]
            at = s - (ends - sizes)[sec] + np.array([x for _, x, _ in chunk])[sec]
            part = np.empty(len(s), _ENTRY)
            part["anchor"], part["content"], part["doc"], part["th"] = anchor, content, docs[row], ths[row]
            part["start"], part["n"] = at, n
            parts.append(part)
        if not parts:
            continue
        e = np.concatenate(parts)
        # Equal stretches of the batch: only the first leaves it.
        print_ = e["anchor"] ^ _mix(e["content"])
        by = np.argsort(print_)
        same = np.append(False, print_[by][1:] == print_[by][:-1])
        tied = same | np.append(same[1:], False)
        some = by[tied]
        by[tied] = some[np.lexsort((e["start"][some], e["th"][some], e["doc"][some], print_[some]))]
        e, print_ = e[by], print_[by]
        same = np.append(False, print_[1:] == print_[:-1])
        first = np.flatnonzero(~same)[np.cumsum(~same) - 1]
        place = (e["doc"] == e["doc"][first]) & (e["th"] == e["th"][first]) & (e["start"] == e["start"][first])
        yield from _removed(e[same & ~place], span)
        e = e[~same]
        bucket = (e["anchor"] % U(BUCKETS)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        e, bucket = e[by], bucket[by]
        cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        blobs = [_planes(x) for x in np.split(e, cut[1:])]
        none = [None] * len(cut)
        yield _batch(_DEALT, bucket[cut], none, none, none, none, blobs)


def _removed(e: np.ndarray, span: int) -> Iterator[pa.RecordBatch]:
    if not len(e):
        return
    doc, th, start, end = merged(e["doc"], e["th"], e["start"].astype(np.int64), e["start"].astype(np.int64) + e["n"] + (span - 1))
    bucket = BUCKETS + doc % BUCKETS
    yield _batch(_DEALT, bucket, doc, th.astype(np.int32), start, end, [None] * len(doc))


def merged(doc: np.ndarray, th: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of each document put together where they touch."""
    by = np.lexsort((start, th, doc))
    doc, th, start, end = doc[by], th[by], start[by], end[by]
    new = np.append(True, (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]))
    # Ends so far within the document: shift documents apart, so that one running maximum serves all.
    rank = np.cumsum(new) - 1
    step = int(end.max()) + 1
    reach = np.maximum.accumulate(end + rank * step) - rank * step
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], th[at], start[at], np.maximum.reduceat(end, at)


def _index(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Stretches of a task's anchors through the family; ranges that are removed pass."""
    family, waiting, size = Family(), [], 0

    def insert() -> None:
        e = np.concatenate(waiting)
        family.add(np.stack([e["anchor"], e["content"]], 1), _order(e["doc"], e["th"], e["start"]), e)

    for b in batches:
        passing = b.filter(b.column(5).is_null())
        if passing.num_rows:
            zero = np.zeros(passing.num_rows)
            yield _batch(_FOUND, zero.astype(np.int32), zero.astype(np.int64), *(passing.column(i) for i in range(1, 5)))
        for blob in b.column(5).drop_null().to_pylist():
            waiting.append(_entries(blob))
            size += len(waiting[-1])
            if size >= LEVEL:
                insert()
                waiting, size = [], 0
    if waiting:
        insert()
    kept, later = family.finish()
    if later is not None:
        yield _ranges(later["doc"], later["th"], later["start"], later["n"], span)
    if kept is None:
        return
    new = np.append(True, kept["anchor"][1:] != kept["anchor"][:-1])
    count = np.diff(np.append(np.flatnonzero(new), len(kept)))
    count = np.repeat(count, count)
    e, count = kept[count > 1], count[count > 1]
    if len(e):
        kind = np.where(count > TOGETHER, SINGLE, JOINT).astype(np.int32)
        start = e["start"].astype(np.int32)
        yield _batch(
            _FOUND, kind, e["anchor"].astype(np.int64), e["doc"], e["th"].astype(np.int32), start, start + e["n"] + (span - 1)
        )


def _ranges(doc, th, start, n, span: int) -> pa.RecordBatch:
    doc, th, start, end = merged(doc, th, start.astype(np.int64), start.astype(np.int64) + n + (span - 1))
    kind = np.full(len(doc), REMOVED)
    return _batch(_FOUND, kind, kind.astype(np.int64), doc, th.astype(np.int32), start, end)


_SLICES = "route long, doc long, th int, start int, bytes binary"


def _fetch(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted stretches; those of a crowded anchor string by string."""
    for b in batches:
        out: list[tuple] = []
        for doc, th, raw, wants in zip(*(b.column(i).to_pylist() for i in range(4))):
            for w in wants:
                if w["kind"] == JOINT:
                    out.append((w["route"], doc, th, w["start"], raw[w["start"] : w["end"]]))
                    continue
                for s in range(w["start"], w["end"] - span + 1):
                    x = raw[s : s + span]
                    out.append((xxhash.xxh64_intdigest(x) >> 1, doc, th, s, x))
            if len(out) > 20_000:
                yield _batch(_SLICES, *zip(*out))
                out = []
        if out:
            yield _batch(_SLICES, *zip(*out))


def _compare(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """All strings of the fetched bytes through the family: by their first eight bytes, then by a hash of all."""
    family, waiting, size = Family(), [], 0

    def insert() -> None:
        raw = np.frombuffer(b"".join([w[3] for w in waiting]), np.uint8)
        lens = np.array([len(w[3]) for w in waiting])
        strings = lens - span + 1
        own = np.repeat(np.arange(len(lens)), strings)
        inner = np.arange(len(own)) - np.repeat(np.cumsum(strings) - strings, strings)
        at = (np.cumsum(lens) - lens)[own] + inner
        up, down = _powers(CHUNK * 2 + span)
        sums = np.zeros(len(raw) + 1, U)
        np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
        key = np.empty((len(own), 2), U)
        key[:, 0] = np.lib.stride_tricks.sliding_window_view(raw, 8)[at].copy().view(">u8").ravel()
        key[:, 1] = _mix((sums[at + span] - sums[at]) * down[at])
        payload = np.empty(len(own), [("doc", "<i8"), ("th", "<i4"), ("start", "<i4")])
        for name, i in (("doc", 0), ("th", 1), ("start", 2)):
            payload[name] = np.array([w[i] for w in waiting])[own]
        payload["start"] += inner.astype(np.int32)
        family.add(key, _order(payload["doc"], payload["th"], payload["start"]), payload)

    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(1, 5))):
            if waiting and size + len(row[3]) > CHUNK:
                insert()
                waiting, size = [], 0
            waiting.append(row)
            size += len(row[3])
    if waiting:
        insert()
    _, later = family.finish()
    if later is not None:
        yield _ranges(later["doc"], later["th"], later["start"], np.ones(len(later), np.int64), span)


def _cut(batches: Iterator[pa.RecordBatch], n: int, names: list[str], whole_characters: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols: list[list] = [[], [], [], []]
        for raw, ranges in zip(b.column(n).to_pylist(), b.column(n + 1).to_pylist()):
            raw = raw or b""
            spans: list[tuple[int, int]] = []
            for a, z in sorted((r["start"], r["end"]) for r in ranges or ()):
                if spans and a <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(z, spans[-1][1]))
                else:
                    spans.append((a, z))
            if whole_characters:
                # A character goes only if all its bytes do.
                spans = [(a, z) for a, z in ((_next(raw, a), _last(raw, z)) for a, z in spans) if a < z]
            kept, at = [], 0
            for a, z in spans:
                kept.append(raw[at:a])
                at = z
            kept.append(raw[at:])
            cols[0].append(len(raw))
            cols[1].append(sum(z - a for a, z in spans))
            cols[2].append([{"start": a, "end": z} for a, z in spans])
            cols[3].append(b"".join(kept))
        types = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.binary()]
        made = [pa.array(c, t) for c, t in zip(cols, types)]
        yield pa.RecordBatch.from_arrays([*b.columns[:n], *made], names=names)


def _next(raw: bytes, i: int) -> int:
    while i < len(raw) and raw[i] & 0xC0 == 0x80:
        i += 1
    return i


def _last(raw: bytes, i: int) -> int:
    while i < len(raw) and raw[i] & 0xC0 == 0x80:
        i -= 1
    return i


def repeats_removed(
    df: DataFrame,
    id: str = "doc_id",  # noqa: A002
    text: str = "text",
    span: int = 100,
    whole_characters: bool = False,
    keep_text: bool = True,
) -> DataFrame:
    """Add ``n_bytes``, ``n_removed``, ``spans`` (removed byte ranges) and ``kept`` (the other bytes).

    A byte is removed if a string of ``span`` bytes (40 at least) that covers it also starts
    earlier: in a row with a smaller id, or before it in the same row. Strings are judged on the
    input and never cross rows. A null text has no bytes; a null id sorts last. Rows that share an
    id are ordered by a checksum of their text; a repeated row counts as the same document and
    gets the same result. With ``whole_characters`` a character stays unless all its bytes go.
    Every row and column is kept (without ``keep_text`` all but the text); columns that bear an
    output's name are replaced.
    """
    if span < PIECE + 4:
        raise ValueError(f"strings of {PIECE + 4} bytes at least")
    outputs = ["n_bytes", "n_removed", "spans", "kept"]
    base = df.drop(*[c for c in df.columns if c.lower() in set(outputs) and c != text])
    doc, th = F.coalesce(F.col(id).cast("long"), F.lit(LAST)), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    th = th.bitwiseAND(0xFFFF).cast("int")
    source = base.filter(F.octet_length(text) >= span).select(doc.alias("doc"), th.alias("th"), F.col(text).alias("text"))
    found = stored(
        source.mapInArrow(lambda it: _read(it, span), _DEALT)
        .repartition("bucket")
        .mapInArrow(lambda it: _index(it, span), _FOUND),
        "repeats",
    )
    k_doc, k_th, k_wants, k_ranges, k_text = (free_name(base, f"llm_{x}") for x in ("doc", "th", "wants", "ranges", "text"))
    keyed = base.withColumns({k_doc: doc, k_th: th})
    want = F.struct("kind", "route", "start", "end")
    asked = found.filter(F.col("kind") != REMOVED).groupBy("doc", "th").agg(F.collect_list(want).alias("wants"))
    own = [F.col("doc").alias(k_doc), F.col("th").alias(k_th)]
    rows = keyed.select(k_doc, k_th, F.col(f"`{text}`").cast("binary").alias(k_text)).join(asked.select(*own, F.col("wants").alias(k_wants)), [k_doc, k_th])
    slices = rows.select(F.col(k_doc).alias("doc"), F.col(k_th).alias("th"), F.col(k_text).alias("bytes"), F.col(k_wants).alias("wants")).mapInArrow(
        lambda it: _fetch(it, span), _SLICES
    )
    more = slices.repartition("route").mapInArrow(lambda it: _compare(it, span), _FOUND)
    ranges = found.filter(F.col("kind") == REMOVED).unionByName(more)
    per_row = ranges.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    per_row = per_row.select(*own, F.col("ranges").alias(k_ranges))
    names = [c for c in base.columns if keep_text or c != text]
    joined = keyed.join(per_row, [k_doc, k_th], "left").select(
        *[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").cast("binary").alias(k_text), k_ranges
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields if f.name in names)
    kinds = "n_bytes long, n_removed long, spans array<struct<start: int, end: int>>, kept binary"
    n = len(names)
    return joined.mapInArrow(lambda it: _cut(it, n, [*names, *outputs], whole_characters), f"{fields}, {kinds}")
