"""Alignment of two tokenizers over a corpus: which tokens cover the same bytes, and how often.

Both tokenizers cut at a space between words, so a text is a list of segments whose tokens, groups
and links depend on the segment alone. A worker encodes each distinct segment once and keeps a
bounded number of them. Tokens whose whole group is one token of A and the token of B with the same
bytes are counted in a vector as long as A's vocabulary (``_identity`` maps the ids); all other
links enter the shuffle of pairs.

Documents are taken in chunks of bounded bytes. A chunk asks once for the count of each pair that
it holds, however often, and gets the answers back beside its documents; no count table is sent to
every task, and a frequent pair is one row a chunk.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from .shared import free_name, stored

#: Bytes of text that share one list of pairs.
CHUNK = 4 << 20
#: Segments that a worker remembers at most between two chunks, and characters that these may have.
REMEMBERED, CHARACTERS = 500_000, 8 << 20
#: Segments encoded in one call.
TOGETHER = 20_000
#: A space beside other white space, white space at an end, or a piece's mark for a space.
UNEVEN = re.compile(r"\s | \s|^\s|\s$|▁")
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
OUTPUTS = [*_COUNTS, "n_best", "count_sum", "groups_sha256"]


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, the bytes of their tokens, and the segments seen last."""

    def __init__(self, a: str, b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        letters = _byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        special = {i: t.content for i, t in self.a.get_added_tokens_decoder().items()}
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = special[i].encode() if i in special else bytes(letters[c] for c in token)
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if raw else p.replace("▁", " ").encode() for p, raw in pieces]
        self.identity = self._identity([raw or self.b.is_control(i) or self.b.is_unknown(i) for i, (_, raw) in enumerate(pieces)])
        self.sizes = [np.array([len(x) for x in of], np.int64) for of in (self.a_bytes, self.b_bytes)]
        self.names = [np.array([str(i) for i in range(len(of))], object) for of in (self.a_bytes, self.b_bytes)]
        # A piece with a space after another character would reach over the border of two segments.
        if any(" " in p.decode(errors="replace").lstrip(" ") for p, (_, raw) in zip(self.b_bytes, pieces) if not raw):
            raise ValueError("the second vocabulary has pieces that reach over a space")
        self.forget()

    def forget(self) -> None:
        """Drop all segments: their numbers and, laid end to end by number, their facts, links and groups."""
        self.place: dict[str, int] = {}
        #: Tokens of either kind and groups (-1: bytes are lost), and where the segment's links and groups end.
        self.facts = np.zeros((1024, 5), np.int64)
        self.links = np.zeros(4096, np.int64)
        self.groups = bytearray()
        self.characters = 0

    def _ends(self, numbers: np.ndarray, column: int) -> tuple[np.ndarray, np.ndarray]:
        ends = self.facts[numbers, column]
        return np.where(numbers > 0, self.facts[numbers - 1, column], 0), ends

    def links_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The links of segments, one after the other, and where each segment's begin."""
        low, high = self._ends(numbers, 3)
        starts = np.zeros(len(numbers) + 1, np.int64)
        np.cumsum(high - low, out=starts[1:])
        return self.links[np.repeat(low - starts[:-1], high - low) + np.arange(starts[-1])], starts

    def groups_of(self, numbers: np.ndarray) -> list[bytes]:
        low, high = self._ends(numbers, 4)
        return [bytes(self.groups[i:j]) for i, j in zip(low.tolist(), high.tolist())]

    def _identity(self, second: list[bool]) -> np.ndarray:
        """For each id of A the id of B with the same bytes, or -1; a plain piece goes before a byte."""
        of: dict[bytes, int] = {}
        for i in sorted(range(len(self.b_bytes)), key=lambda i: (second[i], i)):
            of.setdefault(self.b_bytes[i], i)
        return np.array([of.get(x, -1) if x else -1 for x in self.a_bytes], np.int64)

    def segments(self, text: str) -> list[str]:
        """``text`` with a space before it, cut before each single space that a word follows; that space is left off."""
        if not UNEVEN.search(text):
            return text.split(" ")
        out: list[str] = []
        open_, last = [], " "  # the parts of the segment that is not closed yet, its last character
        for part in text.split(" "):
            # A space before or after other white space is left where it is: tokens may reach over it.
            if open_ and part and not (part[0].isspace() or last.isspace() or last == "▁"):
                out.append(" ".join(open_))
                open_ = []
            open_.append(part)
            last = part[-1] if part else " "
        out.append(" ".join(open_))
        return out

    def learn(self, segments: set[str]) -> None:
        """Number the segments that are new, and work out what they are made of."""
        new = [s for s in segments if s not in self.place]
        for i in range(0, len(new), TOGETHER):
            some = new[i : i + TOGETHER]
            a = [e.ids for e in self._batch([" " + s for s in some], add_special_tokens=False)]
            b = self.b.encode(some, num_threads=1)
            self._align(some, a, b)
            self.characters += sum(map(len, some))

    @property
    def _batch(self):
        # Without offsets, which nobody reads, where the library can leave them out.
        return getattr(self.a, "encode_batch_fast", self.a.encode_batch)

    def _align(self, segments: list[str], a: list[list[int]], b: list[list[int]]) -> None:
        """All segments laid end to end: every stretch between two token ends, of either kind, is one link."""
        raw = [(" " + s).encode() for s in segments]
        good = np.ones(len(raw), bool)
        for ids, of in ((a, self.a_bytes), (b, self.b_bytes)):
            made = [b"".join([of[i] for i in x]) for x in ids]
            if made != raw:
                good &= np.fromiter((x == y for x, y in zip(made, raw)), bool, len(raw))
        ids = [np.array([i for x, g in zip(of, good) if g for i in x], np.int64) for of in (a, b)]
        n = [np.array([len(x) if g else 0 for x, g in zip(of, good)], np.int64) for of in (a, b)]
        ends = [np.cumsum(size[i]) for size, i in zip(self.sizes, ids)]
        cuts = np.union1d(*ends)
        at = [np.searchsorted(e, cuts) for e in ends]
        links = (ids[0][at[0]] << 32) | ids[1][at[1]]
        common = np.intersect1d(*ends, assume_unique=True)
        group = np.concatenate([np.searchsorted(common, e) for e in ends])
        segment = np.concatenate([np.repeat(np.arange(len(raw)), x) for x in n])
        side = np.repeat([0, 1], [len(i) for i in ids])
        order = np.argsort(group * 2 + side, kind="stable")
        # What follows a token: its like in the group, the other side, the next group.
        now, then = (group * 2 + side)[order], np.append((group * 2 + side)[order][1:], -1)
        text = np.empty(2 * len(order), object)
        text[0::2] = np.concatenate([names[i] for names, i in zip(self.names, ids)])[order] if len(order) else []
        text[1::2] = np.where(now == then, ",", np.where(now // 2 == then // 2, "|", ";"))
        words = text.tolist()
        token_ends = np.cumsum(np.bincount(segment, minlength=len(raw))).tolist()
        link_ends = np.cumsum(np.bincount(segment[: len(ids[0])][at[0]], minlength=len(raw)))
        group_ends = segment[: len(ids[0])][np.searchsorted(ends[0], common)] if len(common) else np.zeros(0, np.int64)
        counts = np.stack([*n, np.bincount(group_ends, minlength=len(raw))], 1)
        counts[~good] = -1
        said, start = [], 0
        for end in token_ends:
            said.append("".join(words[2 * start : 2 * end - 1]) if end > start else "")
            start = end
        first = len(self.place)
        self.place.update(zip(segments, range(first, first + len(raw))))
        while first + len(raw) > len(self.facts):
            self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)])
        n_links, n_groups = self.facts[first - 1, 3:].tolist() if first else (0, 0)
        while n_links + len(links) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.links[n_links : n_links + len(links)] = links
        self.groups += "".join(said).encode()
        new = self.facts[first : first + len(raw)]
        new[:, :3] = counts
        new[:, 3] = n_links + link_ends
        new[:, 4] = n_groups + np.cumsum([len(x) for x in said])


@lru_cache(maxsize=1)
def pair(a: str, b: str) -> Pair:
    return Pair(a, b)


def _chunk(p: Pair, texts: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """For each text its counts, its groups' hash and its links (places in the pair list, occurrences); the pairs and in how many texts each is linked."""
    cut = [p.segments(t) if t else [] for t in texts]
    if len(p.place) > REMEMBERED or p.characters > CHARACTERS:
        p.forget()
    p.learn(set().union(*cut))
    numbers = [np.fromiter(map(p.place.__getitem__, c), np.int64, len(c)) for c in cut]
    numbers = [x if len(x) and p.facts[x, 0].min() >= 0 else x[:0] for x in numbers]
    own = np.unique(np.concatenate(numbers)) if numbers else np.zeros(0, np.int64)
    links, starts = p.links_of(own)
    pairs, links = np.unique(links, return_inverse=True)
    groups = p.groups_of(own)
    rows, texts_with = [], np.zeros(len(pairs), np.int64)
    for x in numbers:
        x = np.searchsorted(own, x)
        digest = hashlib.sha256(b";".join([groups[i] for i in x.tolist()])).hexdigest() if len(x) else ""
        which, often = np.unique(x, return_counts=True)
        counts = often @ p.facts[own[which], :3]
        lengths = starts[which + 1] - starts[which]
        # The links of all its segments, one after the other.
        offsets = np.repeat(starts[which] - np.cumsum(lengths) + lengths, lengths)
        held, of = np.unique(links[offsets + np.arange(len(offsets))], return_inverse=True)
        n = np.bincount(of, np.repeat(often, lengths), len(held)).astype(np.int64)
        texts_with[held] += 1
        rows.append((*counts.tolist(), int(n.sum()), digest, held.astype("<u4").tobytes(), n.astype("<u4").tobytes()))
    return rows, pairs, texts_with


def _bytes_cut(batch: pa.RecordBatch, at: int, size: int):
    """Slices of a batch whose texts have about ``size`` bytes, one text at least."""
    ends = np.cumsum([len(t.as_buffer() or b"") if t.is_valid else 0 for t in batch.column(at)])
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _encoded(df: DataFrame, a: str, b: str, chunk: int, names: list[str], source: str, helpers: list[str]) -> DataFrame:
    """One row a document with its own counts; the first row of a chunk has the chunk's pairs, the
    last of a task the vector of its regular pairs: in how many texts each id of A meets its equal."""
    label, held, often, pairs, texts, vector = helpers

    def run(batches):
        p, nr = None, TaskContext.get().partitionId() << 32
        waiting, size, regular, done = [], 0, None, None

        def flush():
            nonlocal regular
            rows = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            made, found, with_pair = _chunk(p, rows.column(len(names)).to_pylist())
            cols = list(zip(*made))
            same = p.identity[found >> 32] == (found & 0xFFFFFFFF)
            regular = np.zeros(len(p.identity), np.int64) if regular is None else regular
            regular[found[same] >> 32] += with_pair[same]
            # A regular pair is known by A's id alone: below zero, and asked for nowhere.
            first = lambda x: pa.array([x] + [None] * (len(made) - 1), pa.list_(pa.int64()))
            return [
                *rows.columns[: len(names)], pa.array([nr] * len(made), pa.int64()), *[pa.array(c, pa.int64()) for c in cols[:4]],
                pa.array(cols[4], pa.string()), pa.array(cols[5], pa.binary()), pa.array(cols[6], pa.binary()),
                first(np.where(same, -1 - (found >> 32), found)), first(with_pair),
            ]

        def batch_of(columns, of_task):
            last = pa.array([None] * (len(columns[0]) - 1) + [of_task], pa.binary())
            return pa.RecordBatch.from_arrays([*columns, last], names=[*names, label, *_COUNTS, "groups_sha256", held, often, pairs, texts, vector])

        for batch in batches:
            p = p or pair(a, b)
            for part in _bytes_cut(batch, len(names), chunk):
                waiting.append(part)
                size += part.column(len(names)).nbytes
                if size >= chunk:
                    if done:
                        yield batch_of(done, None)
                    done = flush()
                    waiting, size, nr = [], 0, nr + 1
        if waiting:
            if done:
                yield batch_of(done, None)
            done = flush()
        if done:
            yield batch_of(done, regular.astype("<i8").tobytes())
            p.forget()  # the worker goes on to other stages

    fields = [*df.select(*[F.col(f"`{n}`") for n in names]).schema.fields, StructField(label, LongType())]
    fields += [StructField(c, LongType()) for c in _COUNTS] + [StructField("groups_sha256", StringType())]
    fields += [StructField(c, BinaryType()) for c in (held, often)] + [StructField(c, ArrayType(LongType())) for c in (pairs, texts)]
    fields += [StructField(vector, BinaryType())]
    return df.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{source}`")).mapInArrow(run, StructType(fields))


def _irregular(rows: DataFrame, label: str, pairs: str, texts: str) -> tuple[DataFrame, DataFrame]:
    """(chunk, pair) of all chunks, and the corpus-wide count of each pair, regular ones left out."""
    told = rows.filter(F.col(pairs).isNotNull()).select(
        F.col(label).alias("chunk"), F.inline(F.arrays_zip(F.col(pairs).alias("pair"), F.col(texts).alias("n")))
    )
    told = told.filter("pair >= 0")
    return told.select("chunk", "pair"), told.groupBy("pair").agg(F.sum("n").alias("n"))


def _regular(rows: DataFrame, vector: str) -> DataFrame:
    """``a`` and ``n``: the sum of the tasks' vectors, a row for each entry above zero."""

    def entries(batches):
        for batch in batches:
            for v in batch.column(0).to_pylist():
                n = np.frombuffer(v, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n)), pa.array(n[n > 0])], names=["a", "n"])

    return rows.filter(F.col(vector).isNotNull()).select(vector).mapInArrow(entries, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))


def _of_vocabulary(df: DataFrame, size: int) -> np.ndarray:
    """(id, value) rows as a vector: at most one row for each id of the vocabulary comes to the driver."""
    out = np.zeros(size, np.int64)
    got = df.toArrow()
    out[got.column(0).to_numpy()] = got.column(1).to_numpy()
    return out


def aligned(df: DataFrame, a: str, b: str, text: str = "text", chunk: int = CHUNK, keep_text: bool = True) -> DataFrame:
    """Add the figures in :data:`OUTPUTS` for each whole text.

    ``a`` is the path of a byte-level vocabulary, ``b`` that of a piece model; every executor can
    open both. The text is encoded with a space before it, without special tokens. Byte offsets at
    which tokens of both end cut them into groups; tokens whose bytes overlap are linked. A pair's
    count is the number of rows that hold it linked; ``n_best`` counts the links whose count is the
    largest of their A id, ``count_sum`` adds up the counts of all links, ``groups_sha256`` hashes
    ``a1,a2|b1;a3|b2``.

    A null or empty text, or one that either vocabulary cannot give back byte for byte, has zeros and
    an empty string. Every row and column is kept (without ``keep_text`` all but the text), repeated
    rows each for itself; columns that bear an output's name are replaced. The first use encodes
    ``df`` and writes what it found to the shared folder.
    """
    kept = df.drop(*[c for c in df.columns if c.lower() in OUTPUTS and c != text])
    names = [c for c in kept.columns if (keep_text or c.lower() != text.lower()) and c.lower() not in OUTPUTS]
    helpers = [free_name(kept, f"llm_{x}") for x in ("chunk", "held", "often", "pairs", "texts", "vector")]
    source = free_name(kept, "llm_text")
    rows = stored(_encoded(kept.withColumn(source, F.col(f"`{text}`")), a, b, chunk, names, source, helpers), "align-rows")
    label, held, often, pairs, texts, vector = helpers
    asked, counts = _irregular(rows, label, pairs, texts)
    counts = stored(counts, "align-counts")
    n_ids = len(pair(a, b).identity)
    regular = _of_vocabulary(_regular(rows, vector), n_ids)
    best = np.maximum(regular, _of_vocabulary(counts.groupBy(F.shiftright("pair", 32)).agg(F.max("n")), n_ids))
    of_ids = df.sparkSession.sparkContext.broadcast((regular, best))
    answers = asked.join(counts, "pair").select("chunk", "pair", "n")

    def weigh(left: pa.Table, right: pa.Table) -> pa.Table:
        """The documents of a chunk with the counts of the pairs that they hold."""
        regular, best = of_ids.value
        lists = [x for x in left.column(pairs).combine_chunks() if x.is_valid]
        own = np.concatenate([np.asarray(x.values) for x in lists]) if lists else np.empty(0, np.int64)
        same = own < 0
        ids = np.where(same, -1 - own, own >> 32)
        n = np.where(same, regular[ids], 0)
        told = right.column("pair").to_numpy()
        order = np.argsort(told)
        n[~same] = right.column("n").to_numpy()[order[np.searchsorted(told[order], own[~same])]]
        is_best = n == best[ids]
        sums, bests = [], []
        for h, o in zip(left.column(held).to_pylist(), left.column(often).to_pylist()):
            which, times = np.frombuffer(h, "<u4"), np.frombuffer(o, "<u4").astype(np.int64)
            sums.append(int(n[which] @ times))
            bests.append(int(times[is_best[which]].sum()))
        out = left.select([*names, *_COUNTS]).append_column("n_best", pa.array(bests, pa.int64()))
        return out.append_column("count_sum", pa.array(sums, pa.int64())).append_column("groups_sha256", left.column("groups_sha256"))

    schema = StructType(
        [*[f for f in rows.schema.fields if f.name in names], *[StructField(c, LongType()) for c in (*_COUNTS, "n_best", "count_sum")], StructField("groups_sha256", StringType())]
    )
    return rows.groupBy(label).cogroup(answers.groupBy("chunk")).applyInArrow(weigh, schema)


def pair_counts(df: DataFrame, a: str, b: str, text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """The alignment table: ``a_id``, ``b_id``, ``n`` (rows of ``df`` that hold the pair linked) and ``same_bytes``.

    Texts count as in :func:`aligned`; an empty table gives an empty one.
    """
    helpers = ["llm_chunk", "llm_held", "llm_often", "llm_pairs", "llm_texts", "llm_vector"]
    rows = stored(_encoded(df.select(F.col(text).alias("llm_text")), a, b, chunk, [], "llm_text", helpers), "align-rows")
    identity = pair(a, b).identity
    _, counts = _irregular(rows, helpers[0], *helpers[3:5])
    of_a = df.sparkSession.createDataFrame(pa.table({"a": np.flatnonzero(identity >= 0), "b": identity[identity >= 0]}))
    same = _regular(rows, helpers[5]).join(F.broadcast(of_a), "a").select("a", "b", "n", F.lit(True).alias("same_bytes"))
    other = counts.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "n", F.lit(False).alias("same_bytes"))
    return same.unionByName(other).select(F.col("a").cast("int").alias("a_id"), F.col("b").cast("int").alias("b_id"), "n", "same_bytes")
