"""Byte-pair encoding and decoding by tree concatenation.

A text becomes a sequence of base symbols (one per UTF-8 byte of its normalised words, the last
of a word marked). A long unsplit run is halved down to leaves; the leaves are merged on their
own, and two neighbours are joined by re-encoding a window around the seam that doubles until
both of its ends agree with what stands outside. That is exact: a sequence of tokens is the
encoding of its text if and only if each pair of neighbours is the encoding of its own text, so
only the two pairs at the window's ends have to be looked at.

Texts with a run of ``run`` or more characters are cut into pieces that different tasks encode;
all other texts are encoded where they are read, through a bounded cache of words.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .shared import free_name

#: Words that one Python worker remembers; the cache is emptied when it is full.
CACHE_WORDS = 400_000
#: Symbols of a leaf of the tree, and of a piece that a task encodes by itself.
LEAF, PIECE = 2_048, 65_536
WORD_END = "</w>"


def byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    stand_in = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [stand_in[b] for b in range(256)]


class Encoder:
    """The merges of a vocabulary file whose words end in a marker (lower case, no white space kept)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.text = {i: t for t, i in vocab.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text.update({i: t for t, i in self.specials.items()})
        chars = byte_characters()
        self.inner = [vocab[c] for c in chars]
        self.last = [vocab[c + WORD_END] for c in chars]
        self.base = {*self.inner, *self.last}
        self.ends = {*self.last, *self.specials.values()}
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, ...]] = {i: (i,) for i in self.base}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.merged[x, y] = (rank, z)
            self.parts.setdefault(z, self.parts[x] + self.parts[y])
        words = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words, self.library = regex.compile(words), Tokenizer.from_file(path)
        self.special = regex.compile("|".join(map(regex.escape, self.specials)) or r"(?!)")
        # Ids and decoded text of blank-separated chunks, and of the words in them.
        self.cache: dict[str, tuple[bytes, bytes]] = {}
        self.seen: dict[str | int, tuple[bytes, bytes]] = {}

    # -- from text to symbols ---------------------------------------------------------

    def pretokens(self, chunk: str) -> Iterator[str | int]:
        """Normalised words of a stretch of text, and the ids of special tokens in it."""
        at = 0
        for m in self.special.finditer(chunk):
            yield from self._words(chunk[at : m.start()])
            yield self.specials[m.group()]
            at = m.end()
        yield from self._words(chunk[at:] if at else chunk)

    def _words(self, part: str) -> Iterator[str]:
        if part.isascii():
            yield from self.words.findall(part.lower())
            return
        if any(unicodedata.category(c) == "Cn" for c in part):
            # Code points that Python has no name for yet: the library knows which of them are letters.
            plain = self.library.normalizer.normalize_str(part)
            for _, (start, end) in self.library.pre_tokenizer.pre_tokenize_str(plain):
                yield plain[start:end]
            return
        # Letter by letter: a final sigma is no special case here.
        yield from self.words.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())

    def spelled(self, word: str | int) -> list[int]:
        """Base symbols of one word; a special token stands for itself."""
        if isinstance(word, int):
            return [word]
        raw = word.encode()
        s = [self.inner[b] for b in raw]
        s[-1] = self.last[raw[-1]]
        return s

    def symbols(self, chunk: str) -> list[int]:
        return [x for w in self.pretokens(chunk) for x in self.spelled(w)]

    # -- merging ----------------------------------------------------------------------

    def merge(self, s: list[int]) -> list[int]:
        """Merge a run of symbols: lowest rank first, leftmost first."""
        if len(s) > 48:
            return self._merge_long(s)
        get = self.merged.get
        s = list(s)
        # The merge that each symbol and its right neighbour allow, kept up to date.
        able = [get(p, _NEVER) for p in zip(s, s[1:])]
        while able:
            best = min(able)
            if best is _NEVER:
                break
            i = able.index(best)
            s[i : i + 2] = [best[1]]
            del able[i]
            if i:
                able[i - 1] = get((s[i - 1], s[i]), _NEVER)
            if i < len(able):
                able[i] = get((s[i], s[i + 1]), _NEVER)
        return s

    def _merge_long(self, s: list[int]) -> list[int]:
        s, n, get = list(s), len(s), self.merged.get
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(m[0], i, s[i], s[i + 1], m[1]) for i in range(n - 1) if (m := get((s[i], s[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if s[i] != a or j < 0 or s[j] != b:
                continue
            s[i], s[j], k = new, -1, after[j]
            after[i] = k
            if k >= 0:
                before[k] = i
                if m := get((new, s[k])):
                    heapq.heappush(heap, (m[0], i, new, s[k], m[1]))
            h = before[i]
            if h >= 0 and (m := get((s[h], new))):
                heapq.heappush(heap, (m[0], h, s[h], new, m[1]))
        return [x for x in s if x >= 0]

    def _spell(self, tokens: list[int]) -> list[int]:
        return [x for t in tokens for x in self.parts.get(t, (t,))]

    def _stands(self, a: int, b: int) -> bool:
        """Whether two neighbours are the encoding of their own text."""
        return self.merge(self._spell([a, b])) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of two encoded neighbours put together."""
        if not left or not right:
            return left + right
        k = 1
        while True:
            cut, rest = max(0, len(left) - k), min(len(right), k)
            window = self.merge(self._spell(left[cut:] + right[:rest]))
            open_left = cut > 0 and not self._stands(left[cut - 1], window[0])
            open_right = rest < len(right) and not self._stands(window[-1], right[rest])
            if not open_left and not open_right:
                return left[:cut] + window + right[rest:]
            k *= 2

    def tree(self, s: list[int]) -> list[int]:
        """Halve down to leaves, encode them, and join upwards."""
        if len(s) <= LEAF:
            return self.merge(s)
        half = len(s) // 2
        return self.join(self.tree(s[:half]), self.tree(s[half:]))

    # -- whole texts ------------------------------------------------------------------

    def _word(self, word: str | int) -> tuple[bytes, bytes]:
        ids = self.tree(self.spelled(word))
        found = struct.pack(f"<{len(ids)}I", *ids), " ".join(map(self.text.__getitem__, ids)).encode()
        if isinstance(word, str) and len(word) <= 64:
            if len(self.seen) >= CACHE_WORDS:
                self.seen.clear()
            self.seen[word] = found
        return found

    def _entry(self, chunk: str) -> tuple[bytes, bytes]:
        words = list(self.pretokens(chunk))
        get, make = self.seen.get, self._word
        found = [get(w) or make(w) for w in words]
        out = found[0] if len(found) == 1 else (b"".join([f[0] for f in found]), b" ".join([f[1] for f in found]))
        if len(chunk) <= 64:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[chunk] = out
        return out

    def _runs(self, s: list[int]) -> Iterator[list[int]]:
        """Runs between word ends; no merge crosses one."""
        ends, at = self.ends, 0
        for i, x in enumerate(s):
            if x in ends:
                yield s[at : i + 1]
                at = i + 1
        if at < len(s):
            yield s[at:]

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """Token ids as little-endian unsigned 32-bit integers, and the decoded text in UTF-8."""
        if not text:
            return b"", b""
        chunks = text.split() if not any(c in text for c in _NO_SPACE) else _SPACE.split(text)
        get, entry = self.cache.get, self._entry
        found = [get(c) or entry(c) for c in chunks if c]
        return b"".join([f[0] for f in found]), b" ".join([f[1] for f in found if f[1]])

    def decode(self, ids) -> str:
        """Tokens separated by blanks, as a tokenizer without a decoder writes them; unknown ids vanish."""
        return " ".join(t for i in ids if (t := self.text.get(int(i))) is not None)


_NEVER = (1 << 60, 0)
#: Separators that str.split() takes for white space and the vocabulary's pattern doesn't.
_NO_SPACE = "\x1c\x1d\x1e\x1f"
_SPACE = regex.compile(r"\s+")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _digest(ids: bytes, decoded: bytes, with_ids: bool) -> tuple:
    row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
    return (*row, ids) if with_ids else row


def encoded(
    df: DataFrame, vocabulary: str, text: str = "text", run: int = PIECE, ids: str | None = None
) -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` for each whole text.

    ``vocabulary`` is the path of a vocabulary file that every executor can open. With ``ids`` a
    column of that name holds the token ids as little-endian unsigned 32-bit integers. Every input column and row is kept; a
    column of ``df`` that bears an output's name is replaced. A null or empty text has no tokens.
    Texts with an unsplit run of ``run`` characters are encoded in pieces by several tasks.
    """
    outputs = ["n_tokens", "ids_sha256", "decoded_sha256", *([ids] if ids else [])]
    kinds = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (f", `{ids}` binary" if ids else "")
    kept = df.drop(*[c for c in df.columns if c.lower() in {o.lower() for o in outputs} and c != text])
    work = free_name(kept, "llm_text")
    # Only what the tasks need goes to Python besides the other columns, which pass as they are.
    names = kept.columns
    with_ids = bool(ids)
    long = F.coalesce(F.col(text), F.lit("")).rlike(r"[^\s]{%d}" % run)
    direct = kept.withColumn(work, F.col(text)).filter(~long)

    def whole(batches):
        enc = encoder(vocabulary)
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            yield _with(b, len(names), [_digest(*enc.encode(t), with_ids) for t in texts], outputs)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    short = direct.mapInArrow(whole, f"{fields}, {kinds}")
    pieces = kept.filter(long).select(F.sha2(F.col(text), 256).alias("key"), F.col(text).alias("text")).distinct()
    done = (
        pieces.mapInArrow(lambda it: _cut(it, vocabulary), "key string, seq int, symbols binary")
        .repartition("key", "seq")
        .mapInArrow(lambda it: _encode_pieces(it, vocabulary), "key string, seq int, tokens binary")
        .groupBy("key")
        .applyInPandas(lambda pdf: _concatenate(pdf, vocabulary, with_ids, outputs), f"key string, {kinds}")
    )
    sha = free_name(kept, "llm_key")
    far = (
        kept.filter(long)
        .withColumn(sha, F.sha2(F.col(text), 256))
        .join(done.withColumnRenamed("key", sha), sha)
        .select(*[F.col(f"`{c}`") for c in [*names, *outputs]])
    )
    return short.unionByName(far)


def _with(batch: pa.RecordBatch, n: int, rows: list[tuple], outputs: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(outputs)
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary()]
    made = [pa.array(c, k) for c, k in zip(cols, kinds)]
    return pa.RecordBatch.from_arrays([*batch.columns[:n], *made], names=[*batch.schema.names[:n], *outputs])


def _cut(batches, vocabulary: str):
    enc = encoder(vocabulary)
    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            s = np.array([x for c in _SPACE.split(text) if c for x in enc.symbols(c)], "<u4")
            seqs = range(0, max(1, len(s)), PIECE)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key] * len(seqs)),
                    pa.array(range(len(seqs)), pa.int32()),
                    pa.array([s[i : i + PIECE].tobytes() for i in seqs], pa.binary()),
                ],
                names=["key", "seq", "symbols"],
            )


def _encode_pieces(batches, vocabulary: str):
    enc = encoder(vocabulary)
    for b in batches:
        found = []
        for raw in b.column(2).to_pylist():
            s = np.frombuffer(raw, "<u4").tolist()
            ids = [t for run in enc._runs(s) for t in enc.tree(run)]
            found.append(np.array(ids, "<u4").tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.binary())], names=["key", "seq", "tokens"])


def _concatenate(pdf, vocabulary: str, with_ids: bool, outputs: list[str]):
    enc = encoder(vocabulary)
    parts = [np.frombuffer(t, "<u4").tolist() for t in pdf.sort_values("seq")["tokens"]]
    while len(parts) > 1:
        parts = [enc.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    ids = parts[0]
    row = _digest(np.array(ids, "<u4").tobytes(), enc.decode(ids).encode(), with_ids)
    return type(pdf)([(pdf["key"].iloc[0], *row)], columns=["key", *outputs])


def decoded(df: DataFrame, vocabulary: str, ids: str, out: str = "decoded") -> DataFrame:
    """Add the text of the token ids in ``ids`` (little-endian unsigned 32-bit integers); null gives ''."""

    @F.pandas_udf("string")
    def text_of(col):
        enc = encoder(vocabulary)
        return col.map(lambda b: enc.decode(np.frombuffer(b or b"", "<u4")))

    return df.withColumn(out, text_of(F.col(ids)))
