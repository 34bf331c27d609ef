"""Near-duplicate detection by a chosen-path set similarity join over MinHash values.

A document is a set of word shingles; documents with equal sets are one set. From the root of
each tree a set goes to the child named by two of its minwise shingles, so similar sets stay
together with a probability that is their similarity squared. Nodes that are too large to compare
branch again, each set along two more pairs of minwise shingles; the others are compared
exhaustively. With twelve trees, a pair at the threshold fails to meet at the roots' children once
in four million.

A node's comparison goes by MinHash values and is meant to be generous (five standard deviations
below the threshold): what it finds ties sets into candidate groups. Every group is then compared
once on its full sets, whatever the number of nodes in which its members met: small ones whole in a
task, large ones block against block, where only blocks of similar set sizes can hold links. A
block's intersections are products of incidence matrices, exact, and what leaves a task is a
spanning forest of its links, so a group of near copies costs no row for each of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import discard, free_name, stored

#: Trees, members of a node that are compared pair by pair, levels, and minwise values per set.
TREES, LEAF, DEPTH, VALUES = 12, 32, 4, 96
#: Members of a node that one task compares; members from which on a node branches, if it still can.
TASK, HUGE = 2_048, 32_768
#: Bytes of the sets of a block (of 4 * ROWS sets at most), and tokens of a slice of its matrix.
BLOCK_BYTES, SLICE = 16 << 20, 4_096
#: Shingles of a step and branches of a node; values that paths choose from.
STEP, BRANCHES = 2, 2
PATHS = STEP * (TREES + BRANCHES * DEPTH)
#: Words that a worker remembers; least and most bits of the filter that tells whose text is read again (16 MB).
CACHE_WORDS, FILTER_BITS = 100_000, (1 << 16, 1 << 27)
#: Rows of a batch that are worked on at once.
ROWS = 256
U = np.uint64
_RNG = np.random.default_rng(23)
_PLACES = _RNG.integers(1, 1 << 63, 64, dtype=U) | U(1)
_PERMS = _RNG.integers(1, 1 << 63, VALUES, dtype=U) * U(2) + U(1)
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


class Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def shingles(text: str | None, words: Words, n: int) -> np.ndarray:
    """Distinct hashes of the text's runs of ``n`` words, sorted; of all its words if there are fewer."""
    w = (text or "").encode().translate(_LOWER).split()
    if not w:
        return np.zeros(0, U)
    h = np.fromiter(map(words.__getitem__, w), U, len(w))
    k = min(n, len(w))
    out = np.full(len(w) - k + 1, k, U)
    for i in range(k):
        out += h[i : len(w) - k + 1 + i] * _PLACES[i]
    return np.unique(_mix(out))


def _summaries(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Per row: size of its set, the set's key, the values that paths choose from, and a byte of each value."""
    words = Words()
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            part = b.slice(at, ROWS)
            if len(words) > CACHE_WORDS:
                words.clear()
            sets = [shingles(t, words, n) for t in part.column(1).to_pylist()]
            sizes = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(sizes)
            flat = np.concatenate([sets[i] for i in some]) if len(some) else np.zeros(0, U)
            starts = (np.cumsum(sizes[some]) - sizes[some]).astype(np.int64)
            least = np.zeros((len(sets), VALUES), U)
            key = np.zeros(len(sets), U)
            if len(some):
                for j, a in enumerate(_PERMS):
                    least[some, j] = np.minimum.reduceat(flat * a, starts)
                key[some] = _mix(np.add.reduceat(_mix(flat * _PERMS[0]), starts) + sizes[some].astype(U))
            # The top bits of a minimum are all but zero; what is compared is a hash of it.
            least = _mix(least)
            paths = (least[:, :PATHS] >> U(32)).astype(np.uint32).view(np.int32)
            sig = (least & U(0xFF)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(sizes),
                    pa.array(key.view(np.int64)),
                    pa.ListArray.from_arrays(np.arange(0, paths.size + 1, PATHS, dtype=np.int32), pa.array(paths.ravel())),
                    pa.array([r.tobytes() for r in sig], pa.binary()),
                ],
                names=["id", "n", "k", "path", "sig"],
            )


def _key(s: np.ndarray) -> np.ndarray:
    return _mix(_mix(s * _PERMS[0]).sum(dtype=U) + np.array([len(s)], U))


def _sets(batches: Iterator[pa.RecordBatch], n: int, wanted) -> Iterator[pa.RecordBatch]:
    """(k, shingles) of the rows whose id is ``wanted``."""
    words = Words()
    for whole in batches:
        whole = whole.filter(pa.array(wanted(whole.column(0).to_numpy(zero_copy_only=False))))
        for b in (whole.slice(at, ROWS) for at in range(0, whole.num_rows, ROWS)):
            if len(words) > CACHE_WORDS:
                words.clear()
            rows = [shingles(t, words, n) for t in b.column(1).to_pylist()]
            keys = np.concatenate([_key(r) for r in rows]).view(np.int64)
            made = [pa.array(keys, pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(made, names=["k", "shingles"])


def _only(ids: DataFrame):
    """A test, of bounded size, that all of ``ids`` pass, and few others: no exchange of texts is needed."""
    n = ids.count()
    low, high = FILTER_BITS
    bits = min(high, max(low, 1 << (16 * n).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = _mix(b.column(0).to_numpy(zero_copy_only=False).view(U)) % U(bits)
            word, bit = (at >> U(6)).astype(np.int32), (U(1) << (at & U(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit)], names=["w", "b"])

    rows = ids.mapInArrow(places, "w int, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    made = np.zeros(bits // 64, U)
    made[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(U)
    shared = ids.sparkSession.sparkContext.broadcast(made)

    def wanted(of: np.ndarray) -> np.ndarray:
        at = _mix(of.view(U)) % U(bits)
        return (shared.value[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1) == U(1)

    return wanted


def _screen(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(-1, VALUES) for i in (2, 3))
            near = (x == y).sum(1) >= least
            yield b.select([0, 1]).filter(pa.array(near))

    return run


def _forest(linked: np.ndarray) -> np.ndarray:
    """The least index that each one is tied to by a symmetric matrix of links."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(linked)).min(1)
        new = np.minimum(label, near)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _shared(sets: list[np.ndarray], n_left: int) -> np.ndarray:
    """How many shingles each of the first ``n_left`` sets shares with each of all sets."""
    sizes = np.array([len(x) for x in sets])
    flat = np.concatenate(sets)
    _, token, often = np.unique(flat, return_inverse=True, return_counts=True)
    # Shingles of one set alone meet nothing; the others are numbered anew.
    number = np.cumsum(often > 1) - 1
    keep = often[token] > 1
    owner, token = np.repeat(np.arange(len(sets)), sizes)[keep], number[token][keep]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    out = np.zeros((n_left, len(sets)), np.float32)
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, SLICE):
        i, j = np.searchsorted(token, [low, low + SLICE])
        held = np.zeros((len(sets), min(SLICE, int(token[-1]) + 1 - low)), np.float32)
        held[owner[i:j], token[i:j] - low] = 1
        out += held[:n_left] @ held.T
    return out


def _ties(sets: list[np.ndarray], second: np.ndarray, share: int) -> np.ndarray:
    """The least index that the links of a cell tie each set to; ``second`` marks the other block's sets.

    Within one block all pairs count, between two only pairs of the one with the other.
    """
    n, n_left = len(sets), len(sets) if not second.any() else int((~second).sum())
    both = _shared(sets, n_left)
    sizes = np.array([len(x) for x in sets], np.float32)
    near = 100 * both >= share * (sizes[:n_left, None] + sizes[None, :] - both)
    linked = np.zeros((n, n), bool)
    linked[:n_left] = near
    if second.any():
        linked[:n_left, :n_left] = False
    return _forest(linked | linked.T)


def _compare(share: int):
    """Rows (cell, second, k, shingles), those of a cell together, into ties (a, b)."""

    def tied(rows: list) -> tuple[np.ndarray, np.ndarray]:
        rows.sort(key=lambda r: (r[0], r[1]))
        k = np.array([r[1] for r in rows], np.int64)
        label = _ties([r[2] for r in rows], np.array([r[0] for r in rows], bool), share)
        moved = label != np.arange(len(label))
        return k[label[moved]], k[moved]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for b in batches:
            found = []
            names, second, keys = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            for at, name in enumerate(names):
                if name != cell:
                    if len(rows) > 1:
                        found.append(tied(rows))
                    cell, rows = name, []
                # A copy, so that a batch is not held for one of its rows.
                rows.append((second[at], keys[at], np.frombuffer(b.column(3)[at].as_buffer(), U).copy()))
            if found:
                yield _pairs_of(found)
        if len(rows) > 1:
            yield _pairs_of([tied(rows)])

    return run


def _pairs_of(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[i] for f in found])) for i in (0, 1)], names=["a", "b"])


def _in_node(least: int):
    """Rows (keys, signatures) of whole nodes into ties of the pairs that MinHash values do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                k = b.column(0)[i].values.to_numpy()
                sig = np.frombuffer(b"".join(b.column(1)[i].values.to_pylist()), np.uint8).reshape(-1, VALUES)
                linked = np.zeros((len(k), len(k)), bool)
                for r in range(len(k)):
                    linked[r] = (sig == sig[r]).sum(1) >= least
                label = _forest(linked)
                moved = label != np.arange(len(label))
                yield _pairs_of([(k[label[moved]], k[moved])])

    return run


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(k, label): the least key of each key's component, over the keys that have links.

    Every key takes the least label among its own and its neighbours', then its label's label, so
    chains shorten by powers; stops when nothing changes.
    """
    both = stored(links.select(F.col(a).alias("k"), F.col(b).alias("o")).unionAll(links.select(F.col(b), F.col(a))).distinct(), "edges")
    labels = stored(both.groupBy("k").agg(F.least(F.col("k"), F.min("o")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("k", "o"), "o").groupBy("k").agg(F.min("label").alias("near"))
        step = labels.join(near, "k").select("k", F.least("label", "near").alias("mid"), F.col("label").alias("old"))
        jump = labels.select(F.col("k").alias("mid"), F.col("label").alias("far"))
        new = stored(step.join(jump, "mid").select("k", F.least("mid", "far").alias("label"), "old"), "labels")
        changed = new.filter("label <> old").limit(1).count()
        discard(labels)
        labels = new.drop("old")
        if not changed:
            discard(both)
            return labels


def candidates(reps: DataFrame, share: int) -> list[DataFrame]:
    """Stored ties (a, b) between sets that may be linked: all links are within the groups that they make."""
    spread = (share / 100 * (1 - share / 100) / VALUES) ** 0.5
    least = int(VALUES * (share / 100 - 5 * spread))
    members, ties = _children(reps.select("k", "path"), F.lit(0), 0, TREES), []
    for level in range(DEPTH + 1):
        sizes = members.groupBy("node").agg(F.count("*").alias("n"), F.min("k").alias("first")).filter("n > 1")
        members = stored(members.join(sizes, "node").select("node", "k", "n", "first"), "members")
        ties.append(stored(_in_small(members.filter(F.col("n") <= LEAF), reps, least), "ties"))
        task = members.filter((F.col("n") > LEAF) & (F.col("n") <= TASK)).join(reps.select("k", "sig"), "k")
        whole = task.groupBy("node").agg(F.collect_list("k").alias("ks"), F.collect_list("sig").alias("sigs")).select("ks", "sigs")
        ties.append(stored(whole.mapInArrow(_in_node(least), "a long, b long"), "ties"))
        # A node that is not compared here is a candidate group as a whole, unless it can branch.
        large = members.filter((F.col("n") > TASK) & (F.lit(level == DEPTH) | (F.col("n") <= HUGE)))
        ties.append(stored(large.filter("k <> first").select(F.col("first").alias("a"), F.col("k").alias("b")), "ties"))
        huge = members.filter(F.col("n") > HUGE).select("node", "k")
        if level == DEPTH or huge.isEmpty():
            discard(members)
            break
        first = STEP * (TREES + BRANCHES * level)
        deeper = stored(_children(huge.join(reps.select("k", "path"), "k"), F.col("node"), first, BRANCHES), "children")
        discard(members)
        members = deeper
    return ties


def _in_small(members: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    x, y = members.alias("x"), members.alias("y")
    pairs = x.join(y, (F.col("x.node") == F.col("y.node")) & (F.col("x.k") < F.col("y.k"))).select(F.col("x.k").alias("a"), F.col("y.k").alias("b"))
    x = reps.select(F.col("k").alias("a"), F.col("sig").alias("x"))
    y = reps.select(F.col("k").alias("b"), F.col("sig").alias("y"))
    near = pairs.distinct().join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return near.mapInArrow(_screen(least), "a long, b long")


def _cells(groups: DataFrame, share: int) -> DataFrame:
    """(cell, second, k): which comparisons a set of a group takes part in.

    A small group is one cell. A large one is cut into blocks by set size, in steps of the ratio that
    two linked sets can have at most, and by hash; a block meets those of its own step and of the next.
    """
    step = F.floor(F.log("n") / F.log(F.lit(100 / share))).cast("int")
    total = groups.groupBy("label").agg(F.count("*").alias("m"), F.sum("n").alias("tokens"))
    blocks_of = lambda m, t: F.greatest(F.ceil(m / (4 * ROWS)), F.ceil(t * 8 / BLOCK_BYTES)).cast("int")
    marked = groups.join(total, "label").withColumn("large", blocks_of(F.col("m"), F.col("tokens")) > 1)
    small = marked.filter("NOT large").select(F.col("label").cast("string").alias("cell"), F.lit(False).alias("second"), "k")
    large = marked.filter("large").select("label", "k", "n", step.alias("step"))
    steps = large.groupBy("label", "step").agg(F.count("*").alias("m"), F.sum("n").alias("t"))
    steps = stored(steps.select("label", "step", blocks_of(F.col("m"), F.col("t")).alias("blocks")), "steps")
    above = steps.select("label", (F.col("step") - 1).alias("step"), F.col("blocks").alias("above"))
    below = steps.select("label", (F.col("step") + 1).alias("step"), F.col("blocks").alias("below"))
    placed = large.join(steps, ["label", "step"]).join(above, ["label", "step"], "left").join(below, ["label", "step"], "left")
    block = F.pmod(F.xxhash64("k", "label"), F.col("blocks")).cast("int")
    name = lambda s, i, t, j: F.concat_ws(".", F.col("label").cast("string"), s, i, t, j)
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    own = F.transform(upto(F.col("blocks")), lambda j: F.struct(
        name(F.col("step"), F.least(j, F.col("block")), F.col("step"), F.greatest(j, F.col("block"))).alias("cell"), (j < F.col("block")).alias("second")))
    up = F.transform(upto(F.coalesce("above", F.lit(0))), lambda j: F.struct(name(F.col("step"), F.col("block"), F.col("step") + 1, j).alias("cell"), F.lit(False).alias("second")))
    down = F.transform(upto(F.coalesce("below", F.lit(0))), lambda j: F.struct(name(F.col("step") - 1, j, F.col("step"), F.col("block")).alias("cell"), F.lit(True).alias("second")))
    cells = placed.withColumn("block", block).select("k", F.inline(F.concat(own, up, down))).select("cell", "second", "k")
    return small.unionByName(cells)


def near_duplicates(
    df: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, share: int = 85  # noqa: A002
) -> DataFrame:
    """Add ``n_shingles``, ``component_id`` and ``kept``.

    Two rows are linked if their sets of ``words``-word shingles (A-Z in lower case; all words as
    one shingle where there are fewer) have ``share`` percent of their union in common.
    ``component_id`` is the least id that links lead to, ``kept`` says that it is the row's own.
    Rows without words have empty sets and are linked with nothing, so each is its own component.
    Rows that share an id are one document: it has their links, and its largest set is counted. A
    row with a null id takes part in nothing and is kept, with a null component. Every row and
    column stays; columns that bear an output's name are replaced; an empty table gives an empty one.
    """
    base = df.drop(*[c for c in df.columns if c.lower() in {"n_shingles", "component_id", "kept"} and c != text])
    source = base.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    kinds = "id long, n long, k long, path array<int>, sig binary"
    rows = stored(source.mapInArrow(lambda it: _summaries(it, words), kinds), "summaries")
    with_set = rows.filter("n > 0 AND id IS NOT NULL")
    reps = stored(
        with_set.groupBy("k").agg(F.min("id").alias("least"), F.first("n").alias("n"), F.first("path").alias("path"), F.first("sig").alias("sig")), "reps"
    )
    ties = candidates(reps, share)
    groups = stored(components(reduce(DataFrame.unionAll, ties)).join(reps.select("k", "n"), "k"), "groups")
    for found in ties:
        discard(found)
    # Full sets of the groups' members, made again from the text of one row of each.
    test = _only(groups.select("k").join(reps.select("k", "least"), "k").select(F.col("least").alias("id")))
    again = source.filter("id IS NOT NULL").mapInArrow(lambda it: _sets(it, words, test), "k long, shingles binary")
    # Rows that share an id may hold the same set twice, or another.
    sets = again.join(groups.select("k"), "k", "left_semi").dropDuplicates(["k"])
    cells = _cells(groups, share).join(sets, "k").select("cell", "second", "k", "shingles")
    together = cells.repartition("cell").sortWithinPartitions("cell")
    links = stored(together.mapInArrow(_compare(share), "a long, b long"), "links")
    labels = components(links)
    at = free_name(base, "llm_id")
    known = reps.join(labels, "k", "left").select("k", "least", F.coalesce("label", "k").alias("label"))
    low = known.groupBy("label").agg(F.min("least").alias("component_id"))
    least = stored(known.join(low, "label").select("k", "component_id"), "components")
    for used in (reps, groups, links, labels):
        discard(used)
    # Rows that share an id are one document.
    own = rows.select("id", "n", "k").join(least, "k", "left")
    own = own.groupBy(F.col("id").alias(at)).agg(
        F.max("n").alias("n_shingles"), F.coalesce(F.min("component_id"), F.first("id")).alias("component_id")
    )
    out = base.join(own, F.col(id).cast("long").eqNullSafe(F.col(at)), "left").drop(at)
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col(id), F.lit(True)))


def _children(members: DataFrame, node: Column, first: int, branches: int) -> DataFrame:
    """(k, node) of each branch, named by ``STEP`` values of the path from ``first`` on."""
    named = [F.xxhash64(node, F.lit(i), F.slice("path", first + i * STEP + 1, STEP)) for i in range(branches)]
    return members.select("k", F.explode(F.array(*named)).alias("node"))
