"""The closest name of every name by edit score, as an incremental top-1 similarity join.

The right names, dealt to blocks by their order, are read as a trie: what many names begin with is
compared once. A row of the edit distance's table goes down the trie for each left name and stops where no
name below can be within the edits that are still asked about: what the row has cost so far, and at least as
many edits as the letters left over on the two sides differ by. The number of edits asked about rises by one
until a name is found, so a name that resembles another looks at the few branches that resemble it. Each task
gets one block and one chunk of left names, both of bounded size. With several blocks the score falls in
steps, and only names that no block has answered go on. Nothing is cut off by a floor: where nothing bears a
resemblance, the last edits asked about reach every name.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.session import discard, materialise

EPS = 1e-9
#: Letters of right names in a block and left names in a chunk: what one task holds.
BLOCK, CHUNK = 1_000_000, 16_384
#: Scores down to which the blocks are searched, one after the other, lest a block goes on for names that another has
#: answered. A single block needs only the last.
STEPS = tuple(1 - i / 20 for i in range(1, 21))


def edit_score(a: str | Column, b: str | Column) -> Column:
    """1 minus edit distance over the longer length; two empty names are equal."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(longest, F.lit(1))


def _searcher(high: float, low: float, strict_from: float):
    """A function of a chunk and a block: of every left name the closest right names that score ``low`` or more.

    None score ``high`` or more. Below ``strict_from`` one of equally close names is enough.
    """
    # Local functions travel to the workers whole, so they need no copy of this package.
    import numpy as np
    import pyarrow as pa

    # Cells of a table and left names that are walked with at a time.
    cells, most = 2_000_000, 4096

    def spelled(names):
        """Code points of all names on end, where each begins and its length."""
        length = np.array([len(x) for x in names], dtype=np.int64)
        codes = np.frombuffer("".join(names).encode("utf-32-le"), dtype=np.uint32)
        return codes, np.cumsum(length) - length, length

    def grown(names):
        """The trie of sorted, distinct names by depth: of each node its letter, the least and greatest length below,
        the name that ends there (or -1) and where the children of the nodes one level up begin."""
        codes, start, length = spelled(names)
        levels, alive, node, above, depth = [], np.arange(len(names)), np.zeros(len(names), dtype=np.int64), 1, 0
        while True:
            on = length[alive] > depth
            alive, node = alive[on], node[on]
            if not len(alive):
                return levels
            letter = codes[start[alive] + depth]
            new = np.append(True, (node[1:] != node[:-1]) | (letter[1:] != letter[:-1]))
            first, depth, below = np.flatnonzero(new), depth + 1, length[alive]
            children = np.append(0, np.cumsum(np.bincount(node[first], minlength=above)))
            ends = np.where(below[first] == depth, alive[first], -1)
            levels.append((children, letter[first] + 1, np.minimum.reduceat(below, first), np.maximum.reduceat(below, first), ends))
            node, above = np.cumsum(new) - 1, len(first)

    def walked(levels, spelling, la, share):
        """(left, right, edits, longer length) of all pairs with at most ``share`` of the longer length as edits.

        ``spelling`` has a column for each left name, ``la`` its length.
        """
        kind, beyond = (np.int16, 15_000) if max(len(spelling), len(levels)) < 5_000 else (np.int32, 2**30)
        allowed = lambda q, lb: np.floor(share[q] * np.maximum(la[q], lb) + EPS).astype(kind)
        none = np.zeros(len(la), dtype=np.int64)
        table = np.repeat(np.arange(len(spelling) + 1, dtype=kind)[:, None], len(la), axis=1)
        stack, found = [(0, np.arange(len(la)), none, table)], []
        while stack:
            depth, q, node, table = stack.pop()
            children, letters, shortest, longest, ends = levels[depth]
            count = children[node + 1] - children[node]
            if len(q) > 1 and count.sum() * len(table) > cells:
                half = len(q) // 2
                stack += [(depth, q[s], node[s], table[:, s]) for s in (slice(half), slice(half, None))]
                continue
            at = np.repeat(np.arange(len(q)), count)
            child = np.arange(len(at)) - np.repeat(np.cumsum(count) - count - children[node], count)
            # What even the nearest length below costs is known before a row is made.
            q, depth = q[at], depth + 1
            lengths = la[q].astype(kind)
            short, long = shortest[child].astype(kind), longest[child].astype(kind)
            limit = allowed(q, long)
            on = np.flatnonzero(np.maximum(lengths - long, short - lengths) <= limit)
            if not len(on):
                continue
            at, child, q, lengths, short, long, limit = (x[on] for x in (at, child, q, lengths, short, long, limit))
            letter, reach = letters[child], int(limit.max())
            row, bound = np.full((len(table), len(q)), beyond, dtype=kind), np.full(len(q), beyond, dtype=kind)
            # Cells further off the diagonal than the edits asked about cost more than these.
            begin, end = max(0, depth - reach), min(len(table) - 1, depth + reach)
            corner = table[begin - 1][at] if begin else None
            for i in range(begin, end + 1):
                if i == 0:
                    cell = np.full(len(q), depth, dtype=kind)
                else:
                    cell = corner + (spelling[i - 1][q] != letter)
                if i or begin:
                    over = table[i][at]
                    np.minimum(cell, over + kind(1), out=cell)
                    if i > begin:
                        np.minimum(cell, row[i - 1] + kind(1), out=cell)
                    corner = over
                else:
                    corner = table[0][at]
                row[i] = cell
                rest = lengths - kind(i)
                least = cell + np.maximum(np.maximum(rest - (long - kind(depth)), short - kind(depth) - rest), 0)
                np.minimum(bound, np.where(rest < 0, kind(beyond), least), out=bound)
            last = np.flatnonzero(ends[child] >= 0)
            if len(last):
                edits, longer = row[lengths[last], last], np.maximum(lengths[last], kind(depth))
                # With every letter another a pair has nothing in common.
                near = (edits <= allowed(q[last], depth)) & (edits < longer)
                found.append((q[last][near], ends[child[last][near]], edits[near], longer[near]))
            if depth < len(levels):
                on = np.flatnonzero((bound <= limit) & (long > depth))
                if len(on):
                    stack.append((depth, q[on], child[on], row[:, on]))
        return [np.concatenate(x).astype(np.int64) for x in zip(*found)] if found else [none[:0]] * 4

    def closest_of(lefts, levels):
        """(left, right) of the closest pairs, for left names in order of their length."""
        codes, start, la = spelled(lefts)
        spelling = np.zeros((max(int(la.max()), 1), len(lefts)), dtype=np.uint32)
        for i in range(int(la.max())):
            here = np.flatnonzero(la > i)
            # A letter no name has stands past the end.
            spelling[i, here] = codes[start[here] + i] + 1
        asked, pairs = np.arange(len(lefts)), []
        edits = np.maximum(np.floor((1.0 - high) * la + EPS), 0)
        while len(asked):
            edits[asked] += 1
            share = np.minimum(edits / np.maximum(la, 1), 1.0 - low)
            q, r, cost, longer = walked(levels, spelling[:, asked], la[asked], share[asked])
            if len(q):
                worst = cost / longer
                best = np.full(len(asked), np.inf)
                np.minimum.at(best, q, worst)
                tied = worst <= best[q] + EPS / 2
                q, r, worst = q[tied], r[tied], worst[tied]
                order = np.lexsort((r, q))
                q, r, worst = q[order], r[order], worst[order]
                one = np.append(True, q[1:] != q[:-1]) | (1.0 - worst >= strict_from - EPS)
                pairs.append((asked[q[one]], r[one]))
            open_ = np.ones(len(asked), dtype=bool)
            open_[q] = False
            asked = asked[open_ & (share[asked] < 1.0 - low)]
        return pairs

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        lefts = sorted(left["norm"].to_pylist(), key=lambda x: (len(x), x))
        rights = sorted(right["r_norm"].to_pylist())
        got: list[tuple] = []
        if lefts and rights:
            if not rights[0]:
                got += [(x, "") for x in lefts if not x]
                lefts, rights = [x for x in lefts if x], rights[1:]
            levels = grown(rights) if rights else []
            for i in range(0, len(lefts) if levels else 0, most):
                some = lefts[i : i + most]
                for q, r in closest_of(some, levels):
                    got += [(some[a], rights[b]) for a, b in zip(q.tolist(), r.tolist())]
        texts = pa.schema([("norm", pa.string()), ("r_norm", pa.string())])
        return pa.table({"norm": [x for x, _ in got], "r_norm": [x for _, x in got]}, schema=texts)

    return search


def _candidates(waiting: DataFrame, known: DataFrame, blocks: int, high: float, low: float, strict_from: float) -> DataFrame:
    """Of every open name the closest pairs in each block, as far as they score ``low`` or more; none scores ``high``."""
    names, cores = waiting.count(), waiting.sparkSession.sparkContext.defaultParallelism
    # A chunk is small enough for a task, and every core gets a dozen, as names differ in what they cost.
    chunks = max(ceil(names / CHUNK), min(ceil(names / 256), ceil(12 * cores / blocks)), 1)
    keys, parts = ["block", "chunk"], 2 * blocks * chunks
    chunk = F.pmod(F.xxhash64("norm"), F.lit(chunks)).cast("int").alias("chunk")
    asked = waiting.select("norm", chunk, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    held = known.select("r_norm", "block", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    dealt = [x.repartition(parts, *keys).groupBy(*keys) for x in (asked, held)]
    return dealt[0].cogroup(dealt[1]).applyInArrow(_searcher(high, low, strict_from), "norm string, r_norm string")


def _dealt(rights: DataFrame) -> tuple[DataFrame, int]:
    """The right names with ``block``, of bounded letters, by their order: names that begin alike lie together."""
    names = rights.select("r_norm", "right_id", "right_name").filter("r_norm IS NOT NULL")
    stored = materialise(names, "closest-names")
    letters = stored.agg(F.coalesce(F.sum(F.length("r_norm")), F.lit(0))).first()[0]
    blocks = max(ceil(letters / BLOCK), 1)
    if blocks == 1:
        return stored.withColumn("block", F.lit(0)), 1
    known = materialise(stored.repartitionByRange(blocks, "r_norm").withColumn("block", F.spark_partition_id()), "closest-right")
    discard(stored)
    return known, blocks


def _scored(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The best pair of every name, the least right id first among equals."""
    entry = F.struct((-F.col("score")).alias("minus"), "right_id", "right_name")
    scored = pairs.withColumn("score", edit_score("norm", "r_norm"))
    best = scored.join(known.drop("block"), "r_norm").groupBy("norm").agg(F.min(entry).alias("b"))
    return best.select("norm", (-F.col("b.minus")).alias("score"), "b.right_id", "b.right_name")


def closest(lefts: DataFrame, rights: DataFrame, strict_from: float = 0.0) -> DataFrame:
    """``norm``, ``score``, ``right_id`` and ``right_name`` of the closest right name of every left name.

    ``lefts`` has names ``norm``; ``rights`` has distinct names ``r_norm`` with ``right_id`` and
    ``right_name``. Of equally close names the least ``right_id`` is taken where the score reaches
    ``strict_from``; below it only the score is promised. A name without a letter in common with any
    other has the score 0 and no right side. Each step's answers are written once, and only the names
    that it leaves open go on.
    """
    names = materialise(lefts.select("norm").filter("norm IS NOT NULL").distinct(), "closest-left")
    known, blocks = _dealt(rights)
    done, waiting, used, high = [], names, [names, known], 1.0 + EPS
    for low in STEPS if blocks > 1 else STEPS[-1:]:
        found = materialise(_scored(_candidates(waiting, known, blocks, high, low, strict_from), known), "closest-found")
        done.append(found)
        waiting = materialise(waiting.join(found.select("norm"), "norm", "left_anti"), "closest-open")
        used.append(waiting)
        high = low
        if waiting.isEmpty():
            break
    nothing = [F.lit(None).cast(known.schema[c].dataType).alias(c) for c in ("right_id", "right_name")]
    # What is left has no letter in common with any name; these rows are read lazily and stay.
    done.append(used.pop().select("norm", F.lit(0.0).alias("score"), *nothing))
    for frame in used:
        discard(frame)
    out = done[0]
    for frame in done[1:]:
        out = out.unionByName(frame)
    return out
