"""Spelling variants: words that one edit turns into each other, and the common form of each.

A relational trie. The words of each length, read forwards and backwards, are a trie whose edges
are rows: (node, letter, number of words below, the one word below if it is alone, letters that may
follow). States (word, position, node, edits) walk all tries level by level: a level joins the
states at that depth with the edges of that depth. A state looks for words of one length only, so
its edit is known: as long (replace), one longer (insert) or one shorter (delete).

An edit lies in the second half of a word or, read backwards, in the second half of the reversed
word. Walks therefore begin at the middle, with the exact half as their node, where a trie branches
little. A state ends where the edge has a single word below: the rest of both words decides. The
trie has no edges that nobody can reach: none above the middle of its words, none below a node
with one word. Nothing is collected; the depth of the deepest branching node bounds the levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import discard, stored

#: Maximal runs of these characters are words.
RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(word: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` does the same, faster, where all is ASCII."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def _misspelt(word: Column, h: Column, every: int) -> Column:
    at = (h % F.length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % every == 0, cut).otherwise(word)


def word_counts(
    df: DataFrame, text: str = "text", noise: str | None = None, every: int = 97, least_length: int = 5, least: int = 3
) -> DataFrame:
    """``word`` and ``n`` (occurrences) of the words with ``least_length`` code points and ``least`` occurrences.

    Words are maximal runs of :data:`RUN` with A-Z lower-cased. With ``noise``, a column, every run
    whose crc32 of ``<noise>:<run>`` is divisible by ``every`` loses one code point (a null counts as
    an empty text). A null or empty text has no words; equal rows count as often as they stand.
    """
    source = F.lit("") if noise is None else F.coalesce(F.col(noise).cast("string"), F.lit(""))
    runs = df.select(source.alias("source"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("run"))
    words = runs.filter(F.length("run") >= least_length).select("source", _lowered(F.col("run")).alias("word"))
    if noise is not None:
        h = F.crc32(F.concat("source", F.lit(":"), "word"))
        words = words.withColumn("word", _misspelt(F.col("word"), h, every)).filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _bit(letter: Column) -> Column:
    """One of 64 bits for a letter: enough to say which letters cannot follow."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(letter) % 64)


def _both_ways(words: DataFrame) -> DataFrame:
    two = F.array(
        F.struct(F.lit(True).alias("forward"), F.col("word").alias("w")),
        F.struct(F.lit(False).alias("forward"), F.reverse("word").alias("w")),
    )
    return words.select(F.inline(two))


def _trie(words: DataFrame) -> DataFrame:
    """Adjacency rows (forward, size, depth, node, edges) of the nodes with at least two words below."""
    size = F.length("w")
    # The shortest exact half of a word that can look for this one.
    top = F.least(F.when(F.col("forward"), F.floor((size - 1) / 2)).otherwise(F.floor(size / 2)).cast("int"), F.greatest(size - 2, F.lit(0)))
    rows = _both_ways(words).select("forward", "w", size.alias("size"), F.explode(F.sequence(top, size - 1)).alias("depth"))
    letter = F.substring("w", F.col("depth") + 1, F.lit(1))
    after = F.substring("w", F.col("depth") + 2, F.lit(1))
    edges = (
        rows.select("forward", "size", "depth", F.substring("w", F.lit(1), F.col("depth")).alias("node"), letter.alias("letter"),
                    _bit(after).alias("bit"), F.substring("w", F.col("depth") + 2, F.col("size")).alias("tail"))
        .groupBy("forward", "size", "depth", "node", "letter")
        .agg(F.count("*").alias("below"), F.min("tail").alias("tail"), F.bit_or("bit").alias("next"))
    )
    edge = F.struct("letter", "below", F.when(F.col("below") == 1, F.col("tail")).alias("tail"), "next")
    nodes = edges.groupBy("forward", "size", "depth", "node").agg(F.collect_list(edge).alias("edges"), F.sum("below").alias("words"))
    # At most one edge for each letter, so a node's row is bounded by the alphabet. Walks begin at
    # the half of a word that is at most one longer, and never go on below a node with one word.
    return nodes.filter("words >= 2 OR depth <= ceil((size + 1) / 2)").drop("words")


def _starts(words: DataFrame) -> DataFrame:
    """The states of every word at its middle: one for each length that a near word may have."""
    size = F.length("w")
    middle = F.floor(size / 2).cast("int")
    states = _both_ways(words).select("forward", "w", F.explode(F.array(*[size + k for k in (-1, 0, 1)])).alias("size"))
    # A walk needs an edge to end on: in words of two or three code points it begins before the middle.
    pos = F.least(F.when(F.col("forward"), middle).otherwise(size - middle), F.col("size") - 1)
    return states.filter("size > 0").select(
        "*", pos.alias("pos"), F.substring("w", F.lit(1), pos).alias("node"), F.lit(0).alias("edits"), pos.alias("depth")
    )


def _step(states: DataFrame, nodes: DataFrame) -> DataFrame:
    """What the states of one depth become along the edges of that depth; ``near`` is set where a walk ends."""
    at = states.join(nodes.drop("depth"), ["forward", "size", "node"]).select("*", F.inline("edges")).drop("edges")
    kind = F.col("size") - F.length("w")
    x, y = (F.substring("w", F.col("pos") + i, F.lit(1)) for i in (1, 2))
    same, letter = F.col("letter") == x, F.col("letter")
    # An inserted or deleted letter differs from the one after it: of a run, the last one is meant.
    at = at.select(
        "forward", "w", "size", F.concat("node", "letter").alias("node"), "below", "tail", "next",
        F.when(same, F.col("pos") + 1)
        .when((F.col("edits") == 0) & (kind == 0), F.col("pos") + 1)
        .when((F.col("edits") == 0) & (kind == 1), F.col("pos"))
        .when((F.col("edits") == 0) & (kind == -1) & (letter == y), F.col("pos") + 2)
        .alias("pos"),
        F.when(same, F.col("edits")).otherwise(1).alias("edits"),
    ).filter("pos IS NOT NULL")
    rest = F.substring("w", F.col("pos") + 1, F.length("w"))
    alone = F.col("below") == 1
    # A lone word below an exact path is the word itself or decides by the one edit that is left.
    ends = F.when(F.col("edits") == 1, rest == F.col("tail")).otherwise((kind != 0) & (F.levenshtein(rest, F.col("tail"), 1) == 1))
    follows = (F.col("edits") == 0) | (F.col("next").bitwiseAND(_bit(F.substring("w", F.col("pos") + 1, F.lit(1)))) != 0)
    word = F.concat("node", "tail")
    return at.filter(F.when(alone, ends).otherwise(follows)).select(
        "forward", "w", "size", "pos", "node", "edits", F.when(alone, word).alias("near")
    )


def near_words(words: DataFrame, word: str = "word") -> DataFrame:
    """Pairs (``word``, ``near``), both ways, of the distinct words that exactly one edit tells apart.

    An edit inserts, deletes or replaces one code point. Nulls and the empty word are left out and
    repeats count once; a word is never near itself; an empty table gives an empty one.
    """
    words = stored(words.select(F.col(word).alias("word")).filter("word <> ''").distinct(), "variant-words")
    trie = stored(_trie(words), "variant-trie")
    starts = stored(_starts(words), "variant-starts")
    bounds = trie.agg(F.min("depth"), F.max("depth")).first()
    levels, left = [], None
    for depth in range(bounds[0] or 0, (bounds[1] if bounds[1] is not None else -1) + 1):
        states = starts.filter(F.col("depth") == depth).drop("depth")
        if left is not None:
            states = states.unionByName(left)
        level = stored(_step(states, trie.filter(F.col("depth") == depth)), f"variant-level-{depth}")
        levels.append(level)
        left = level.filter("near IS NULL").drop("near")
    pairs = words.select("word", F.col("word").alias("near")).limit(0)
    for level in levels:
        way = lambda c: F.when(F.col("forward"), F.col(c)).otherwise(F.reverse(c))
        pairs = pairs.unionByName(level.filter("near IS NOT NULL").select(way("w").alias("word"), way("near").alias("near")))
    pairs = stored(pairs.distinct(), "variant-pairs")
    for used in (words, trie, starts, *levels):
        discard(used)
    return pairs


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its chain of forms. Chains double their stride each round."""
    roots = stored(forms.select("word", F.coalesce("form", "word").alias("root")), "variant-roots")
    while True:
        ends = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = stored(roots.join(ends, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "variant-roots")
        discard(roots)
        roots = ahead.drop("moved")
        if ahead.filter("moved").isEmpty():
            return roots


def grouped(counts: DataFrame, ratio: int = 2) -> DataFrame:
    """For each row of ``counts`` (``word``, ``n``): ``form``, ``root``, ``n_near`` and ``form_n``.

    The form is the near word of largest ``n`` (ties: the least in code-point order) if it has
    ``ratio`` times the word's ``n``, else null; the root is where the forms lead, the word itself
    without one. ``ratio`` is at least 2, so that no chain of forms returns. Words are distinct.
    """
    counts = stored(counts.select("word", "n"), "variant-counts")
    pairs = near_words(counts)
    of_near = counts.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (
        pairs.join(of_near, "near")
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form"))).alias("best"))
    )
    wins = -F.col("best.minus") >= ratio * F.col("n")
    forms = stored(
        counts.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(wins, F.col("best.form")).alias("form"), F.when(wins, -F.col("best.minus")).alias("form_n"),
        ),
        "variant-forms",
    )
    discard(pairs)
    discard(counts)
    return forms.join(_roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
