"""Toxicity by a linear-chain conditional random field over words.

Two states (clean, toxic) along each line of a text. What a word says about the state comes from
hashed features of its letters (whole word, prefixes, suffix), so unseen forms of a known stem
are recognised; transitions come from the labelled chains. Forward-backward marginals give the
offending offsets, and a logistic curve over the strongest marginal and the expected number of
toxic words gives the document's score.

Labels exist for documents, not for words. Words are labelled from them: a word is toxic where
the documents that hold it are toxic far more often than chance.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, free_name, stored

#: Buckets of hashed features; words a worker remembers; bytes of text that are tagged at once.
BUCKETS, CACHE_WORDS, BYTES = 1 << 18, 400_000, 4 << 20
#: Words of a piece: the field is fitted on pieces of lines; lines are tagged whole, their pieces side by side.
PIECE = 128
#: Labelled documents that a model is fitted on, at most, of each class.
SAMPLE = 3_000
LETTERS = re.compile(r"[^\W\d_]+")
#: A word as str.split() sees it.
WORD = re.compile(r"\S+")
RATIO = 1e12


def features(chunk: str) -> list[int]:
    """Buckets of a blank-separated word: its letters, their beginnings and their end."""
    w = "".join(LETTERS.findall(chunk.lower()))
    if not w:
        return [0]
    parts = {"w" + w, *("p" + w[:n] for n in (3, 4, 5, 6)), "s" + w[-4:]}
    return [zlib.crc32(p.encode()) % BUCKETS for p in parts]


class Scores(dict):
    """Emission odds by word, worked out on first sight."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights, bias

    def __missing__(self, chunk: str) -> float:
        x = float(self.weights[features(chunk)].sum()) + self.bias
        odds = float(np.exp(np.clip(x, -25, 25)))
        if len(chunk) <= 64:
            self[chunk] = odds
        return odds


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    #: exp of the transition scores, [from, to].
    moves: np.ndarray
    #: Logistic curve over (log odds of the strongest marginal, log of the expected count, 1).
    curve: np.ndarray

    def score(self, summary: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summary @ self.curve, -40, 40)))


def forward_backward(odds: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages, as odds, for each word of the chains laid end to end.

    A message is a ratio of two linear forms of the one before it, so a piece of a chain acts on what
    enters it as a matrix. Long chains are cut into pieces whose matrices are worked out side by
    side; messages then step from piece to piece, and within all pieces at once.
    """
    if not len(odds):
        return odds, odds
    (a, b), (c, d) = moves
    n = -(-lengths // PIECE)
    first = np.cumsum(n) - n
    place = np.arange(n.sum()) - np.repeat(first, n)
    start = np.repeat(np.cumsum(lengths) - lengths, n) + place * PIECE
    size = np.minimum(PIECE, np.repeat(lengths, n) - place * PIECE)
    # Forward, the two states become (a u + c v, o (b u + d v)); the odds are v / u.
    fwd = _messages(odds, start, size, place, np.repeat(n, n), (a, c, b, d), False)
    # Backward, (a u + b o v, c u + d o v): the same with what a word brings moved one word on.
    shifted = np.append(odds[1:], 1.0)
    back = _messages(shifted, start, size, np.repeat(n, n) - 1 - place, np.repeat(n, n), (a, b, c, d), True)
    return fwd, back


def _messages(
    odds: np.ndarray, start: np.ndarray, size: np.ndarray, place: np.ndarray, count: np.ndarray, form: tuple, backward: bool
) -> np.ndarray:
    """Messages of all words; ``place`` numbers a chain's pieces in the direction of travel."""
    p, q, r, s = form
    end = start + size - 1

    def word(i: np.ndarray, t: int) -> np.ndarray:
        return end[i] - t if backward else start[i] + t

    def step(u, v, o):
        """One word on; forward its odds weigh what leaves, backward what enters."""
        return (p * u + q * o * v, r * u + s * o * v) if backward else (p * u + q * v, o * (r * u + s * v))

    out = np.empty_like(odds)
    by_size = np.argsort(-size, kind="stable")
    entering = np.ones(len(start))
    if len(count) and count.max() > 1:
        # Matrices of the pieces that another one enters and leaves, as what becomes of (1, 0) and (0, 1).
        inner = by_size[(place[by_size] > 0) & (place[by_size] < count[by_size] - 1)]
        u0, v0 = np.ones(len(inner)), np.zeros(len(inner))
        u1, v1 = np.zeros(len(inner)), np.ones(len(inner))
        for t in range(PIECE if len(inner) else 0):
            live = int(np.searchsorted(-size[inner], -(t + 1), "right"))
            if not live:
                break
            o = odds[word(inner[:live], t)]
            u0[:live], v0[:live] = step(u0[:live], v0[:live], o)
            u1[:live], v1[:live] = step(u1[:live], v1[:live], o)
            scale = 1 / np.maximum(np.maximum(u0[:live], v0[:live]), np.maximum(u1[:live], v1[:live]))
            for x in (u0, v0, u1, v1):
                x[:live] *= scale
        matrix = np.zeros((len(start), 4))
        matrix[inner] = np.stack([u0, v0, u1, v1], 1)
        _run(out, odds, by_size[place[by_size] == 0], size, entering, word, step, backward)
        toward = -1 if backward else 1
        at = np.flatnonzero((place == 0) & (count > 1))
        message = out[start[at] if backward else end[at]]
        k = 1
        while len(at):
            at = at + toward
            entering[at] = message
            on = count[at] > k + 1
            at, message = at[on], message[on]
            m = matrix[at]
            message = np.minimum((m[:, 1] + m[:, 3] * message) / np.maximum(m[:, 0] + m[:, 2] * message, 1e-300), RATIO)
            k += 1
    _run(out, odds, by_size, size, entering, word, step, backward, place)
    return out


def _run(out, odds, pieces, size, entering, word, step, backward, place=None) -> None:
    """Messages within pieces, all side by side, from what enters them; a chain's first word has no past."""
    message = entering[pieces].copy()
    begins = np.ones(len(pieces), bool) if place is None else place[pieces] == 0
    sizes = size[pieces]
    for t in range(int(sizes[0]) if len(pieces) else 0):
        live = int(np.searchsorted(-sizes, -(t + 1), "right"))
        i = word(pieces[:live], t)
        u, v = step(1.0, message[:live], odds[i])
        new = np.minimum(v / u, RATIO)
        if t == 0:
            new = np.where(begins[:live], 1.0 if backward else np.minimum(odds[i], RATIO), new)
        message[:live] = new
        out[i] = new


def marginals(odds: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Odds of the toxic state for each word."""
    fwd, back = forward_backward(odds, lengths, moves)
    return np.minimum(fwd * back, RATIO)


def chains(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All words, the lengths of the chains (a line each), and the number of words of each text."""
    words, lengths, counts = [], [], []
    for text in texts:
        before = len(words)
        for line in (text or "").split("\n"):
            w = line.split()
            words += w
            if w:
                lengths.append(len(w))
        counts.append(len(words) - before)
    return words, np.array(lengths, np.int64), np.array(counts, np.int64)


def summaries(odds: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text: log odds of its strongest marginal, log of its expected toxic words, 1."""
    top, total = np.full(len(counts), 1e-9), np.zeros(len(counts))
    some = counts > 0
    if some.any():
        starts = (np.cumsum(counts) - counts)[some]
        p = odds / (1 + odds)
        top[some], total[some] = np.maximum.reduceat(odds, starts), np.add.reduceat(np.where(p > 0.05, p, 0), starts)
    return np.stack([np.log(np.clip(top, 1e-9, RATIO)), np.log(total + 0.01), np.ones(len(counts))], 1)


# -- fitting --------------------------------------------------------------------------


def toxic_words(examples: DataFrame, least: int = 3, sigmas: float = 7.5) -> set[str]:
    """Words that stand in toxic documents ``sigmas`` deviations more often than by chance.

    Near copies count as one document, or else all words of a copied toxic text would be toxic.

    ``examples`` has ``text`` and ``toxic``. The counts of all its words are made by Spark; what
    comes back is the words that pass, which are few by the test itself.
    """
    examples = one_of_copies(examples)
    total = examples.agg(F.count("*"), F.sum("toxic")).first()
    if not total[0] or not total[1] or total[0] == total[1]:
        return set()
    share = total[1] / total[0]
    letters = F.split(F.regexp_replace(F.lower("text"), r"[^\p{L}]+", " "), " ")
    words = examples.select(F.explode(F.array_distinct(letters)).alias("word"), "toxic")
    counts = words.groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("yes"))
    beyond = (F.col("yes") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share)))
    return {r[0] for r in counts.filter((F.col("yes") >= least) & (beyond >= sigmas) & (F.col("word") != "")).collect()}


def one_of_copies(examples: DataFrame, rounds: int = 3) -> DataFrame:
    """One of each set of labelled texts that share the least hash of their three-word sequences, repeatedly."""
    mixers = np.random.default_rng(5).integers(1, 1 << 63, rounds, dtype=np.uint64) | np.uint64(1)

    def least(texts: pd.Series) -> pd.Series:
        def of(text: str) -> list[int]:
            w = text.lower().split()
            runs = [zlib.crc32(" ".join(w[i : i + 3]).encode()) for i in range(max(1, len(w) - 2))]
            h = (np.array(runs, np.uint64)[:, None] * mixers) >> np.uint64(20)
            return h.min(0).astype(np.int64).tolist()

        return texts.map(of)

    out = examples.withColumn("llm_least", F.pandas_udf(least, "array<long>")("text"))
    for n in range(rounds):
        out = out.withColumn("llm_key", F.col("llm_least")[n]).dropDuplicates(["llm_key", "toxic"])
    return out.drop("llm_least", "llm_key")


def fit(texts: list[str], toxic: np.ndarray, bad: set[str], rounds: int = 12, rate: float = 0.3) -> Model:
    """Conditional maximum likelihood over the lines, by adaptive gradient steps; ``bad`` are the toxic words."""
    model = Model(np.zeros(BUCKETS), -5.0, np.exp(np.array([[1.0, -1.0], [0.0, 0.0]])), np.array([0.0, 0.0, -3.0]))
    if not len(texts) or not bad:
        return model
    # Words become numbers text by text, so that the driver never holds them all as strings.
    forms: dict[str, int] = {}
    parts, pieces, counts = [], [], []
    for text in texts:
        words, lines, n = chains([text])
        parts.append(np.fromiter((forms.setdefault(w, len(forms)) for w in words), np.int32, len(words)))
        pieces += [min(PIECE, size - at) for size in lines.tolist() for at in range(0, size, PIECE)]
        counts.append(len(words))
    ids, lengths, counts = np.concatenate(parts), np.array(pieces, np.int64), np.array(counts, np.int64)
    if not len(ids):
        return model
    sizes, cols = np.zeros(len(forms), np.int32), []
    bad_form = np.zeros(len(forms), np.float32)
    for i, w in enumerate(forms):
        own = np.array(features(w), np.int32)
        sizes[i] = len(own)
        cols.append(own)
        bad_form[i] = any(x in bad for x in LETTERS.findall(w.lower()))
    n_forms, cols = len(forms), np.concatenate(cols)
    rows = np.repeat(np.arange(n_forms, dtype=np.int32), sizes)
    forms.clear()
    label = bad_form[ids]
    # Lines with a labelled word, and four times as many without.
    ends = np.cumsum(lengths)
    hit = np.add.reduceat(label, ends - lengths) > 0
    rng = np.random.default_rng(1)
    rest = np.flatnonzero(~hit)
    chosen = np.sort(np.concatenate([np.flatnonzero(hit), rng.permutation(rest)[: 4 * hit.sum() + 100]]))
    pick = np.concatenate([np.arange(ends[i] - lengths[i], ends[i]) for i in chosen])
    lens, x, y = lengths[chosen], ids[pick], label[pick].astype(float)
    del label, pick
    w, trans, bias = model.weights, np.log(model.moves), model.bias
    sw, st, sb = np.full(BUCKETS, 1e-3), np.full((2, 2), 1e-3), 1e-3
    inner = np.ones(len(x), bool)
    inner[np.cumsum(lens) - lens] = False
    prev = np.flatnonzero(inner) - 1
    for _ in range(rounds):
        emit = np.bincount(rows, w[cols], n_forms) + bias
        odds = np.exp(np.clip(emit, -25, 25))[x]
        moves = np.exp(trans)
        fwd, back = forward_backward(odds, lens, moves)
        post = np.minimum(fwd * back, RATIO)
        p = post / (1 + post)
        err = np.bincount(x, y - p, n_forms)
        g = np.bincount(cols, err[rows], BUCKETS) - 1e-3 * w
        sw += g * g
        w = w + rate * g / np.sqrt(sw)
        sb += (err.sum()) ** 2
        bias += rate * err.sum() / np.sqrt(sb)
        # Transitions: observed minus expected.
        obs = np.array([[((1 - y[prev]) * (1 - y[prev + 1])).sum(), ((1 - y[prev]) * y[prev + 1]).sum()],
                        [(y[prev] * (1 - y[prev + 1])).sum(), (y[prev] * y[prev + 1]).sum()]])
        gt = obs - pair_marginals(fwd, back, odds, moves, prev) - 1e-2 * trans
        st += gt * gt
        trans = trans + rate * gt / np.sqrt(st)
    model = Model(w.astype(np.float32), float(bias), np.exp(trans), model.curve)
    emit = np.bincount(rows, model.weights[cols], n_forms) + model.bias
    odds = np.exp(np.clip(emit, -25, 25))
    return Model(model.weights, model.bias, model.moves, _curve(_summaries_of(texts, ids, counts, odds, model.moves), toxic))


def _summaries_of(texts: list[str], ids: np.ndarray, counts: np.ndarray, odds: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Summaries of the examples, whose lines are now whole, a slice of texts at a time."""
    out, start, word = [], 0, 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= BYTES):
            size += len(texts[stop])
            stop += 1
        n = int(counts[start:stop].sum())
        lines = np.array([len(w) for t in texts[start:stop] for line in t.split("\n") if (w := line.split())], np.int64)
        out.append(summaries(marginals(odds[ids[word : word + n]], lines, moves), counts[start:stop]))
        start, word = stop, word + n
    return np.concatenate(out)


def pair_marginals(fwd: np.ndarray, back: np.ndarray, odds: np.ndarray, moves: np.ndarray, prev: np.ndarray) -> np.ndarray:
    """Expected number of each transition between the words ``prev`` and ``prev + 1``."""
    (a, b), (c, d) = moves
    r, e = fwd[prev], odds[prev + 1] * back[prev + 1]
    z = a + b * e + r * (c + d * e)
    return np.array([[(a / z).sum(), (b * e / z).sum()], [(r * c / z).sum(), (r * d * e / z).sum()]])


def _curve(x: np.ndarray, y: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Logistic regression by Newton steps; more evidence never lowers a score."""
    beta = np.array([0.1, 0.1, -1.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(3) * 0.5
        beta = beta + np.clip(np.linalg.solve(h, x.T @ (y - p) - 0.5 * beta), -1, 1)
        beta[:2] = np.maximum(beta[:2], 0.01)
    return beta


def learned(docs: DataFrame, labels: DataFrame, fold: int = 1, folds: int = 3, sample: int = SAMPLE) -> Model:
    """Fit on labelled documents whose crc32 of the id (as text) modulo ``folds`` is not ``fold``.

    ``sample`` bounds what is learned from: words are counted in the four times ``sample``
    documents whose ids hash lowest, and the field is fitted on ``sample`` of these at most, half
    of them toxic. All documents are scored. Rows without id, text or label are no examples.
    """
    known = labels.select("doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IN (0, 1)").distinct()
    known = known.filter(F.crc32(F.col("doc_id").cast("string")) % folds != fold)
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(4 * sample)
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    examples = stored(texts.join(F.broadcast(some), "doc_id"), "toxic-examples")
    bad = toxic_words(examples)
    rows = []
    for kind in (1, 0):
        rows += examples.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "text").limit(sample // 2).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    discard(examples)
    return fit([r["text"] for r in rows], np.array([r["toxic"] for r in rows], int), bad)


# -- scoring --------------------------------------------------------------------------


def scored(df: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Add ``score`` (0 to 1), ``predicted`` (score at or over ``threshold``) and ``spans``.

    ``spans`` holds character offsets (start, end) and the marginal of each word that is more
    likely toxic than not. A null or empty text has no spans and the score of a text without
    words. Every row and column is kept; columns that bear an output's name are replaced.
    """
    kept = df.drop(*[c for c in df.columns if c.lower() in {"score", "predicted", "spans"} and c != text])
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = "score double, spans array<struct<start: int, end: int, p: double>>"

    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        scores = Scores(m.weights, m.bias)
        for batch in batches:
            texts = batch.tolist()
            ends = np.cumsum([len(t) if t else 0 for t in texts])
            done, start = [], 0
            # A slice of texts at a time, one text at least, so that words held do not depend on the batch.
            while start < len(texts) or not done:
                if len(scores) > CACHE_WORDS:
                    scores.clear()
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + BYTES, "right")))
                done.append(tag_texts(texts[start:stop], m, scores))
                start = stop
            yield pd.concat(done, ignore_index=True)

    made = free_name(kept, "llm_tag")
    out = kept.withColumn(made, F.pandas_udf(tag, kind)(F.col(text)))
    return out.withColumns(
        {
            "score": F.col(made)["score"],
            "predicted": (F.col(made)["score"] >= threshold).cast("int"),
            "spans": F.col(made)["spans"],
        }
    ).drop(made)


def tag_texts(texts: list[str | None], m: Model, scores: Scores) -> pd.DataFrame:
    words, lengths, counts = chains(texts)
    odds = np.fromiter(map(scores.__getitem__, words), float, len(words))
    post = marginals(odds, lengths, m.moves)
    spans: list[list[tuple]] = [[] for _ in texts]
    bad = np.flatnonzero(post > 1)
    if len(bad):
        ends = np.cumsum(counts)
        for d in np.unique(np.searchsorted(ends, bad, side="right")):
            first = ends[d] - counts[d]
            own = bad[(bad >= first) & (bad < ends[d])] - first
            places = [x.span() for x in WORD.finditer(texts[d])]
            spans[d] = [(*places[i], float(post[first + i] / (1 + post[first + i]))) for i in own]
    return pd.DataFrame({"score": m.score(summaries(post, counts)), "spans": spans})
