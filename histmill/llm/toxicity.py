"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A text is cut into windows of 32 words that start every 16 words. What white space does not
separate for more than ``PIECE`` characters enters as overlapping pieces, each a word. A word enters as two
vectors: one of its own, if training saw it often enough, and the mean of the vectors of
its beginnings and of all its character trigrams. Both directions of the recurrent network read the window, attention pools
their states, and a logistic unit gives the window's logit. A document's score comes from
its highest window through a logistic fit on labelled documents that training left out, which
are scored for it with all their windows, as any other text is.

The network is fitted in numpy on the driver, on a sample with documented bounds
(``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` documents, ``WINDOWS`` windows of each for the
gradient steps, taken by hash); it is a few MB whatever the corpus holds. Since a toxic document has harmless
windows too, the second half of training keeps only those windows of toxic documents that
the first half finds toxic, and the highest of each. Scoring covers every window of every
text inside Arrow batches; projections of distinct words are remembered up to a bound.

Defined results: a null, empty or white-space text has no window and scores 0.0; without
labelled rows of both kinds every text scores 0.0; repeated rows score alike; other columns
pass through.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from histmill.llm.common import drop_stage, ensure_columns, give_back, shuffle_partitions, small_batches, stage

WINDOW, STRIDE = 32, 16
SAMPLE_TOXIC, SAMPLE_CLEAN, WINDOWS = 1500, 4500, 12
#: Documents of the sample that have to share a word or a character bucket for it to count.
MIN_DOCS = 4
#: Longest word in characters, and how far apart the pieces of a longer one start.
PIECE, PIECE_STEP = 20, 10
WORDS, CHAR_BUCKETS = 20_000, 1 << 15
#: Four beginnings and as many trigrams as a word of PIECE characters has.
CHAR_FEATURES = 4 + PIECE
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 12, 12, 10, 12
STEPS, PASSES, BATCH, RATE = 600, 6, 128, 0.008
#: Share of the inputs that a training step leaves out.
DROPOUT = 0.3
THRESHOLD = 0.3
#: Distinct words whose projections a worker remembers.
WORD_CACHE = 200_000
#: Windows in one pass of the network.
PASS = 1024


PUNCTUATION = string.punctuation.encode()


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation at their ends (where something is left);
    pieces of those over PIECE characters."""
    if not text:
        return []
    words = [w.strip(PUNCTUATION) or w for w in text.lower().encode("utf-8", "replace").split()]
    if max(map(len, words), default=0) <= PIECE:
        return words
    return [p for w in words for p in ((w,) if len(w) <= PIECE else pieces(w))]


def pieces(word: bytes) -> list[bytes]:
    """Runs of at most PIECE characters, every PIECE_STEP, until the last character is inside."""
    chars = word.decode("utf-8", "replace")
    return [chars[k:k + PIECE].encode() for k in range(0, max(len(chars) - PIECE + PIECE_STEP, 1), PIECE_STEP)]


def window_starts(n: int) -> range:
    """Every STRIDE words, until the last word is inside."""
    return range(0, max(n - STRIDE, 1), STRIDE) if n else range(0)


def char_features(word: bytes) -> list[int]:
    """Buckets of the beginnings and of all character trigrams of a word of at most PIECE characters."""
    chars = f"^{word.decode('utf-8', 'replace')}$"
    grams = [f"{k}<{chars[1:k + 1]}" for k in (3, 4, 5, 6) if len(chars) > k + 1]
    tri = [chars[i:i + 3] for i in range(max(1, len(chars) - 2))]
    return [1 + zlib.crc32(g.encode()) % (CHAR_BUCKETS - 1) for g in grams + tri]


class Vocabulary:
    """Numbers of distinct words: own vector (0: none) and character buckets (0: none).

    ``common`` marks the buckets that enough training documents share.
    """

    def __init__(self, own: dict[bytes, int], common: np.ndarray | None = None):
        self.own, self.common = own, common

    def rows(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.fromiter((self.own.get(w, 0) for w in words), np.int32, len(words))
        chars = np.zeros((len(words), CHAR_FEATURES), np.int32)
        for i, w in enumerate(words):
            f = char_features(w)
            chars[i, :len(f)] = f
        return ids, chars if self.common is None else chars * self.common[chars]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _word_vectors(p: dict, ids: np.ndarray, chars: np.ndarray) -> np.ndarray:
    share = 1 / np.maximum((chars > 0).sum(1, keepdims=True), 1).astype(np.float32)
    return np.concatenate([p["word"][ids], p["char"][chars].sum(1) * share], axis=1)


def _run(xp: np.ndarray, u: np.ndarray, mask: np.ndarray, back: bool, keep: list | None = None) -> np.ndarray:
    """States (T, B, H) of one direction from input projections (T, B, 3H)."""
    t_len, b, h3 = xp.shape
    h = h3 // 3
    state, out = np.zeros((b, h), np.float32), np.zeros((t_len, b, h), np.float32)
    for t in reversed(range(t_len)) if back else range(t_len):
        rec = state @ u
        gates = _sigmoid(xp[t, :, :2 * h] + rec[:, :2 * h])
        z, r = gates[:, :h], gates[:, h:]
        new = np.tanh(xp[t, :, 2 * h:] + r * rec[:, 2 * h:])
        after = state + (1 - z) * (new - state) * mask[t]
        if keep is not None:
            keep.append((t, state, z, r, new, rec[:, 2 * h:]))
        state = out[t] = after
    return out


def _pool(p: dict, states: np.ndarray, mask: np.ndarray) -> tuple:
    """Attention over the states (T, B, 2H)."""
    a = np.tanh(states @ p["att"])
    e = a @ p["att_v"] + (mask[:, :, 0] - 1) * 1e4
    e = np.exp(e - e.max(0))
    alpha = e / e.sum(0)
    return a, alpha, (alpha[:, :, None] * states).sum(0)


def forward(p: dict, proj: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Logits of windows from word projections (T, B, 6H)."""
    h3 = proj.shape[2] // 2
    states = np.concatenate([_run(proj[:, :, :h3], p["uf"], mask, False),
                             _run(proj[:, :, h3:], p["ub"], mask, True)], axis=2)
    return _pool(p, states, mask)[2] @ p["out"] + p["bias"][0]


def _run_grad(d: np.ndarray, steps: list, u: np.ndarray, mask: np.ndarray, du: np.ndarray) -> np.ndarray:
    """Gradient of the projections from that of the states; adds to ``du``."""
    t_len, b, h = d.shape
    dxp, carry = np.zeros((t_len, b, 3 * h), np.float32), np.zeros((b, h), np.float32)
    for t, state, z, r, new, rec_n in reversed(steps):
        g = d[t] + carry
        gm = g * mask[t]
        d_new = gm * (1 - z) * (1 - new * new)
        d_z = -gm * (new - state) * z * (1 - z)
        d_r = d_new * rec_n * r * (1 - r)
        dxp[t] = np.concatenate([d_z, d_r, d_new], axis=1)
        d_rec = np.concatenate([d_z, d_r, d_new * r], axis=1)
        du += state.T @ d_rec
        carry = g - gm * (1 - z) + d_rec @ u.T
    return dxp


def _sums_at(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``rows`` by their number in ``at``."""
    out = np.zeros((n, rows.shape[1]), np.float32)
    order = np.argsort(at, kind="stable")
    ranked = at[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    out[ranked[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _flat(x: np.ndarray) -> np.ndarray:
    return x.reshape(-1, x.shape[-1])


def _initial(rng: np.random.Generator, n_words: int) -> dict[str, np.ndarray]:
    def draw(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    d, h = WORD_DIM + CHAR_DIM, HIDDEN
    p = {"word": draw(n_words, WORD_DIM, scale=0.1), "char": draw(CHAR_BUCKETS, CHAR_DIM, scale=0.3),
         "w": draw(d, 6 * h, scale=0.3), "b": np.zeros(6 * h, np.float32), "uf": draw(h, 3 * h, scale=0.25),
         "ub": draw(h, 3 * h, scale=0.25), "att": draw(2 * h, ATTENTION, scale=0.3),
         "att_v": draw(ATTENTION, scale=0.3), "out": draw(2 * h, scale=0.3), "bias": np.zeros(1, np.float32)}
    p["word"][0] = 0
    p["char"][0] = 0
    return p


def gradients(p: dict, ids: np.ndarray, chars: np.ndarray, at: np.ndarray, mask: np.ndarray, y: np.ndarray,
              weight: np.ndarray, drop: np.ndarray | float = 1.0) -> tuple[float, dict]:
    """Weighted log loss and its gradients. ``ids``, ``chars``: the batch's distinct words;
    ``at`` (T, B): their numbers; ``mask`` (T, B, 1); ``drop``: factors of their inputs."""
    h = HIDDEN
    x = _word_vectors(p, ids, chars) * drop
    proj = (x @ p["w"] + p["b"])[at]
    fwd, bwd = [], []
    states = np.concatenate([_run(proj[:, :, :3 * h], p["uf"], mask, False, fwd),
                             _run(proj[:, :, 3 * h:], p["ub"], mask, True, bwd)], axis=2)
    a, alpha, pooled = _pool(p, states, mask)
    prob = _sigmoid(pooled @ p["out"] + p["bias"][0])
    loss = -(weight * (y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7))).sum() / weight.sum()
    d_logit = ((prob - y) * weight / weight.sum()).astype(np.float32)
    g = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
    d_pool = d_logit[:, None] * p["out"]
    d_alpha = (states * d_pool).sum(2)
    d_e = alpha * (d_alpha - (alpha * d_alpha).sum(0))
    d_a = d_e[:, :, None] * p["att_v"] * (1 - a * a)
    g["att_v"] = d_e.ravel() @ _flat(a)
    g["att"] = _flat(states).T @ _flat(d_a)
    d_states = alpha[:, :, None] * d_pool + d_a @ p["att"].T
    g["uf"], g["ub"] = np.zeros_like(p["uf"]), np.zeros_like(p["ub"])
    d_proj = np.concatenate([_run_grad(d_states[:, :, :h], fwd, p["uf"], mask, g["uf"]),
                             _run_grad(d_states[:, :, h:], bwd, p["ub"], mask, g["ub"])], axis=2)
    d_words = _sums_at(at.ravel(), _flat(d_proj), len(ids))
    g["w"], g["b"] = x.T @ d_words, d_words.sum(0)
    d_x = (d_words @ p["w"].T) * drop
    g["word"] = _sums_at(ids, d_x[:, :WORD_DIM], len(p["word"]))
    share = 1 / np.maximum((chars > 0).sum(1, keepdims=True), 1).astype(np.float32)
    one, feature = np.nonzero(chars)
    g["char"] = _sums_at(chars[one, feature], (d_x[:, WORD_DIM:] * share)[one], len(p["char"]))
    g["word"][0] = 0
    return float(loss), g


class _Adam:
    def __init__(self, p: dict):
        self.p, self.n = p, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict, rate: float) -> None:
        self.n += 1
        for k, d in g.items():
            self.m[k] += 0.1 * (d - self.m[k])
            self.v[k] += 0.01 * (d * d - self.v[k])
            m, v = self.m[k] / (1 - 0.9 ** self.n), self.v[k] / (1 - 0.99 ** self.n)
            self.p[k] -= rate * m / (np.sqrt(v) + 1e-6)


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and intercept of P(y) from x, lightly regularised."""
    mean, spread = x.mean(), x.std() + 1e-6
    s, a, b = (x - mean) / spread, 1.0, 0.0
    for _ in range(60):  # Newton steps, with a weak pull to slope 1
        q = _sigmoid(a * s + b)
        e, v = q - y, q * (1 - q) + 1e-6
        g = np.array([(e * s).sum() + 0.1 * (a - 1), e.sum() + 0.1 * b])
        hess = np.array([[(v * s * s).sum() + 0.1, (v * s).sum()], [(v * s).sum(), v.sum() + 0.1]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 1.0 / (np.abs(step).max() + 1e-9))
        a, b = a - step[0], b - step[1]
    a = max(a, 0.05)
    return a / spread, b - a * mean / spread


class Model:
    """Parameters, vocabulary and the fit from the highest logit to the score."""

    def __init__(self, params: dict, vocabulary: Vocabulary, slope: float = 1.0, shift: float = 0.0):
        self.params, self.vocabulary, self.slope, self.shift = params, vocabulary, slope, shift


class Scorer:
    """Scores texts; remembers the projections of distinct words."""

    def __init__(self, model: Model):
        self.model, self.vocabulary = model, model.vocabulary
        self._clear()

    def _clear(self) -> None:
        self.at: dict[bytes, int] = {}
        self.table = np.zeros((4096, 6 * HIDDEN), np.float32)

    def _project(self, new: list[bytes]) -> None:
        p, first = self.model.params, len(self.at)
        if first + len(new) > len(self.table):
            more = np.zeros((max(2 * len(self.table), first + len(new)), 6 * HIDDEN), np.float32)
            more[:first] = self.table[:first]
            self.table = more
        for k in range(0, len(new), 4096):
            ids, chars = self.vocabulary.rows(new[k:k + 4096])
            self.table[first + k:first + k + len(ids)] = _word_vectors(p, ids, chars) @ p["w"] + p["b"]
        self.at.update(zip(new, range(first, first + len(new)), strict=True))

    def logits(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """The logits of all windows of each word list."""
        if len(self.at) > WORD_CACHE:
            self._clear()
        self._project(list({w for t in texts for w in t if w not in self.at}))
        rows, counts = [], []
        for words in texts:
            n, starts = len(words), window_starts(len(words))
            counts.append(len(starts))
            if n:
                at = np.fromiter(map(self.at.__getitem__, words), np.int32, n)
                padded = np.full(starts[-1] + max(WINDOW, n - starts[-1]), -1, np.int32)
                padded[:n] = at
                rows.append(padded[np.array(starts)[:, None] + np.arange(WINDOW)])
        if not rows:
            return [np.empty(0, np.float32) for _ in texts]
        grid = np.concatenate(rows).T
        out = [forward(self.model.params, self.table[grid[:, k:k + PASS]],
                       (grid[:, k:k + PASS] >= 0).astype(np.float32)[:, :, None])
               for k in range(0, grid.shape[1], PASS)]
        return np.split(np.concatenate(out), np.cumsum(counts)[:-1])

    def window_logits(self, windows: list[list[bytes]]) -> np.ndarray:
        """One logit for each list of at most WINDOW words."""
        return np.concatenate(self.logits(windows))

    def highest(self, texts: list[str | None]) -> list[float | None]:
        """The highest logit of each whole text; None without words."""
        out = []
        for k in range(0, len(texts), 64):
            out += [float(x.max()) if len(x) else None for x in self.logits([words_of(t) for t in texts[k:k + 64]])]
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        m = self.model
        return np.array([0.0 if b is None else float(_sigmoid(np.float64(m.slope * b + m.shift)))
                         for b in self.highest(texts)], np.float64)


def train(windows: list[list[list[bytes]]], labels: list[int], seed: int = 5,
          whole: Callable[[Model, list[int]], list[float]] | None = None) -> Model | None:
    """Fit on documents given as lists of windows (lists of words) with labels 0 or 1.

    Every fifth document only serves the fit from logits to scores. ``whole`` gives the highest
    logits of the whole texts of documents by their numbers; without it the windows are taken
    as all there are. None without both labels.
    """
    docs = [(w, y) for w, y in zip(windows, labels, strict=True) if w]
    numbers = [i for i, w in enumerate(windows) if w]
    if len({y for _, y in docs}) < 2:
        return None
    rng = np.random.default_rng(seed)
    order = list(range(len(docs)))
    rng.shuffle(order)
    docs, numbers = [docs[k] for k in order], [numbers[k] for k in order]
    aside = [d for i, d in enumerate(docs) if i % 5 == 4]
    fit = [d for i, d in enumerate(docs) if i % 5 != 4]
    apart = numbers[4::5]
    if len({y for _, y in aside}) < 2 or len({y for _, y in fit}) < 2:
        fit, aside, apart = docs, docs, numbers
    per_doc = [{x for win in ws for x in win} for ws, _ in fit]
    seen = Counter(w for words in per_doc for w in words)
    names = sorted(seen)
    number = {w: i for i, w in enumerate(names)}
    ranked = sorted((w for w in names if seen[w] >= MIN_DOCS), key=lambda w: (-seen[w], w))[:WORDS]
    own = Vocabulary({w: i + 1 for i, w in enumerate(ranked)})
    ids, chars = own.rows(names)
    shared = np.zeros(CHAR_BUCKETS, np.int64)
    for words in per_doc:
        shared[np.unique(chars[[number[w] for w in words]])] += 1
    own.common = (shared >= MIN_DOCS).astype(np.int32)
    chars = chars * own.common[chars]
    # the padding word has the last number
    ids, chars = np.append(ids, 0).astype(np.int32), np.vstack([chars, np.zeros((1, CHAR_FEATURES), np.int32)])
    grids = [np.array([[number[x] for x in win] + [len(names)] * (WINDOW - len(win)) for win in ws]) for ws, _ in fit]
    where = np.repeat(np.arange(len(fit)), [len(g) for g in grids])
    grid, y_doc = np.concatenate(grids), np.array([y for _, y in fit])
    p = _initial(rng, len(own.own) + 1)
    adam, usable = _Adam(p), np.ones(len(grid), bool)
    steps = int(np.clip(PASSES * len(grid) / BATCH, 100, STEPS))
    for step in range(steps):
        if step == steps // 2:  # toxic documents: only the windows found toxic, and the highest
            model = Scorer(Model(p, own))
            for d in np.flatnonzero(y_doc == 1):
                logit = model.window_logits(fit[d][0])
                usable[where == d] = (logit > 0) | (logit == logit.max())
        pos, neg = (np.flatnonzero(usable & (y_doc[where] == k)) for k in (1, 0))
        pick = np.concatenate([rng.choice(pos, BATCH // 2), rng.choice(neg, BATCH // 2)])
        distinct, at = np.unique(grid[pick].T, return_inverse=True)
        at = at.reshape(WINDOW, BATCH)
        batch_ids = np.where(rng.random(len(distinct)) < 0.3, 0, ids[distinct])
        drop = ((rng.random((len(distinct), WORD_DIM + CHAR_DIM)) >= DROPOUT) / (1 - DROPOUT)).astype(np.float32)
        mask = (grid[pick].T < len(names)).astype(np.float32)[:, :, None]
        y = y_doc[where[pick]].astype(np.float32)
        _, g = gradients(p, batch_ids, chars[distinct], at, mask, y, np.ones(BATCH, np.float32), drop)
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        adam.step({k: v * min(1.0, 2.0 / (norm + 1e-9)) for k, v in g.items()}, RATE * (1 - 0.8 * step / steps))
    model = Model(p, own)
    if whole is None:
        scorer = Scorer(model)
        top = np.array([scorer.window_logits(ws).max() for ws, _ in aside])
    else:
        top = np.array(whole(model, apart))
    model.slope, model.shift = _fit_logistic(top, np.array([y for _, y in aside], float))
    return model


def _sampled_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Up to WINDOWS windows of each text, chosen by a generator seeded with its id."""
    for pdf in batches:
        out = []
        for doc_id, toxic, text in zip(pdf["doc_id"], pdf["toxic"], pdf["text"], strict=True):
            words = words_of(text)
            starts = list(window_starts(len(words)))
            if len(starts) > WINDOWS:
                chosen = np.random.default_rng(abs(int(doc_id))).choice(len(starts), WINDOWS, replace=False)
                starts = [starts[k] for k in sorted(chosen)]
            out += [(doc_id, toxic, b" ".join(words[s:s + WINDOW])) for s in starts]
        yield pd.DataFrame(out, columns=["doc_id", "toxic", "words"])


def _highest_batches(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            best = scorer.highest(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(best, pa.float64())],
                                             names=["doc_id", "best"])

    return run


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Train on a bounded sample of the labelled documents that are not held out.

    ``labels``: doc_id, toxic (0 or 1; other values and nulls are ignored; a document with
    both counts as toxic).
    """
    spark = docs.sparkSession
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    order = F.xxhash64("doc_id")
    chosen = (known.filter("toxic = 1").orderBy(order).limit(SAMPLE_TOXIC)
              .unionByName(known.filter("toxic = 0").orderBy(order).limit(SAMPLE_CLEAN)))
    # at most SAMPLE_TOXIC + SAMPLE_CLEAN ids: safe to broadcast
    wanted = spark.createDataFrame([tuple(r) for r in chosen.collect()], "doc_id long, toxic int")
    small_batches(spark)
    texts = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(wanted), "doc_id")
                  .select("doc_id", "toxic", "text"))
    got = texts.mapInPandas(_sampled_windows, "doc_id long, toxic int, words binary").toPandas()
    by_doc: dict[int, tuple[list, int]] = {}
    for doc_id, toxic, words in sorted(zip(got["doc_id"], got["toxic"], got["words"], strict=True)):
        by_doc.setdefault(doc_id, ([], int(toxic)))[0].append(bytes(words).split())
    ids = list(by_doc)

    def whole(model: Model, numbers: list[int]) -> list[float]:
        # a fifth of the sample's ids at most
        some = spark.createDataFrame([(int(ids[k]),) for k in numbers], "doc_id long")
        shared = spark.sparkContext.broadcast(model)
        run = _highest_batches(shared)
        best = (texts.join(F.broadcast(some), "doc_id").select("doc_id", "text")
                .repartition(2 * shuffle_partitions(spark), F.xxhash64("doc_id", F.length("text")))
                .mapInArrow(run, "doc_id long, best double").groupBy("doc_id").agg(F.max("best")).collect())
        shared.destroy()
        best = dict(map(tuple, best))
        return [best[ids[k]] for k in numbers]

    del got
    model = train([w for w, _ in by_doc.values()], [y for _, y in by_doc.values()], whole=whole)
    drop_stage(texts)
    by_doc.clear()
    give_back()
    return model


def _score_batches(spark: SparkSession, model: Model, text_at: int) -> Callable:
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores = scorer.scores(batch.column(text_at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, "__score"])

    return run


def score(docs: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """``docs`` (text and anything else) with the score of every whole text."""
    ensure_columns(docs, "text")
    docs = docs.select(*[c for c in docs.columns if c != name])
    if model is None:
        return docs.withColumn(name, F.lit(0.0))
    small_batches(docs.sparkSession)
    schema = StructType([*docs.schema.fields, StructField("__score", DoubleType())])
    run = _score_batches(docs.sparkSession, model, docs.columns.index("text"))
    return docs.mapInArrow(run, schema).withColumnRenamed("__score", name)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    return score(docs, fit(docs, labels), "__toxicity").filter(F.col("__toxicity") < threshold).drop("__toxicity")
