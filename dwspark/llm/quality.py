"""Quality classifier by co-training of two views.

The content view sees a text only as byte bigrams and trigrams, hashed into a
normalised vector; the metadata view sees source, language, length and layout. Each
is a logistic regression, fitted to labelled rows and calibrated on held-out ones.
In each round, all pool documents of which one view is sure are
pseudo-labelled training rows of the other view. A last regression, fitted on
held-out rows too, combines the two calibrated views; every document is then
scored with it.

MAX_LABELLED labelled rows are used at most, half of them of each class, chosen by a
hash of the id. All documents outside that sample are pool (a label that was not drawn is not
read): their counts of grams are
stored once, and each step of a round is one pass over them, in which tasks apply the
two teachers and add up the losses and gradients of the two learners; only
these sums reach the driver. Scoring covers every document and its whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ship, stored

MAX_LABELLED = 6_000
ROUNDS, SURE = 3, 0.97
FIRST_STEPS = 40                   # of the first fit, to the labelled rows alone
STEPS = 8                          # of a round's fit; a step is a pass over the pool, or a few where it must be shortened
SLOTS = 64                         # tasks that add up the sums of the others
ACCEPT = 0.3                       # a document goes only if good quality is that unlikely
FEW = 300                          # grams; the vector of a text with fewer is shorter, so its score stays near the mean
CONTENT_BITS, META_BITS = 11, 8
PIECE = 1 << 20                    # bytes of a text that are counted at a time


def gram_counts(text: str | None) -> np.ndarray:
    """Counts of a text's hashed byte bigrams and trigrams."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    counts = np.zeros(1 << CONTENT_BITS, np.int64)
    for lo in range(0, len(data), PIECE):
        b = data[lo:lo + PIECE + 2].astype(np.uint32)
        two = b[:-1] * 257 + b[1:]
        grams = [two] if len(two) else []
        if len(b) > 2:
            grams.append(two[:-1] * 263 + b[2:] + 70_001)
        for g in grams:
            counts += np.bincount((g * np.uint32(2654435761)) >> np.uint32(32 - CONTENT_BITS), minlength=len(counts))
    return counts


def content_features(texts: list[str | None]) -> np.ndarray:
    """A row per text: square roots of the shares of its grams, all
    smaller the fewer there are; zeros for an empty text."""
    out = np.zeros((len(texts), 1 << CONTENT_BITS), np.float32)
    for i, t in enumerate(texts):
        counts = gram_counts(t)
        if total := counts.sum():
            out[i] = np.sqrt(counts / (total + FEW))
    return out


def meta_places(rows: pd.DataFrame) -> np.ndarray:
    """A row per document: places of its hashed source and language, classes of length, line count and mean line length."""
    out = np.zeros((len(rows), 5), np.uint8)
    lines = rows["n_lines"].fillna(1).clip(lower=1).to_numpy(float)
    chars = rows["n_chars"].fillna(0).clip(lower=0).to_numpy(float)
    for i, (source, lang, n, m) in enumerate(zip(rows["source"], rows["lang"], chars, lines, strict=True)):
        names = (f"source={source}", f"lang={lang}", f"chars={int(np.log2(n + 1) * 2)}",
                 f"lines={int(np.log2(m) * 2)}", f"width={int(np.log2(n / m + 1) * 2)}")
        out[i] = [zlib.crc32(f.encode()) % (1 << META_BITS) for f in names]
    return out


def _at_places(places: np.ndarray) -> np.ndarray:
    out = np.zeros((len(places), 1 << META_BITS), np.float32)
    np.add.at(out, (np.arange(len(places))[:, None], places), 1)
    return out / np.float32(np.sqrt(5))


def meta_features(rows: pd.DataFrame) -> np.ndarray:
    """A row per document, a normalised vector of what is at its places."""
    return _at_places(meta_places(rows))


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts in a byte each, or in four where one needs more."""
    return counts.astype(np.uint8 if counts.max() < 256 else np.uint32).tobytes()


def unpacked(content: list[bytes], meta: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Content and metadata features of stored rows."""
    size = 1 << CONTENT_BITS
    x = np.empty((len(content), size), np.float32)
    small = np.array([len(c) == size for c in content])
    x[small] = np.frombuffer(b"".join(c for c in content if len(c) == size), np.uint8).reshape(-1, size)
    for i in np.flatnonzero(~small):
        x[i] = np.frombuffer(content[i], np.uint32)
    total = x.sum(1, dtype=np.float64)
    np.sqrt(x, out=x)
    x /= np.sqrt(total + FEW).astype(np.float32)[:, None]
    return x, _at_places(np.frombuffer(b"".join(meta), np.uint8).reshape(-1, 5))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


CHUNK = 512        # labelled rows, kept as half floats, that are widened at a time


def scores(x: np.ndarray, rows: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Raw scores of some rows."""
    w = w.astype(np.float32)
    return np.concatenate([np.zeros(0, np.float32)] + [x[rows[i:i + CHUNK]].astype(np.float32) @ w[:-1] + w[-1] for i in range(0, len(rows), CHUNK)])


def _labelled_sums(x: np.ndarray, rows: np.ndarray, w: np.ndarray, c: int) -> np.ndarray:
    """Loss, count and gradient of some rows of class ``c``."""
    out = np.zeros(len(w) + 2)
    for i in range(0, len(rows), CHUNK):
        out += _class_sums(x[rows[i:i + CHUNK]].astype(np.float32), w, c)
    return out


def fit_logistic(x: np.ndarray, classes: list[np.ndarray], penalty: float = 1e-5, steps: int = FIRST_STEPS) -> np.ndarray:
    """Weights, the bias last, from the rows of class 0 and 1; both classes weigh the same."""
    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        w, value, g = theta.astype(np.float32), 0.0, np.zeros(len(theta))
        for c, rows in enumerate(classes):
            own = _labelled_sums(x, rows, w, c)
            value += 0.5 * own[0] / max(own[1], 1)
            g += 0.5 * own[2:] / max(own[1], 1)
        g[:-1] += penalty * theta[:-1]
        return value + penalty / 2 * float(theta[:-1] @ theta[:-1]), g
    return minimise(loss, np.zeros(x.shape[1] + 1), steps).astype(np.float32)


def fit_scale(s: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling of raw scores: slope (never negative) and offset, with smoothed targets."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    spread = float(s.std()) or 1.0
    s = s / spread
    a, b = 1.0, 0.0
    for _ in range(100):
        p = _sigmoid(a * s + b)
        g = np.array([((p - t) * s).sum(), (p - t).sum()])
        h = p * (1 - p) + 1e-6
        hess = np.array([[(h * s * s).sum() + 1e-3, (h * s).sum()], [(h * s).sum(), h.sum() + 1e-3]])
        d = np.clip(np.linalg.solve(hess, g), -1, 1)
        a, b = a - d[0], b - d[1]
        if abs(d).max() < 1e-6:
            break
    return max(float(a) / spread, 0.0), float(b)


@dataclass
class CoTrained:
    content: np.ndarray
    meta: np.ndarray
    scales: tuple[tuple[float, float], tuple[float, float]]
    combine: np.ndarray              # weights of the two calibrated log odds, and the offset
    pseudo: list[tuple[int, int]]    # rows that each view gave the other, by round

    def views(self, x: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of the two views, calibrated."""
        (a, b), (c, d) = self.scales
        return a * (x @ self.content[:-1] + self.content[-1]) + b, c * (z @ self.meta[:-1] + self.meta[-1]) + d

    def score(self, x: np.ndarray, z: np.ndarray) -> np.ndarray:
        u, v = self.views(x, z)
        return _sigmoid(self.combine[0] * u + self.combine[1] * v + self.combine[2])


Views = tuple[np.ndarray, np.ndarray]
Teachers = list[tuple[np.ndarray, tuple[float, float]]]     # weights and scale of each view


def pool_sums(views: Views, teachers: Teachers, learners: list[np.ndarray], sure: float) -> list[np.ndarray]:
    """For each view, and class 0 and 1 of its pseudo-labels - the rows of which the other
    view's teacher is sure: the learner's loss, the rows, and the gradient, the bias last."""
    said = [_sigmoid(a * (v @ w[:-1] + w[-1]) + b) for v, (w, (a, b)) in zip(views, teachers, strict=True)]
    out = []
    for v, w, p in zip(views, learners, reversed(said), strict=True):
        part = np.zeros((2, v.shape[1] + 3))
        for c, rows in enumerate((1 - p >= sure, p >= sure)):
            if rows.any():
                part[c] = _class_sums(v[rows], w, c)
        out.append(part)
    return out


def _class_sums(x: np.ndarray, w: np.ndarray, c: int) -> np.ndarray:
    s = (x @ w[:-1] + w[-1]).astype(np.float64)
    error = _sigmoid(s) - c
    return np.concatenate([[np.logaddexp(0, s).sum() - c * s.sum(), len(x)], error.astype(np.float32) @ x, [error.sum()]])


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int, rate: float = 8.0) -> np.ndarray:
    """L-BFGS from ``x``; a step that does not lower ``f`` is shortened."""
    value, g = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, ways = -g, []
        for s, t in reversed(past):
            ways.append((s @ d) / (s @ t))
            d = d - ways[-1] * t
        d = d * ((past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else rate)
        for (s, t), a in zip(past, reversed(ways), strict=True):
            d = d + (a - (t @ d) / (s @ t)) * s
        length = 1.0
        for _ in range(6):
            new, g2 = f(x + length * d)
            if new <= value + 1e-4 * length * (g @ d):
                break
            length /= 4
        else:
            return x
        if (s := length * d) @ (t := g2 - g) > 1e-12:
            past.append((s, t))
        x, value, g = x + s, new, g2
    return x


def co_train(x: np.ndarray, z: np.ndarray, y: np.ndarray, held: np.ndarray, pool_x: np.ndarray, pool_z: np.ndarray, **options) -> CoTrained:
    """x, z: content and metadata features of labelled rows; held: those kept for calibration; the pool's features in memory."""
    return co_train_on((x, z), y, held, lambda *a: pool_sums((pool_x, pool_z), *a), **options)


def co_train_on(views: Views, y: np.ndarray, held: np.ndarray, pool: Callable[..., list[np.ndarray]],
                rounds: int = ROUNDS, sure: float = SURE, steps: int = STEPS, penalty: float = 1e-5) -> CoTrained:
    """``pool`` gives ``pool_sums`` over all unlabelled rows. Both classes weigh the same; within a class, a
    pseudo-labelled row counts as a labelled one, and all of them as much as the labelled ones at most."""
    known, kept = [np.flatnonzero(~held & (y == c)) for c in (0, 1)], np.flatnonzero(held)
    ends = np.cumsum([v.shape[1] + 1 for v in views])[:-1]
    models, pseudo = [fit_logistic(v, known, penalty) for v in views], []
    calibrated = lambda: [fit_scale(scores(v, kept, w), y[kept]) for v, w in zip(views, models, strict=True)]
    scales = calibrated()
    for _ in range(rounds):
        teachers, given = list(zip(models, scales, strict=True)), []

        def joint(theta: np.ndarray) -> tuple[float, np.ndarray]:
            """Loss and gradient of both learners."""
            learners = [w.astype(np.float32) for w in np.split(theta, ends)]
            value, gradient = 0.0, []
            sums = pool(teachers, learners, sure)
            given[:] = [tuple(int(part[:, 1].sum()) for part in reversed(sums))]
            for v, w, part in zip(views, learners, sums, strict=True):
                g = np.zeros(len(w))
                for c in (0, 1):
                    n, m = len(known[c]), part[c, 1]
                    own = _labelled_sums(v, known[c], w, c) + part[c] * min(1.0, n / max(m, 1))
                    value += 0.5 * own[0] / max(own[1], 1)
                    g += 0.5 * own[2:] / max(own[1], 1)
                g[:-1] += penalty * w[:-1]
                value += penalty / 2 * float(w[:-1] @ w[:-1])
                gradient.append(g)
            return value, np.concatenate(gradient)

        fitted = minimise(joint, np.concatenate(models).astype(np.float64), steps)
        pseudo.append(given[0])
        if not any(given[0]):
            break
        models = [w.astype(np.float32) for w in np.split(fitted, ends)]
        scales = calibrated()
    model = CoTrained(models[0], models[1], (scales[0], scales[1]), np.array([1.0, 0.0, 0.0]), pseudo)
    s = [a * scores(v, kept, w) + b for v, w, (a, b) in zip(views, models, model.scales, strict=True)]
    model.combine = _fit_combination(np.stack(s, 1), y[kept])
    return model


def _fit_combination(s: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps of a small regression that starts from the content view alone and is pulled towards it."""
    prior = np.array([1.0, 0.0, 0.0])
    x, w = np.column_stack([s, np.ones(len(s))]), prior.copy()
    for _ in range(50):
        p = _sigmoid(x @ w)
        g = x.T @ (p - y) + 1.0 * (w - prior)
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(3)
        d = np.clip(np.linalg.solve(h, g), -1, 1)
        w = w - d
        if abs(d).max() < 1e-6:
            break
    return w


def _document_view(docs: DataFrame) -> DataFrame:
    """doc_id and what the two views read; columns that are missing count as null."""
    have = set(docs.columns)
    col = lambda c, kind: F.col(f"`{c}`").cast(kind) if c in have else F.lit(None).cast(kind)
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), col("source", "string").alias("source"),
                       col("lang", "string").alias("lang"), col("n_chars", "double").alias("n_chars"),
                       F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("double").alias("n_lines"))


def _pool(docs: DataFrame, chosen: DataFrame) -> Callable[..., list[np.ndarray]]:
    """``pool_sums`` over all rows whose id is not ``chosen``; their counts are stored once, by tasks that read the documents."""
    view = _document_view(docs).join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_anti")      # max_labelled rows at most

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.iloc[lo:lo + 256]
                yield pd.DataFrame({"content": [pack_counts(gram_counts(t)) for t in part["text"]],
                                    "meta": [r.tobytes() for r in meta_places(part)]})

    counted = view.mapInPandas(count, "content binary, meta binary")
    path = scratch_path(docs.sparkSession, "pool")
    counted.write.option("compression", "zstd").parquet(path)
    rows = docs.sparkSession.read.schema(counted.schema).parquet(path)
    shapes = [(2, (1 << bits) + 3) for bits in (CONTENT_BITS, META_BITS)]
    ends = np.cumsum([a * b for a, b in shapes])

    def sums(teachers: Teachers, learners: list[np.ndarray], sure: float) -> list[np.ndarray]:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for batch in batches:
                for lo in range(0, len(batch), 1024):
                    part = batch.iloc[lo:lo + 1024]
                    found = pool_sums(unpacked(list(part["content"]), list(part["meta"])), teachers, learners, sure)
                    found = np.concatenate([f.ravel() for f in found])
                    total = found if total is None else total + found
            if total is not None:
                at = TaskContext.get().partitionId()
                yield pd.DataFrame({"slot": [at % SLOTS], "part": [at], "sums": [total.tobytes()]})

        def add(parts: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"slot": parts["slot"].iloc[:1], "sums": [_added(parts.sort_values("part")["sums"])]})

        found = (rows.mapInPandas(run, "slot int, part int, sums binary")
                 .groupBy("slot").applyInPandas(add, "slot int, sums binary").toPandas())
        total = np.frombuffer(_added(found.sort_values("slot")["sums"]) or bytes(8 * int(ends[-1])))
        return [f.reshape(shape) for f, shape in zip(np.split(total, ends[:-1]), shapes, strict=True)]

    return sums


def _added(sums: pd.Series) -> bytes:
    return np.sum([np.frombuffer(b) for b in sums], axis=0).tobytes() if len(sums) else b""


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_labelled: int = MAX_LABELLED,
                seed: int = 11, **options) -> CoTrained | None:
    """A model from documents with labels 0 and 1, a bounded sample of each class, and
    all other documents. Null labels and ids, and ids labelled both ways, are
    left out; of several rows with one labelled id, the one with the smallest hash counts.
    None if a class has fewer than 8 labelled documents."""
    ship(docs.sparkSession)
    labels = (labels.select("doc_id", F.col(label_col).cast("int").alias("y")).filter("doc_id IS NOT NULL AND y IN (0, 1)")
              .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).filter("y = y2").drop("y2"))
    labels = stored(labels.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "labels")
    found = {r.y: r.n for r in labels.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if min(found.get(0, 0), found.get(1, 0)) < 8:
        return None
    first = [labels.filter(F.col("y") == c).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_labelled // 2) for c in (0, 1)]
    chosen = stored(first[0].unionByName(first[1]), "chosen-labels")
    view = _document_view(docs)
    columns = [c for c in view.columns if c != "doc_id"]
    known = (view.join(F.broadcast(chosen), "doc_id")              # max_labelled rows at most
             .groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64(*columns).alias("hash"), *columns)).alias("row"))
             .select("doc_id", "y", *[f"row.{c}" for c in columns]))
    table = _featured(known, ["y"]).toArrow()
    order = np.argsort(np.array([str(d) for d in table["doc_id"].to_pylist()]))         # an order of its own, whatever the tasks were
    ids, y = table["doc_id"].to_pylist(), table["y"].to_numpy().astype(np.float32)[order]

    def matrix(c: str, bits: int) -> np.ndarray:
        """The column's rows as one matrix of half floats; nothing else of the sample is held."""
        out = np.empty((table.num_rows, 1 << bits), np.float16)
        at = np.empty(table.num_rows, np.int64)
        at[order] = np.arange(table.num_rows)
        for i, row in enumerate(table[c]):
            out[at[i]] = np.frombuffer(row.as_buffer(), np.float16)
        return out

    held = np.array([zlib.crc32(str(ids[i]).encode()) % 4 == 0 for i in order])
    if min(((y == c) & (held == h)).sum() for c in (0, 1) for h in (True, False)) == 0:
        held = np.zeros(len(y), bool)
        for c in (0, 1):
            held[np.flatnonzero(y == c)[::4]] = True
    views = matrix("content", CONTENT_BITS), matrix("meta", META_BITS)
    del table
    return co_train_on(views, y, held, _pool(docs, chosen), **options)


def _featured(view: DataFrame, carry: list[str]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.iloc[lo:lo + 256]
                yield pd.DataFrame({"doc_id": part["doc_id"].array, **{c: part[c].array for c in carry},
                                    "content": [r.tobytes() for r in content_features(list(part["text"])).astype(np.float16)],
                                    "meta": [r.tobytes() for r in meta_features(part).astype(np.float16)]})
    kind = view.schema["doc_id"].dataType.simpleString()
    return view.mapInPandas(run, f"doc_id {kind}, " + "".join(f"{c} int, " for c in carry) + "content binary, meta binary")


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = ACCEPT, **fit) -> DataFrame:
    """The columns of ``docs`` plus p_content, p_meta, score (calibrated chances
    of good quality) and accepted (score >= ``threshold``).

    Every row is scored on its whole text. Null and empty texts are scored by
    their metadata and a content vector of zeros. Without enough labels
    (see ``fit_quality``) all scores are null and every row is accepted.
    """
    ship(docs.sparkSession)
    model = fit_quality(docs, labels, **fit)
    if model is None:
        none = F.lit(None).cast("double")
        return docs.withColumns({"p_content": none, "p_meta": none, "score": none, "accepted": F.lit(True)})

    @F.pandas_udf("p_content double, p_meta double, score double")
    def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for text, source, lang, n_chars, n_lines in parts:
            found = []
            for lo in range(0, len(text), 256):
                s = slice(lo, lo + 256)
                meta = pd.DataFrame({"source": source[s], "lang": lang[s], "n_chars": n_chars[s], "n_lines": n_lines[s]})
                x, z = content_features(list(text[s])), meta_features(meta)
                u, v = model.views(x, z)
                found.append(pd.DataFrame({"p_content": _sigmoid(u), "p_meta": _sigmoid(v), "score": model.score(x, z)}))
            yield pd.concat(found) if found else pd.DataFrame({"p_content": [], "p_meta": [], "score": []}, dtype=float)

    have = set(docs.columns)
    col = lambda c, kind: F.col(f"`{c}`").cast(kind) if c in have else F.lit(None).cast(kind)
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("double")
    scored = docs.withColumn("_view", score(F.col("text"), col("source", "string"), col("lang", "string"), col("n_chars", "double"), lines))
    return (scored.withColumns({c: F.col("_view")[c] for c in ("p_content", "p_meta", "score")})
            .withColumn("accepted", F.col("score") >= threshold).drop("_view"))
