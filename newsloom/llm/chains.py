"""Classifier chains over word pieces: each category is judged with the probabilities of those before it."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import Memo, bounded_batches, chunks, keyed_schema, text_bytes
from newsloom.llm.wumanber import words_of
from newsloom.session import materialize

#: Labelled rows a chain is fitted on, at most: SAMPLE of each value of the last category, those with the least hash.
SAMPLE = 4_000
#: Pieces a linear model may weigh, those most clearly tied to its category.
PIECES = 400
#: Rows of the fitting sample that must hold a piece.
LEAST_ROWS = 5
FOLDS = 4
SHORTEST, LONGEST = 4, 6
#: Bins of one unit of a logit in the histograms that the threshold comes from.
BINS = 1_000


def pieces_of(word: bytes) -> tuple[int, ...]:
    """Hashes of a word and of its beginnings, which tie together the forms of one word."""
    text = word.decode("utf-8", "replace")
    marked = {"=" + text} | {"<" + text[:n] for n in range(SHORTEST, min(LONGEST, len(text)) + 1)}
    return tuple(zlib.crc32(piece.encode()) for piece in marked)


def matrix_pieces(texts: list[bytes], memo: Memo) -> list[np.ndarray]:
    return [np.unique(np.fromiter((p for w in set(words_of(t)) for p in memo[w]), np.uint32)) for t in texts]


def chosen_pieces(rows: list[np.ndarray], positive: np.ndarray) -> np.ndarray:
    """The pieces most clearly tied to the category, by the G statistic of presence against category."""
    n = len(rows)
    pieces, place = np.unique(np.concatenate(rows) if n else np.zeros(0, np.uint32), return_inverse=True)
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    with_, hits = np.bincount(place, minlength=len(pieces)), np.bincount(place, positive[owner], len(pieces))
    share = positive.mean() if n else 0.0
    cells = [(hits, with_ * share), (with_ - hits, with_ * (1 - share))]
    cells += [(positive.sum() - hits, (n - with_) * share), (n - with_ - positive.sum() + hits, (n - with_) * (1 - share))]
    g = sum(np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0) for seen, expected in cells)
    g[with_ < LEAST_ROWS] = 0
    best = np.argsort(-g, kind="stable")[:PIECES]
    return np.sort(pieces[best[g[best] > 6]])


def presence(rows: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), len(chosen)), np.float32)
    for at, pieces in enumerate(rows):
        place = np.searchsorted(chosen, pieces)
        place = place[place < len(chosen)]
        inside = chosen[place] == pieces[: len(place)]
        out[at, place[inside]] = 1
    return out


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 40) -> np.ndarray:
    """Weights and bias of a logistic regression by Newton steps; both classes weigh alike."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        w[-1] = 0.0 if not len(y) else (6.0 if y[0] else -6.0)
        return w
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ ((p - y) * weight) + ridge * w
        bend = (x * (p * (1 - p) * weight).astype(x.dtype)[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(bend.astype(float), gradient)
        w -= move
        if np.abs(move).max() < 1e-4:
            break
    return w


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _joined(x: np.ndarray, before: list[np.ndarray]) -> np.ndarray:
    """Presence columns, then the logits of the categories before."""
    return np.hstack([x, *[_logit(p)[:, None].astype(np.float32) for p in before]]) if before else x


def _apply(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray) -> list[dict]:
    """One linear model for each column of ``labels``, in order.

    A later model is trained with the probabilities that the earlier ones give to rows they have not seen: each fold is
    judged by a model of the other folds, pieces chosen there too. Such probabilities are ``unseen``.
    """
    chain: list[dict] = []
    before: list[np.ndarray] = []
    for category in range(labels.shape[1]):
        y = labels[:, category].astype(float)
        unseen = np.zeros(len(rows))
        for fold in np.unique(folds):
            seen = folds != fold
            chosen = chosen_pieces([r for r, s in zip(rows, seen) if s], y[seen])
            x = _joined(presence(rows, chosen), before)
            unseen[~seen] = _apply(x[~seen], fit_linear(x[seen], y[seen]))
        chosen = chosen_pieces(rows, y)
        w = fit_linear(_joined(presence(rows, chosen), before), y)
        chain.append({"pieces": chosen, "weights": w, "unseen": unseen})
        before.append(unseen)
    return chain


def bins_of(p: np.ndarray) -> np.ndarray:
    return np.floor(_logit(p) * BINS).astype(np.int64)


def best_threshold(bins: np.ndarray, rows: np.ndarray, hits: np.ndarray) -> float:
    """The probability from which on rows are flagged at the best F1: ``rows`` and ``hits`` lie in ``bins``, which may repeat."""
    bins, place = np.unique(bins, return_inverse=True)
    rows, hits = np.bincount(place, rows)[::-1], np.bincount(place, hits)[::-1]
    bins = bins[::-1]
    if not hits.sum():
        return 1.0
    best = int((2 * np.cumsum(hits) / (np.cumsum(rows) + hits.sum())).argmax())
    edge = lambda x: 1 / (1 + math.exp(-x / BINS))
    # Halfway to the next lower bin that holds rows.
    return edge((bins[best] + bins[best + 1] + 1) / 2) if best + 1 < len(bins) else edge(bins[best]) / 2


class Judge:
    """Applies a chain to texts, by a table from words to the pieces that any model weighs."""

    def __init__(self, chain: list[dict]):
        self._chain = chain
        self._all = np.unique(np.concatenate([c["pieces"] for c in chain])) if chain else np.zeros(0, np.uint32)
        self._place = {int(p): i for i, p in enumerate(self._all)}
        self._memo = Memo(lambda word: tuple(self._place[p] for p in pieces_of(word) if p in self._place))
        self._columns = [np.searchsorted(self._all, c["pieces"]) for c in chain]

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        x = np.zeros((len(texts), len(self._all)), np.float32)
        get = self._memo.__getitem__
        for at, text in enumerate(texts):
            found = set().union(*map(get, set(words_of(text))))
            x[at, list(found)] = 1
        out: list[np.ndarray] = []
        for model, columns in zip(self._chain, self._columns):
            out.append(_apply(_joined(x[:, columns], out), model["weights"]))
        return out


def known_labels(labels: DataFrame, key: str, categories: Sequence[str]) -> DataFrame:
    return labels.dropna(subset=[key, *categories]).select(F.col(key).alias("_key"), *[F.col(c).cast("int").alias(c) for c in categories])


def threshold_over_all(judged: DataFrame, known: DataFrame, used: DataFrame, chain: list[dict], category: str) -> float:
    """The best-F1 threshold of the last category over all labelled rows: those of the fit by their unseen probabilities, the
    others by those of ``judged``. Spark adds up one histogram for each label; it has a bounded number of bins.
    """
    rest = known.groupBy("_key").agg(F.min(category).alias("_y")).join(F.broadcast(used.select("_key")), "_key", "left_anti")
    p = judged.where("_key is not null").groupBy("_key").agg(F.min(f"p_{category}").alias("_p"))
    p = p.join(rest, "_key").withColumn("_p", F.least(F.greatest("_p", F.lit(1e-6)), F.lit(1 - 1e-6)))
    bin_ = F.floor(F.log(F.col("_p") / (1 - F.col("_p"))) * BINS).cast("long")
    found = p.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("rows"), F.sum("_y").alias("hits")).toArrow()
    columns = [found[c].to_numpy().astype(np.int64) for c in ("bin", "rows", "hits")]
    own = [bins_of(chain[-1]["unseen"]), np.ones(len(chain[-1]["unseen"]), np.int64), chain[-1]["labels"].astype(np.int64)]
    return best_threshold(*[np.concatenate(pair) for pair in zip(columns, own)])


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, categories: Sequence[str], sample: int, folds: int) -> tuple[list[dict], DataFrame]:
    """The chain, fitted in one task on at most ``sample`` labelled rows of each value of the last category, and those rows."""
    known = known_labels(labels, key, categories)
    by = F.xxhash64("_key", F.lit(11))
    picked = None
    for value in (0, 1):
        some = known.where(F.col(categories[-1]) == value).orderBy(by, "_key").limit(sample)
        picked = some if picked is None else picked.unionByName(some)
    texts = docs.select(F.col(key).alias("_key"), text_bytes(F.col(text)).alias("_text"))
    # The sample is bounded, so it is broadcast.
    joined = texts.join(F.broadcast(picked.dropDuplicates(["_key"])), "_key").dropDuplicates(["_key"])
    names = list(categories)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        memo, rows, found, keys = Memo(pieces_of), [], [], []
        for batch, some in chunks(batches, "_text"):
            rows += matrix_pieces(some, memo)
            found.append(np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names]))
            keys += batch.column("_key").to_pylist()
        values = np.concatenate(found) if found else np.zeros((0, len(names)), int)
        turn = np.array([zlib.crc32(str(k).encode()) % folds for k in keys], int)
        chain = fit_chain(rows, values, turn)
        chain[-1]["labels"] = values[:, -1]
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(chain)]})

    import pickle

    stored = materialize(joined, "sample")
    bounded = stored.coalesce(1).sortWithinPartitions("_key")
    return pickle.loads(bounded.mapInArrow(fit, "model binary").first()["model"]), stored


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    categories: Sequence[str] = ("quality", "toxic"),
    sample: int = SAMPLE,
    folds: int = FOLDS,
) -> DataFrame:
    """``(key, p_<category>..., <last category>)`` of every row; the last column says whether its threshold is reached.

    Labels are 0 or 1; the chain runs in the order of ``categories``. All rows are judged; only the fit is on a bounded
    sample, the threshold of the last category is the one with the best F1 over all labelled rows. Rows of labels with a null, or without a document, are not used; of rows that repeat a key one is.
    A null or empty text has no pieces. Without labels of both values every probability is one half or that of the
    single value. Null and repeated keys are judged like others; other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    chain, used = train(docs, labels, key, text, categories, sample, folds)
    shared = spark.sparkContext.broadcast([{name: c[name] for name in ("pieces", "weights")} for c in chain])
    rows = docs.select(F.col(key).alias("_key"), text_bytes(F.col(text)).alias("_text"))
    names = [f"p_{c}" for c in categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for batch, texts in chunks(batches, "_text"):
            columns = [batch.column("_key"), *[pa.array(p.astype(float)) for p in judge(texts)]]
            yield pa.RecordBatch.from_arrays(columns, names=["_key", *names])

    schema = keyed_schema(rows, ", ".join(f"{n} double" for n in names))
    judged = materialize(rows.mapInArrow(run, schema), "judged")
    least = threshold_over_all(judged, known_labels(labels, key, categories), used, chain, categories[-1])
    return judged.withColumn(categories[-1], F.col(names[-1]) >= F.lit(least)).withColumnRenamed("_key", key)
