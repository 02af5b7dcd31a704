"""Language-model scoring with a gated recurrent network over word classes.

The output softmax is factored by class: log P(word | past) = log P(class | state)
+ log P(word | class). A word's class follows from its last two bytes, so it needs no
table; the end of a text is a class of its own. The state is a gated recurrent unit
that reads the class of each token, starts empty at each document and is carried
through the whole of it. P(word | class) are add-one shares of counts over all
training texts, so the vocabulary is the corpus' own and grows with it.

Training is local: every task runs truncated backpropagation (numpy, windows of
``WINDOW`` tokens, state carried from window to window) over all its training
tokens, starting from shared weights; weights are averaged by tokens, and that is
repeated ``ROUNDS`` times. Only the weights (a few thousand numbers) come to the
driver.

Word counts stay in Spark: the ``COMMON`` most frequent words are broadcast, and the
other words of a document are joined with the counts by hash. Words are 64-bit
hashes. A join key of that tail is a rare word, so none is hot.

Whole texts are scored; a null text is an empty one (one end token). Rows without
doc_id are scored but never learned from. Repeated rows are rows of their own. An
empty table gives an empty result. Weights are averaged over tasks, so scores depend,
a little, on how many tasks read the texts; base scores don't. Without training rows every count is 0. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnbrook.llm.arrays import SPACED_LOWER, chunks, mix, word_places, words
from tarnbrook.session import materialize

CLASSES = 32
HIDDEN = 16
WINDOW = 16
STREAMS = 512
UPDATES = 64
ROUNDS = 2
RATES = (0.01, 0.004)
SEED = 9
COMMON = 1 << 18
COUNTED_AT_ONCE = 1 << 21
TRAINED_AT_ONCE = 1 << 22
SCORED_AT_ONCE = 1 << 21
FOLDS, HELD_FOLD = 7, 2

END = 0
_END_HASH = mix(np.array([0xE4D], dtype=np.uint64), 11)[0]
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_FOLD, F.lit(False))


def _classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A word's class, from its last two bytes."""
    if not len(ends):
        return np.zeros(0, np.int16)
    last = _LOWER[data[ends - 1]]
    before = np.where(ends - starts > 1, _LOWER[data[np.maximum(ends - 2, 0)]], np.uint64(0))
    return (1 + mix(last + np.uint64(256) * before, 12) % np.uint64(CLASSES - 1)).astype(np.int16)


def _with_ends(values: np.ndarray, first: np.ndarray, end: int | np.unsignedinteger) -> np.ndarray:
    """One value per word, and ``end`` after each row's words."""
    rows = len(first) - 1
    out = np.full(len(values) + rows, end, dtype=values.dtype)
    out[np.arange(len(values)) + np.repeat(np.arange(rows), np.diff(first))] = values
    return out


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, class, number per row) of all tokens of a chunk; each row ends with the end token."""
    w = words(data, offsets, SPACED_LOWER)
    kinds = _classes(data, w.starts, w.ends)
    return _with_ends(w.hashes, w.first, _END_HASH), _with_ends(kinds, w.first, END), np.diff(w.first) + 1


def token_classes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The classes of ``tokens`` alone, which need no hashes."""
    starts, ends, first = word_places(data, offsets, SPACED_LOWER[0])
    return _with_ends(_classes(data, starts, ends), first, END)


# The network


def fresh_weights() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    shapes = {"x": (CLASSES, 3 * HIDDEN), "h": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,), "n": (HIDDEN,), "o": (HIDDEN, CLASSES), "c": (CLASSES,)}
    return {k: (rng.standard_normal(s) * 0.2 if len(s) > 1 else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _step(w: dict[str, np.ndarray], h: np.ndarray, read: np.ndarray) -> tuple[np.ndarray, ...]:
    """The next state after reading a class; ``z`` keeps, ``r`` lets the old state into the candidate ``n``."""
    i, g = w["x"][read] + w["b"], h @ w["h"]
    zr = _sigmoid(i[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
    z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
    inner = g[:, 2 * HIDDEN :] + w["n"]
    n = np.tanh(i[:, 2 * HIDDEN :] + r * inner)
    return n + z * (h - n), z, r, n, inner


def _log_share(w: dict[str, np.ndarray], h: np.ndarray) -> np.ndarray:
    logits = h @ w["o"] + w["c"]
    logits -= logits.max(axis=1, keepdims=True)
    logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return logits


def gradients(w: dict[str, np.ndarray], h: np.ndarray, read: np.ndarray, want: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
    """(gradients, state at the end, natural log loss) of one window: ``read`` and ``want`` are streams x window.

    A state starts anew where the end of a text is read.
    """
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    kept, loss, count = [], 0.0, want.size
    for t in range(read.shape[1]):
        before = np.where((read[:, t] == END)[:, None], np.float32(0), h)
        h, z, r, n, inner = _step(w, before, read[:, t])
        share = _log_share(w, h)
        rows = np.arange(len(h))
        loss -= float(share[rows, want[:, t]].sum())
        error = np.exp(share)
        error[rows, want[:, t]] -= 1
        error /= count
        grad["o"] += h.T @ error
        grad["c"] += error.sum(axis=0)
        kept.append((before, z, r, n, inner, error @ w["o"].T))
    back = np.zeros_like(h)
    for t in reversed(range(read.shape[1])):
        before, z, r, n, inner, own = kept[t]
        d = own + back
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (before - n) * z * (1 - z)
        dr = dn * inner * r * (1 - r)
        dg = np.concatenate((dz, dr, dn * r), axis=1)
        di = np.concatenate((dz, dr, dn), axis=1)
        one_hot = np.zeros((len(h), CLASSES), dtype=np.float32)
        one_hot[np.arange(len(h)), read[:, t]] = 1
        grad["x"] += one_hot.T @ di
        grad["b"] += di.sum(axis=0)
        grad["n"] += (dn * r).sum(axis=0)
        grad["h"] += before.T @ dg
        back = d * z + dg @ w["h"].T
        back[read[:, t] == END] = 0
    return grad, h, loss


def train(w: dict[str, np.ndarray], kinds: np.ndarray, rate: float, memory: dict | None = None) -> dict:
    """Truncated backpropagation over a sequence of texts, cut into equal streams; changes ``w``. Returns Adam's averages."""
    # Few streams where there is little text, so that it still makes UPDATES windows.
    streams = max(1, min(STREAMS, len(kinds) // (WINDOW * UPDATES)))
    length = -(-len(kinds) // streams)
    want = np.full(streams * length, END, dtype=np.int64)
    want[: len(kinds)] = kinds
    read = np.concatenate(([END], want[:-1])).reshape(streams, length)
    want = want.reshape(streams, length)
    memory = memory or {"t": 0, "m": {k: np.zeros_like(v) for k, v in w.items()}, "v": {k: np.zeros_like(v) for k, v in w.items()}}
    h = np.zeros((streams, HIDDEN), dtype=np.float32)
    for at in range(0, length, WINDOW):
        grad, h, _ = gradients(w, h, read[:, at : at + WINDOW], want[:, at : at + WINDOW])
        memory["t"] += 1
        for k, g in grad.items():
            m, v = memory["m"][k], memory["v"][k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w[k] -= rate * (m / (1 - 0.9 ** memory["t"])) / (np.sqrt(v / (1 - 0.99 ** memory["t"])) + 1e-8)
    return memory


def class_scores(w: dict[str, np.ndarray], kinds: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 probability of each row's classes, the state carried through the row; rows go side by side, longest first."""
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    lengths = counts[order]
    out = np.zeros(len(counts))
    h, read = np.zeros((len(counts), HIDDEN), dtype=np.float32), np.full(len(counts), END, dtype=np.int64)
    live = len(counts)
    for t in range(int(lengths[0]) if len(lengths) else 0):
        while lengths[live - 1] <= t:
            live -= 1
        h = _step(w, h[:live], read[:live])[0]
        want = kinds[starts[:live] + t].astype(np.int64)
        out[:live] += _log_share(w, h)[np.arange(live), want]
        read = want
    back = np.empty(len(counts))
    back[order] = out / np.log(10)
    return back


# Jobs


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("token", pa.int64()), ("class", pa.int32()), ("n", pa.int64())])
    held: list[np.ndarray] = []
    kinds: list[np.ndarray] = []

    def summed() -> pa.RecordBatch:
        token, at, n = np.unique(np.concatenate(held), return_index=True, return_counts=True)
        kind = np.concatenate(kinds)[at]
        held.clear()
        kinds.clear()
        return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(kind.astype(np.int32)), pa.array(n)], schema=schema)

    for batch in batches:
        for _, _, data, offsets in chunks(batch):
            hashes, kind, _ = tokens(data, offsets)
            held.append(hashes)
            kinds.append(kind)
            if sum(map(len, held)) >= COUNTED_AT_ONCE:
                yield summed()
    if held:
        yield summed()


def count_words(training: DataFrame) -> DataFrame:
    """(token, class, n) over all texts."""
    counted = training.select("text").mapInArrow(_word_counts, "token long, class int, n long")
    return materialize(counted.groupBy("token").agg(F.min("class").alias("class"), F.sum("n").alias("n")), "word-counts")


_WEIGHTS = pa.schema([("name", pa.string()), ("place", pa.int32()), ("value", pa.float64()), ("tokens", pa.float64())])


def _local_training(shared, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = {k: v.copy() for k, v in shared.value.items()}
        held, seen, memory = [], 0, None
        for batch in batches:
            for _, _, data, offsets in chunks(batch):
                held.append(token_classes(data, offsets))
                if sum(map(len, held)) >= TRAINED_AT_ONCE:
                    memory = train(w, np.concatenate(held), rate, memory)
                    seen += sum(map(len, held))
                    held = []
        if held:
            train(w, np.concatenate(held), rate, memory)
            seen += sum(map(len, held))
        if seen:
            for k, v in w.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * v.size), pa.array(np.arange(v.size, dtype=np.int32)), pa.array(v.ravel().astype(np.float64) * seen), pa.array(np.full(v.size, float(seen)))], schema=_WEIGHTS
                )

    return run


def learn(training: DataFrame, shares: np.ndarray) -> dict[str, np.ndarray]:
    """Weights after ``ROUNDS`` rounds of training in all tasks and averaging; the output starts from the classes' shares."""
    context, w = training.sparkSession.sparkContext, fresh_weights()
    w["c"] = np.log(shares).astype(np.float32)
    for rate in RATES[:ROUNDS]:
        local = training.select("text").mapInArrow(_local_training(context.broadcast(w), rate), "name string, place int, value double, tokens double")
        for r in local.groupBy("name", "place").agg((F.sum("value") / F.sum("tokens")).alias("value")).collect():
            w[r["name"]].reshape(-1)[r["place"]] = r["value"]
    return w


_SCORED = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("counted", pa.float64()), ("model", pa.float64()), ("token", pa.int64()), ("times", pa.int64())]
)
SCORED = "row long, doc_id long, n_tokens long, n_known long, counted double, model double, token long, times long"


def _scored_rows(shared):
    """A row per document, and rows (row, token, times) of the words that are not common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, common, often, outside = shared.value
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            held: list[tuple] = []
            for chunk in chunks(batch):
                held.append((chunk[0], chunk[1], *tokens(chunk[2], chunk[3])))
                if sum(len(h[2]) for h in held) < SCORED_AT_ONCE and chunk[1] < batch.num_rows:
                    continue
                hashes, kinds, counts = (np.concatenate([h[k] for h in held]) for k in (2, 3, 4))
                first, end = held[0][0], held[-1][1]
                held = []
                row = np.repeat(np.arange(end - first), counts)
                n = np.zeros(len(hashes), dtype=np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
                    hit = common[at] == hashes
                    n[hit] = often[at[hit]]
                counted = np.bincount(row, weights=np.log10(n + 1), minlength=end - first)
                model = class_scores(w, kinds, counts) + np.bincount(row, weights=outside[kinds], minlength=end - first)
                known = np.bincount(row, weights=n > 0, minlength=end - first).astype(np.int64)
                rows = number + np.arange(end - first)
                number += end - first
                none = pa.nulls(end - first, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), batch.column("doc_id").slice(first, end - first), pa.array(counts.astype(np.int64)), pa.array(known), pa.array(counted), pa.array(model), none, none], schema=_SCORED
                )
                rare = np.flatnonzero(n == 0)
                if len(rare):
                    order = rare[np.lexsort((hashes[rare], row[rare]))]
                    h, r = hashes[order], row[order]
                    new = np.ones(len(h), dtype=bool)
                    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
                    starts = np.flatnonzero(new)
                    none = pa.nulls(len(starts), pa.int64())
                    flat = pa.nulls(len(starts), pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[r[starts]]), none, none, none, flat, flat, pa.array(h[starts].view(np.int64)), pa.array(np.diff(np.append(starts, len(h))))], schema=_SCORED
                    )

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row."""
    context = docs.sparkSession.sparkContext
    rows = docs.select("doc_id", "text")
    training = rows.where(F.col("doc_id").isNotNull() & ~held_out())
    vocabulary = count_words(training)
    totals = {r["class"]: (r["n"], r["v"]) for r in vocabulary.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    all_tokens, distinct = sum(n for n, _ in totals.values()), sum(v for _, v in totals.values())
    shares = np.array([totals.get(c, (0, 0))[0] + 1.0 for c in range(CLASSES)])
    outside = -np.log10([totals.get(c, (0, 0))[0] + totals.get(c, (0, 0))[1] + 1 for c in range(CLASSES)])
    most = vocabulary.orderBy(F.desc("n"), "token").limit(COMMON).select("token", "n").toArrow()
    common = most.column("token").to_numpy().view(np.uint64)
    order = np.argsort(common)
    shared = context.broadcast((learn(training, shares / shares.sum()), common[order], most.column("n").to_numpy()[order], outside))

    scored = materialize(rows.mapInArrow(_scored_rows(shared), SCORED), "scored")
    tail = (
        scored.where("token is not null").select("row", "token", "times").join(vocabulary.select("token", "n"), "token")
        .groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"), F.sum("times").alias("more_known"))
    )
    counted = F.col("counted") + F.coalesce("more", F.lit(0.0))
    return (
        scored.where("token is null").select("row", "doc_id", "n_tokens", "n_known", "counted", "model").join(tail, "row", "left")
        .select(
            "doc_id", held_out().alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(all_tokens).cast("long").alias("train_tokens"),
            (counted - F.col("n_tokens") * F.log10(F.lit(float(all_tokens + distinct + 1)))).alias("base_score"),
            (counted + F.col("model")).alias("score"),
        )
    )
