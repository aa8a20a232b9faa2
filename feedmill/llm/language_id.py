"""Language identification by a byte convolutional network.

A text in UTF-8 is cut into windows of fixed length. Filters of several widths slide over
the bytes of a window, each keeps its largest response, and a softmax over these maxima
gives the languages. A filter is a table of one weight a byte value and place, so its
response is a sum of table entries. The network is trained in numpy on a bounded sample of
labelled texts and applied to all windows of every text; a text's probabilities are the
mean over its windows, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from feedmill.llm.tables import free_name, in_steps

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
# Texts a label that training takes at most, and windows of each.
SAMPLE_TEXTS = 600
SAMPLE_WINDOWS = 3
# More labels than this are refused.
MOST_LABELS = 500
EPOCHS = 12
UNKNOWN = "und"


class ByteNetwork:
    """Filters ``w`` of each width (place, byte, filter), their biases and the last layer."""

    def __init__(self, labels: list[str], widths: tuple[int, ...] = WIDTHS, filters: int = FILTERS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.filters = [rng.normal(0, 0.1, (w, 256, filters)).astype(np.float32) for w in widths]
        total = filters * len(widths)
        self.last = rng.normal(0, 0.3, (total, len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), dtype=np.float32)
        self._pairs: list[list[np.ndarray]] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_pairs": None}

    def _responses(self, windows: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
        """Of each width, the responses (window, place, filter); places past the text get
        no response."""
        for table in self.filters:
            width = len(table)
            places = windows.shape[1] - width + 1
            total = table[0][windows[:, :places]]
            for k in range(1, width):
                total += table[k][windows[:, k:k + places]]
            short = lengths < windows.shape[1]
            if short.any():
                beyond = np.arange(places) > np.maximum(lengths[short], width)[:, None] - width
                part = total[short]
                part[beyond] = -1e9
                total[short] = part
            yield total

    def _pair_tables(self) -> list[list[np.ndarray]]:
        """Of each filter width, one table a pair of bytes, and one of the odd last byte."""
        if self._pairs is None:
            self._pairs = [
                [(table[k][:, None, :] + table[k + 1][None, :, :]).reshape(1 << 16, -1) if k + 1 < len(table) else table[k]
                 for k in range(0, len(table), 2)]
                for table in self.filters]
        return self._pairs

    def _maxima(self, windows: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
        """The largest response of each filter, by one table look-up for every two bytes."""
        pairs = windows[:, :-1].astype(np.intp) << 8 | windows[:, 1:]
        singles = windows.astype(np.intp)
        short = lengths < windows.shape[1]
        for table, parts in zip(self.filters, self._pair_tables(), strict=True):
            width = len(table)
            places = windows.shape[1] - width + 1
            total = None
            for k, part in zip(range(0, width, 2), parts, strict=True):
                found = part.take((pairs if len(part) > 256 else singles)[:, k:k + places], axis=0)
                total = found if total is None else np.add(total, found, out=total)
            if short.any():
                some = total[short]
                some[np.arange(places) > np.maximum(lengths[short], width)[:, None] - width] = -1e9
                total[short] = some
            yield total.max(axis=1)

    def probabilities(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Softmax over the labels, one row a window."""
        best = np.concatenate(list(self._maxima(windows, lengths)), axis=1)
        return _softmax(np.maximum(best, 0) @ self.last + self.bias)

    def train(self, windows: np.ndarray, lengths: np.ndarray, truth: np.ndarray, epochs: int = EPOCHS,
              batch: int = 128, rate: float = 0.01, seed: int = 11) -> None:
        """Adam on the cross entropy; a filter learns at the place of its maximum."""
        rng = np.random.default_rng(seed)
        share = np.bincount(truth, minlength=len(self.labels)).astype(np.float64)
        weight = (len(truth) / np.maximum(share, 1) / len(self.labels))[truth].astype(np.float32)
        params = [*self.filters, self.last, self.bias]
        first = [np.zeros_like(p) for p in params]
        second = [np.zeros_like(p) for p in params]
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(truth))
            for start in range(0, len(order), batch):
                rows = order[start:start + batch]
                x, n, y = windows[rows], lengths[rows], truth[rows]
                at, best = [], []
                for total in self._responses(x, n):
                    place = total.argmax(axis=1)
                    at.append(place)
                    best.append(np.take_along_axis(total, place[:, None, :], axis=1)[:, 0])
                raw = np.concatenate(best, axis=1)
                hidden = np.maximum(raw, 0)
                delta = _softmax(hidden @ self.last + self.bias)
                delta[np.arange(len(y)), y] -= 1
                delta *= weight[rows][:, None] / len(rows)
                back = (delta @ self.last.T) * (raw > 0)
                grads = []
                size = self.filters[0].shape[2]
                for j, (table, place) in enumerate(zip(self.filters, at, strict=True)):
                    grad = np.zeros_like(table)
                    own = back[:, j * size:(j + 1) * size]
                    columns = np.broadcast_to(np.arange(size), place.shape)
                    for k in range(len(table)):
                        np.add.at(grad[k], (np.take_along_axis(x, place + k, axis=1), columns), own)
                    grads.append(grad)
                grads += [hidden.T @ delta, delta.sum(axis=0)]
                step += 1
                pace = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for p, g, m, v in zip(params, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= pace * m / (np.sqrt(v) + 1e-8)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut_windows(data: bytes, window: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, the last one filled with zeros, and the bytes of each."""
    count = max(1, -(-len(data) // window))
    out = np.zeros(count * window, dtype=np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    lengths = np.full(count, window)
    lengths[-1] = len(data) - window * (count - 1)
    return out.reshape(count, window), lengths


def train_network(
    labelled: DataFrame, text_col: str, label_col: str, *, key: Column, sample_texts: int = SAMPLE_TEXTS,
    sample_windows: int = SAMPLE_WINDOWS, window: int = WINDOW,
) -> ByteNetwork | None:
    """Train on at most ``sample_texts`` texts of each label, those with the smallest hash
    of ``key`` and text, and ``sample_windows`` windows of each, spread over the text.

    A label with many texts is thinned by the hash before its smallest are taken, so that
    no task gathers all texts of a label. Null labels and texts without letters are left
    out; without labelled texts, or where none passes the thinning, there is no network.
    """
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(label_col).alias("label"), F.col(text_col).alias("text"), F.xxhash64(key, F.col(text_col)).alias("key"))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).limit(MOST_LABELS + 1).collect()}
    if not sizes:
        return None
    if len(sizes) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    names = sorted(sizes)
    # Twice the wanted share passes, and a few more where there is little to choose from.
    bound = F.lit(0)
    for name in names:
        bound = F.when(F.col("label") == name, F.lit(min(1_000_000, 1 + (2 * sample_texts + 100) * 1_000_000 // sizes[name]))).otherwise(bound)
    thin = rows.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < bound)
    length = F.length("text")
    parts = F.array(*[
        F.substring("text", (F.greatest(length - window, F.lit(0)) * k / max(1, sample_windows - 1)).cast("int") + 1, F.lit(window))
        for k in range(sample_windows)])
    ranked = thin.select("label", "key", parts.alias("parts")).withColumn(
        "n", F.row_number().over(Window.partitionBy("label").orderBy("key", "parts")))
    sample = ranked.where(F.col("n") <= sample_texts).orderBy("label", "n").collect()
    if not sample:
        return None
    windows, lengths, truth = [], [], []
    for row in sample:
        for part in dict.fromkeys(row["parts"]):
            cut, size = cut_windows(part.encode()[:window], window)
            windows.append(cut)
            lengths.append(size)
            truth.append(names.index(row["label"]))
    network = ByteNetwork(names)
    network.train(np.concatenate(windows), np.concatenate(lengths), np.array(truth))
    return network


def predict_language(
    docs: DataFrame, network: ByteNetwork | None, *, text_col: str = "text", window: int = WINDOW, batch: int = 128,
) -> DataFrame:
    """``docs`` with lang_pred and score, the mean probability of that language.

    A text that is null or has no letter is ``und`` with score 0, and so is every text
    where there was nothing to learn from. All windows of a text count, however long it is;
    at most ``batch`` are in work at once. Rows that repeat are judged alike; a column of
    ``docs`` named lang_pred or score is replaced.
    """
    kept = docs.drop("lang_pred", "score")
    place = kept.columns.index(text_col)

    def predict(texts: list[str | None], wanted: list[bool]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if network is None:
            return names, scores
        sums = np.zeros((len(texts), len(network.labels)))
        held: list[tuple[int, np.ndarray, np.ndarray]] = []
        count = 0

        def flush() -> None:
            nonlocal held, count
            if held:
                owner = np.concatenate([np.full(len(n), k) for k, _, n in held])
                lengths = np.concatenate([n for _, _, n in held])
                found = network.probabilities(np.concatenate([w for _, w, _ in held]), lengths)
                np.add.at(sums, owner, found * lengths[:, None])
            held, count = [], 0

        for k, text in enumerate(texts):
            if not wanted[k]:
                continue
            windows, lengths = cut_windows(text.encode(), window)
            for start in range(0, len(lengths), batch):
                held.append((k, windows[start:start + batch], lengths[start:start + batch]))
                count += len(held[-1][2])
                if count >= batch:
                    flush()
        flush()
        for k in np.nonzero(wanted)[0]:
            best = int(sums[k].argmax())
            names[k], scores[k] = network.labels[best], float(min(1.0, sums[k][best] / sums[k].sum()))
        return names, scores

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_steps(batches):
            names, scores = predict(b.column(place).to_pylist(), b.column(b.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*b.schema.names[:-1], "lang_pred", "score"])

    schema = kept.schema.add("lang_pred", "string").add("score", "double")
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return kept.withColumn(free_name(kept, "letters"), letters).mapInArrow(run, schema)
