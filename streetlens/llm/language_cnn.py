"""Language of a text by a convolutional network on bytes, trained in numpy.

Texts are cut into windows of ``WINDOW`` bytes (A-Z lower-cased) that overlap by
the widest filter less one, so every byte sequence of a text is seen. A byte
becomes a small vector; filters of several widths run over the window; the
largest response of each filter goes through a softmax. A text's probabilities
are the mean of its windows', weighted by their bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetlens.llm.tables import text_batches
from streetlens.llm.words import LOWER, text_buffers

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12  # of each width
VECTOR = 8
SPAN = max(WIDTHS)
STEP = WINDOW - SPAN + 1
SAMPLE = 2000  # documents to learn from, over all languages; the documented bound of the training sample
SAMPLE_WINDOWS = 6  # of one document, spread over its whole text
UNKNOWN = "und"
BATCH = 256


@dataclass
class Network:
    labels: list[str]
    vectors: np.ndarray  # byte, VECTOR
    kernel: np.ndarray  # SPAN * VECTOR, filter
    offset: np.ndarray  # filter
    weights: np.ndarray  # filter, label
    bias: np.ndarray  # label

    def responses(self, windows: np.ndarray) -> np.ndarray:
        """(window, position, filter)"""
        embedded = self.vectors[windows].reshape(len(windows), -1)
        seen = np.lib.stride_tricks.sliding_window_view(embedded, SPAN * VECTOR, axis=1)[:, ::VECTOR]
        return (seen.reshape(-1, SPAN * VECTOR) @ self.kernel).reshape(len(windows), -1, self.kernel.shape[1])

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        pooled = np.maximum(self.responses(windows).max(axis=1) + self.offset, 0)
        return _softmax(pooled @ self.weights + self.bias)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, row, bytes in the window) of the texts ``data[offsets[i]:offsets[i + 1]]``; empty texts have none."""
    size = np.diff(offsets)
    many = np.where(size > 0, np.maximum(1, -(-(size - SPAN + 1) // STEP)), 0)
    row = np.repeat(np.arange(len(size)), many)
    within = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    start = offsets[:-1][row] + within * STEP
    length = np.minimum(WINDOW, offsets[1:][row] - start)
    padded = np.append(LOWER[data], np.zeros(WINDOW, np.uint8))
    windows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start]
    return np.where(np.arange(WINDOW) < length[:, None], windows, np.uint8(0)), row, length


def train(windows: np.ndarray, label: np.ndarray, labels: list[str], epochs: int = 8, rate: float = 4e-3, seed: int = 7) -> Network:
    """Fit the network by gradient steps (Adam) on the cross entropy."""
    rng = np.random.default_rng(seed)
    n_filters = FILTERS * len(WIDTHS)
    reach = np.zeros((SPAN * VECTOR, n_filters), np.float32)
    for k, width in enumerate(WIDTHS):
        reach[: width * VECTOR, k * FILTERS : (k + 1) * FILTERS] = 1
    net = Network(
        labels,
        rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32),
        (rng.normal(0, 0.3, (SPAN * VECTOR, n_filters)) * reach).astype(np.float32),
        np.zeros(n_filters, np.float32),
        rng.normal(0, 0.1, (n_filters, len(labels))).astype(np.float32),
        np.zeros(len(labels), np.float32),
    )
    net.vectors[0] = 0  # padding
    values = [net.vectors, net.kernel, net.offset, net.weights, net.bias]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), 128):
            pick = order[at : at + 128]
            x, y = windows[pick], label[pick]
            responses = net.responses(x)
            best = responses.argmax(axis=1)  # window, filter
            top = np.take_along_axis(responses, best[:, None], axis=1)[:, 0] + net.offset
            pooled = np.maximum(top, 0)
            error = _softmax(pooled @ net.weights + net.bias)
            error[np.arange(len(y)), y] -= 1
            error /= len(y)
            back = (error @ net.weights.T) * (top > 0)
            seen = x[np.arange(len(x))[:, None, None], best[:, :, None] + np.arange(SPAN)]  # window, filter, byte
            looked = net.vectors[seen].reshape(len(x), n_filters, -1)
            d_kernel = np.einsum("bf,bfk->kf", back, looked) * reach
            d_seen = (back[:, :, None] * net.kernel.T[None]).reshape(-1, VECTOR)
            d_vectors = np.stack([np.bincount(seen.ravel(), d_seen[:, v], 256) for v in range(VECTOR)], axis=1)
            d_vectors[0] = 0
            step += 1
            for k, g in enumerate((d_vectors, d_kernel, back.sum(axis=0), pooled.T @ error, error.sum(axis=0))):
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                scale = rate * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                values[k] -= (scale * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return net


def _sample_windows(batches):
    for batch in batches:
        data, off = text_buffers(batch["text"])
        windows, row, length = cut_windows(data[off[0] : off[-1]], off - off[0])
        count = np.bincount(row, minlength=batch.num_rows)
        rank = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        many = np.minimum(count, SAMPLE_WINDOWS)
        # evenly over the whole text
        keep = (rank * many[row] // count[row]) != ((rank - 1) * many[row] // count[row])
        ends = np.append(0, np.cumsum(many) * WINDOW).astype(np.int32)
        seen = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(windows[keep].tobytes())])
        yield pa.RecordBatch.from_arrays([batch["lang"], batch["_hash"], batch["_text"], seen], names=["lang", "_hash", "_text", "bytes"])


def learn(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """A network from at most ``sample`` documents, spread evenly over the languages; None without a labelled document.

    Learns from text and lang of rows whose crc32(doc_id as text) mod 3 is not 1.
    Of every language the documents of least hash are taken. Rows are counted,
    not ids, so rows that repeat an id stay within the bound; of more than
    ``sample`` languages the most frequent are learnt. Only documents whose hash
    is below a bound that follows from the language's number of ids are ranked.
    """
    rows = docs.select(
        F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id").alias("_hash"), F.xxhash64("text").alias("_text")
    ).filter((F.crc32(docs["doc_id"].cast("string")) % 3 != 1) & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("_hash").alias("ids"))
    found = sizes.orderBy(F.desc("rows"), "lang").limit(sample).collect()
    if not found:
        return None
    each = sample // len(found)
    bounds = [(r["lang"], min(2**63 - 1, int(-(2**63) + 2**64 * (2 * each + 64) / r["ids"]))) for r in found]
    few = rows.join(F.broadcast(docs.sparkSession.createDataFrame(bounds, "lang string, _bound long")), "lang").filter("_hash <= _bound")
    seen = few.select("lang", "_hash", "_text", "text").mapInArrow(_sample_windows, "lang string, _hash long, _text long, bytes binary")
    order = Window.partitionBy("lang").orderBy("_hash", "_text")
    taken = seen.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= each).select("lang", "bytes").toArrow()
    pairs = sorted(  # the order of rows must not matter
        (lang, seen[i : i + WINDOW])
        for lang, seen in zip(taken["lang"].to_pylist(), taken["bytes"].to_pylist()) for i in range(0, len(seen), WINDOW)
    )
    labels = sorted({p[0] for p in pairs})
    number = {name: k for k, name in enumerate(labels)}
    return train(
        np.frombuffer(b"".join(p[1] for p in pairs), np.uint8).reshape(-1, WINDOW), np.array([number[p[0]] for p in pairs]), labels
    )


def _predict(net: Network | None, names: list[str]):
    def run(batches):
        for batch in batches:
            data, off = text_buffers(batch["_text"])
            lettered = batch["_lettered"].to_numpy(zero_copy_only=False)
            many = len(net.labels) if net else 1
            share = np.zeros((batch.num_rows, many))
            i = 0
            while net and i < batch.num_rows:
                j = min(batch.num_rows, max(i + 1, int(np.searchsorted(off, off[i] + (1 << 20), "right")) - 1))
                windows, row, length = cut_windows(data[off[i] : off[j]], off[i : j + 1] - off[i])
                for at in range(0, len(windows), BATCH):
                    part = slice(at, at + BATCH)
                    p = net.probabilities(windows[part]) * length[part, None]
                    for c in range(many):
                        share[i:j, c] += np.bincount(row[part], p[:, c], j - i)
                i = j
            total = share.sum(axis=1)
            some = lettered & (total > 0)
            best = share.argmax(axis=1)
            score = np.where(some, share.max(axis=1) / np.where(total > 0, total, 1), 0.0)
            names_of = np.array(net.labels if net else [UNKNOWN], dtype=object)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(np.where(some, names_of[best], UNKNOWN), pa.string()), pa.array(np.clip(score, 0, 1))],
                names=[*names, "lang_pred", "score"],
            )

    return run


def identify_language(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """``docs`` (doc_id, text, lang, any more) with held_out, lang_pred and score.

    The network is learnt from ``docs`` unless given (lang is not needed then).
    lang_pred is a learned label, or ``und`` with score 0 if the text is null or
    has no letter or nothing was learned. held_out tells rows whose
    crc32(doc_id as text) mod 3 is 1, false for a null doc_id. lang, source and
    doc_id do not enter a prediction. Columns of ``docs`` named like a result
    are replaced. Learning runs jobs.
    """
    text_batches(docs)
    net = learn(docs) if net is None else net
    docs = docs.drop("held_out", "lang_pred", "score", "_text", "_lettered").withColumn(
        "held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    )
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.select(
        *names, F.col("text").cast("string").alias("_text"), F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("_lettered")
    ).mapInArrow(_predict(net, names), f"{schema}, lang_pred string, score double")
