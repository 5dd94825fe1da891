"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lymphlake.llm.common import id_crc32, map_text, pieces

#: Bounds of the training sample: windows a language, bytes a window, and the languages, the most frequent first.
TRAIN_WINDOWS, WINDOW, LANGUAGES = 768, 96, 256
HIDDEN, STEPS, BATCH, RATE, SEED = 8, 400, 96, 0.03, 7
#: Inference cuts texts into segments of so many bytes, and runs so many side by side.
SEGMENT, ROWS = 256, 512
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, n_positions long, agreement double"
UNKNOWN = "und"


@dataclass
class Network:
    """Weights of both directions (first axis), of the output layer, and the languages.

    ``table[d, byte]`` holds a byte's contribution to the update gate, the
    reset gate and the candidate; ``inner[d]`` the previous state's.
    """

    languages: list[str]
    table: np.ndarray  # 2 x 256 x 3H
    inner: np.ndarray  # 2 x H x 3H
    out: np.ndarray  # 2H x L
    bias: np.ndarray  # L

    def parameters(self) -> list[np.ndarray]:
        return [self.table, self.inner, self.out, self.bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _both_ways(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of each step for the two directions, 2 x T x B; the second reads a row from its end."""
    steps = np.arange(rows.shape[1])[:, None]
    backward = np.where(steps < lengths, lengths - 1 - steps, steps)
    return np.stack([np.broadcast_to(steps, backward.shape), backward])


def _loss_and_gradients(net: Network, rows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over all positions of full windows, and its gradients by backpropagation through time."""
    n, length = rows.shape
    hidden = net.inner.shape[1]
    order = _both_ways(rows, np.full(n, length))
    symbols = rows[np.arange(n), order]  # 2 x T x B
    gates_in = np.stack([net.table[d][symbols[d]] for d in range(2)])
    state = np.zeros((length + 1, 2, n, hidden), np.float32)
    kept = []
    for t in range(length):
        inner = state[t] @ net.inner
        zr = _sigmoid(gates_in[:, t, :, : 2 * hidden] + inner[..., : 2 * hidden])
        z, r = zr[..., :hidden], zr[..., hidden:]
        candidate = np.tanh(gates_in[:, t, :, 2 * hidden :] + r * inner[..., 2 * hidden :])
        state[t + 1] = candidate + z * (state[t] - candidate)
        kept.append((z, r, candidate, inner[..., 2 * hidden :]))
    forward = state[1:, 0]
    backward = state[1:, 1][::-1]  # full windows: position p is step T - 1 - p
    both = np.concatenate([forward, backward], axis=2)
    logits = both @ net.out + net.bias
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    loss = -float(np.log(p[:, np.arange(n), labels] + 1e-9).mean())
    p[:, np.arange(n), labels] -= 1
    p /= n * length
    grad_out = np.tensordot(both, p, axes=([0, 1], [0, 1]))
    grad_both = p @ net.out.T
    grad_state = np.stack([grad_both[..., :hidden], grad_both[::-1, :, hidden:]], axis=1)
    grad_in = np.empty_like(gates_in)
    grad_inner = np.zeros_like(net.inner)
    carried = np.zeros((2, n, hidden), np.float32)
    for t in range(length - 1, -1, -1):
        z, r, candidate, inner = kept[t]
        g = grad_state[t] + carried
        g_candidate = g * (1 - z) * (1 - candidate * candidate)
        g_z = g * (state[t] - candidate) * z * (1 - z)
        g_r = g_candidate * inner * r * (1 - r)
        grad_in[:, t, :, :hidden] = g_z
        grad_in[:, t, :, hidden : 2 * hidden] = g_r
        grad_in[:, t, :, 2 * hidden :] = g_candidate
        g_inner = np.concatenate([g_z, g_r, g_candidate * r], axis=2)
        grad_inner += state[t].transpose(0, 2, 1) @ g_inner
        carried = g * z + g_inner @ net.inner.transpose(0, 2, 1)
    grad_table = np.zeros_like(net.table)
    for d in range(2):
        np.add.at(grad_table[d], symbols[d].ravel(), grad_in[d].reshape(-1, 3 * hidden))
    return loss, [grad_table, grad_inner, grad_out.astype(np.float32), p.sum(axis=(0, 1)).astype(np.float32)]


def train(windows: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> Network:
    """Fit the network to windows of equal length; one Adam step a batch, languages drawn evenly."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    rows = np.frombuffer(b"".join(windows), np.uint8).reshape(len(windows), -1).astype(np.int64)
    y = np.array([languages.index(x) for x in labels])
    net = Network(
        languages,
        (rng.standard_normal((2, 256, 3 * hidden)) * 0.3).astype(np.float32),
        (rng.standard_normal((2, hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32),
        (rng.standard_normal((2 * hidden, len(languages))) / np.sqrt(2 * hidden)).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    members = [np.flatnonzero(y == i) for i in range(len(languages))]
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1):
        which = np.concatenate([rng.choice(m, -(-batch // len(members))) for m in members])
        _, gradients = _loss_and_gradients(net, rows[which], y[which])
        norm = np.sqrt(sum(float((g * g).sum()) for g in gradients))
        now = rate * (1 - step / (steps + 1))
        for p, g, m, v in zip(net.parameters(), gradients, first, second, strict=True):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def label_positions(net: Network, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Language probabilities of every byte, segment block by segment block.

    ``data`` is the bytes of many texts; segment i is ``lengths[i]`` bytes from
    ``starts[i]``. Yields ``(segments, valid, p)``: p is L x T x B, valid T x B.
    Segments run longest first, so at each step the live ones are a prefix and
    padding is never computed. All arrays of a step are gate by direction by
    segment by unit, so that numpy works on long runs of memory.
    """
    hidden, languages = net.inner.shape[1], len(net.languages)
    # tanh(x / 2) gives the gates, so the halving is done once, in the weights
    half = np.array([0.5, 0.5, 1.0], np.float32)[:, None, None]
    table = np.ascontiguousarray(net.table.reshape(512, 3, hidden).transpose(1, 0, 2) * half)
    inner = np.ascontiguousarray(net.inner.reshape(2, hidden, 3, hidden).transpose(2, 0, 1, 3) * half[..., None])
    order = np.argsort(-lengths, kind="stable")
    for block in range(0, len(order), ROWS):
        these = order[block : block + ROWS]
        n, long = len(these), lengths[these]
        length = int(long[0])
        at = _both_ways(np.empty((n, length)), long)
        symbols = data[np.minimum(starts[these] + at, len(data) - 1)].astype(np.int64)
        symbols[1] += 256
        symbols = np.ascontiguousarray(symbols.transpose(1, 0, 2))
        live = n - np.searchsorted(long[::-1], np.arange(1, length + 1), side="left")
        states = np.zeros((2, length, n, hidden), np.float32)
        state = np.zeros((2, n, hidden), np.float32)
        gates, mixed = np.empty((3, 2, n, hidden), np.float32), np.empty((3, 2, n, hidden), np.float32)
        for t in range(length):
            k = live[t]
            if k < state.shape[1]:
                state = np.ascontiguousarray(state[:, :k])
                gates, mixed = np.empty((3, 2, k, hidden), np.float32), np.empty((3, 2, k, hidden), np.float32)
            for g in range(3):
                table[g].take(symbols[t, :, :k], axis=0, out=gates[g], mode="clip")
            np.matmul(state, inner, out=mixed)
            zr, candidate = gates[:2], mixed[2]
            zr += mixed[:2]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            candidate *= zr[1]
            candidate += gates[2]
            np.tanh(candidate, out=candidate)
            state -= candidate
            state *= zr[0]
            state += candidate
            states[:, t, :k] = state
        weights = net.out.T
        p = weights[:, :hidden] @ states[0].reshape(-1, hidden).T
        backward = weights[:, hidden:] @ states[1].reshape(-1, hidden).T
        if long[-1] == length:
            p.reshape(languages, length, n)[:] += backward.reshape(languages, length, n)[:, ::-1]
        else:
            p += backward.take((at[1] * n + np.arange(n)).ravel(), axis=1)
        p += net.bias[:, None]
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        yield these, np.arange(length)[:, None] < long, p.reshape(languages, length, n)


def identify_texts(net: Network, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled language probabilities of each text, and how often each language labels a position."""
    sizes = np.diff(offsets)
    pieces_of = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(sizes)), pieces_of)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces_of) - pieces_of, pieces_of)
    starts = offsets[:-1][owner] + nth * SEGMENT
    lengths = np.minimum(SEGMENT, offsets[1:][owner] - starts)
    total, counted = np.zeros((len(net.languages), len(sizes))), np.zeros((len(net.languages), len(sizes)))
    for these, valid, p in label_positions(net, data, starts, lengths):
        label, mine = p.argmax(axis=0), owner[these]
        if not valid.all():
            p *= valid
            label[~valid] = -1
        for i in range(len(net.languages)):
            total[i] += np.bincount(mine, p[i].sum(axis=0, dtype=np.float64), len(sizes))
            counted[i] += np.bincount(mine, (label == i).sum(axis=0), len(sizes))
    return (total / np.maximum(1, sizes)).T, counted.T


def learned(docs: DataFrame, windows: int = TRAIN_WINDOWS, length: int = WINDOW, languages: int = LANGUAGES, **training) -> Network | None:
    """Train on a bounded sample of labelled texts; None if there is none.

    Rows count whose lang and text are not null and whose crc32(doc_id) mod 3
    is not 1. About ``windows`` texts a language are picked by a hash of id
    and text, and a window of ``length`` bytes is cut from each at a place
    picked by the same hash. Labels beyond the ``languages`` most frequent are
    not learned. The driver holds only these windows and counts.
    """
    rows = docs.where(F.col("lang").isNotNull() & (F.length("text") > 0) & (id_crc32(F.col("doc_id")) % 3 != 1))
    counts = dict(rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect())
    if not counts:
        return None
    mark = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text", F.lit(SEED)), F.lit(1 << 30))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, windows / n)])
    picked = rows.where(mark < share[F.col("lang")] * (1 << 30))
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit(SEED + 1)), F.greatest(F.lit(1), F.length("text") - length // 2)).cast("int") + 1
    sample = picked.select("lang", mark.alias("m"), F.substring("text", place, F.lit(length)).alias("window"))
    most = 4 * windows * len(counts)
    got = sorted(tuple(r) for r in sample.orderBy("m", "window").limit(most).collect())
    if not got:
        return None
    cut = []
    for _, _, window in got:
        data = window.encode("utf-8", "surrogatepass")
        cut.append((data * (length // len(data) + 1))[:length])
    return train(cut, [g[0] for g in got], **training)


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """Language of every whole text: see ``SCHEMA``.

    Needs ``doc_id, text``; no other column is read. Every byte is labelled by
    the network within its segment of 256 bytes, and a document's probability
    is the mean over its bytes; ``score`` is that of the predicted language,
    ``agreement`` the share of bytes labelled with it. A text that is null or
    has no letter (or if nothing could be learned) is ``und`` with score 0.
    Work is linear in bytes; a very long text is many segments, cut nowhere.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(id_crc32(F.col("doc_id")) % 3 == 1, F.lit(False)).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    if net is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.octet_length("text").cast("long").alias("n_positions"), F.lit(0.0).alias("agreement"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 4 << 20):
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            data = np.frombuffer(b"".join(texts) or b"\0", np.uint8)
            p, counted = identify_texts(net, data, offsets)
            known = np.array(batch.column("letters").to_pylist(), bool) & (sizes > 0)
            best = p.argmax(axis=1)
            row = np.arange(len(best))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([net.languages[i] if k else UNKNOWN for i, k in zip(best, known, strict=True)]),
                    pa.array(np.where(known, np.clip(p[row, best], 0, 1), 0.0)),
                    pa.array(sizes),
                    pa.array(np.where(known, counted[row, best] / np.maximum(1, sizes), 0.0)),
                ],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )

    return rows.mapInArrow(run, SCHEMA)


def keep_identified(docs: DataFrame, least: float = 1.2) -> DataFrame:
    """Rows of ``docs`` whose language the network tells with a score of at least ``least`` times chance.

    A score near one over the number of languages means that it cannot tell.
    Texts that are null, empty or without letters go. If no row is labelled
    there is no network, so nothing can be rejected and all rows stay. All
    columns stay; the texts are judged where they are read, without a join.
    """
    net = learned(docs)
    if net is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 4 << 20):
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
            p, _ = identify_texts(net, np.frombuffer(b"".join(texts) or b"\0", np.uint8), offsets)
            yield batch.filter(pa.array((p.max(axis=1) >= min(1.0, least / len(net.languages)) - 1e-9) & (np.diff(offsets) > 0)))

    return map_text(docs.where(F.col("text").rlike(r"\p{L}")), run)
