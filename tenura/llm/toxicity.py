"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained and applied in numpy.

A word enters as its own embedding (known words) beside the mean embedding of its character trigrams, so that unknown
spellings have an input too. Windows of `WINDOW` words overlap by half and cover the whole text; a document scores by
its strongest window, turned into a chance on the training documents. Labels are of documents, so training picks the
window of a toxic document that stands out (first by word odds, then by the network's own score) and, of the others,
random windows and the strongest one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import keeps, starts_task, text_of

WORD = re.compile(r"\w+")
WINDOW, STRIDE = 32, 16
HIDDEN, WORD_DIM, CHAR_DIM, ATTEND = 8, 16, 12, 8
TRIGRAMS = 1 << 12
#: A longer run of letters, as texts without spaces have, becomes overlapping words of this length.
LONGEST = 40


def words_of(text: str) -> list[str]:
    words = WORD.findall(text.lower())
    if max(map(len, words), default=0) <= LONGEST:
        return words
    return [word[k:k + LONGEST] for word in words for k in range(0, max(1, len(word) - LONGEST // 2), LONGEST // 2)]


class Grams(dict):
    """Place of a character trigram in the table, found once for each."""

    def __missing__(self, gram: str) -> int:
        self[gram] = found = zlib.crc32(gram.encode()) % TRIGRAMS
        return found


GRAMS = Grams()


def trigrams(word: str) -> list[int]:
    padded = f"^{word}$"
    return [GRAMS[padded[k:k + 3]] for k in range(len(padded) - 2)]


def window_starts(words: int) -> np.ndarray:
    """Starts of overlapping windows; the last one ends with the text."""
    if words <= WINDOW:
        return np.zeros(1, dtype=np.int64)
    starts = np.arange(0, words - WINDOW, STRIDE, dtype=np.int64)
    return np.append(starts, words - WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Inputs:
    """Distinct words as numbers, with their known-word index and trigrams; number 0 is padding."""

    def __init__(self, known: dict[str, int]):
        self.known, self.number, self.index, self.grams = known, {"": 0}, [0], [[]]

    def __call__(self, words: list[str]) -> np.ndarray:
        number = self.number
        for word in set(words).difference(number):
            number[word] = len(self.index)
            self.index.append(self.known.get(word, 0))
            self.grams.append(trigrams(word))
        return np.fromiter(map(number.__getitem__, words), dtype=np.int32, count=len(words))

    def flat(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of some numbers: known-word index, all trigrams, and how many each has."""
        grams = [self.grams[k] for k in numbers.tolist()]
        sizes = np.array([len(g) for g in grams], dtype=np.int64)
        return np.array([self.index[k] for k in numbers.tolist()], dtype=np.int64), np.array([x for g in grams for x in g], dtype=np.int64), sizes


class Network:
    """Parameters and passes; `parts` are the arrays the optimiser moves."""

    def __init__(self, known: int, seed: int):
        random = np.random.default_rng(seed)
        size = WORD_DIM + CHAR_DIM

        def normal(*shape: int, scale: float = 0.1) -> np.ndarray:
            return (random.standard_normal(shape) * scale).astype(np.float32)

        self.parts = {"word": normal(known + 1, WORD_DIM), "gram": normal(TRIGRAMS, CHAR_DIM),
                      "attend": normal(2 * HIDDEN, ATTEND, scale=0.3), "attend_b": np.zeros(ATTEND, np.float32), "query": normal(ATTEND, scale=0.3),
                      "out": normal(2 * HIDDEN, scale=0.3), "out_b": np.zeros(1, np.float32)}
        for way in ("f", "b"):
            self.parts |= {f"in_{way}": normal(size, 3 * HIDDEN, scale=size ** -0.5), f"bias_{way}": np.zeros(3 * HIDDEN, np.float32),
                           f"gates_{way}": normal(HIDDEN, 2 * HIDDEN, scale=HIDDEN ** -0.5), f"new_{way}": normal(HIDDEN, HIDDEN, scale=HIDDEN ** -0.5)}

    def embed(self, index: np.ndarray, grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Input of each word: its own embedding (zero for unknown words) beside the mean of its trigrams."""
        own = self.parts["word"][index] * (index > 0)[:, None]
        total = np.zeros((len(index), CHAR_DIM), dtype=np.float32)
        filled = np.flatnonzero(sizes)
        if len(filled):
            begin = np.concatenate(([0], sizes.cumsum()[:-1]))[filled]
            total[filled] = np.add.reduceat(self.parts["gram"][grams], begin, axis=0) / sizes[filled, None]
        return np.concatenate([own, total], axis=1)

    def projected(self, inputs: np.ndarray) -> np.ndarray:
        """Both directions' input terms of the words, side by side: what a scoring pass gathers."""
        p = self.parts
        return np.concatenate([inputs @ p["in_f"] + p["bias_f"], inputs @ p["in_b"] + p["bias_b"]], axis=1)

    def score(self, terms: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Logits of windows (words as rows of `terms`, 0 for padding), each direction step by step over all windows."""
        p, (n, steps) = self.parts, windows.shape
        words = np.ascontiguousarray(windows.T)
        there = words > 0
        whole = there.all(axis=1)
        states = np.empty((steps, n, 2 * HIDDEN), dtype=np.float32)
        for at, (way, order) in enumerate((("f", range(steps)), ("b", range(steps - 1, -1, -1)))):
            own = terms[:, at * 3 * HIDDEN:(at + 1) * 3 * HIDDEN]
            recurrent = np.concatenate([0.5 * p[f"gates_{way}"], p[f"new_{way}"]], axis=1)
            h = np.zeros((n, HIDDEN), dtype=np.float32)
            for t in order:
                x, inner = own[words[t]], h @ recurrent
                gates = x[:, :2 * HIDDEN] * np.float32(0.5)
                gates += inner[:, :2 * HIDDEN]
                np.tanh(gates, out=gates)  # sigmoid by tanh
                gates *= np.float32(0.5)
                gates += np.float32(0.5)
                new = inner[:, 2 * HIDDEN:]
                new *= gates[:, :HIDDEN]
                new += x[:, 2 * HIDDEN:]
                new = np.tanh(new)
                h = (h - new) * gates[:, HIDDEN:] + new
                if not whole[t]:
                    h *= there[t][:, None]
                states[t, :, at * HIDDEN:(at + 1) * HIDDEN] = h
        keys = np.tanh(states @ p["attend"] + p["attend_b"]) @ p["query"]
        if not whole.all():
            keys = np.where(there, keys, -30.0)
        weights = np.exp(keys - keys.max(axis=0))
        weights /= weights.sum(axis=0)
        return (states @ p["out"] * weights).sum(axis=0) + p["out_b"][0]

    def gradients(self, inputs: np.ndarray, windows: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the mean cross-entropy, and that by `inputs`."""
        p, (n, steps) = self.parts, windows.shape
        there = (windows.T > 0).astype(np.float32)[:, :, None]
        states, kept = np.empty((steps, n, 2 * HIDDEN), np.float32), {}
        for way, order in (("f", list(range(steps))), ("b", list(range(steps - 1, -1, -1)))):
            terms, at = inputs @ p[f"in_{way}"] + p[f"bias_{way}"], 0 if way == "f" else HIDDEN
            h, kept[way] = np.zeros((n, HIDDEN), np.float32), []
            for t in order:
                x = terms[windows[:, t]]
                gates = _sigmoid(x[:, :2 * HIDDEN] + h @ p[f"gates_{way}"])
                reset, update = gates[:, :HIDDEN], gates[:, HIDDEN:]
                inner = h @ p[f"new_{way}"]
                new = np.tanh(x[:, 2 * HIDDEN:] + reset * inner)
                after = ((1 - update) * new + update * h) * there[t]
                kept[way].append((t, h, reset, update, inner, new))
                states[t, :, at:at + HIDDEN] = h = after
        hidden = np.tanh(states @ p["attend"] + p["attend_b"])
        keys = np.where(there[:, :, 0] > 0, hidden @ p["query"], -30.0)
        weights = np.exp(keys - keys.max(axis=0))
        weights /= weights.sum(axis=0)
        pooled = (states * weights[:, :, None]).sum(axis=0)
        logits = pooled @ p["out"] + p["out_b"][0]
        d_logit = ((_sigmoid(logits) - labels) * importance / n).astype(np.float32)
        grads = {"out": pooled.T @ d_logit, "out_b": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * p["out"]
        d_states = weights[:, :, None] * d_pooled
        d_weights = (states * d_pooled).sum(axis=2)
        d_keys = (weights * (d_weights - (weights * d_weights).sum(axis=0)) * there[:, :, 0]).astype(np.float32)
        grads["query"] = np.einsum("tna,tn->a", hidden, d_keys)
        d_hidden = d_keys[:, :, None] * p["query"] * (1 - hidden ** 2)
        grads["attend"] = np.einsum("tnh,tna->ha", states, d_hidden)
        grads["attend_b"] = d_hidden.sum(axis=(0, 1))
        d_states = d_states + d_hidden @ p["attend"].T
        d_inputs = np.zeros_like(inputs)
        places = windows.T.ravel()
        order_of = np.argsort(places, kind="stable")
        words, first = np.unique(places[order_of], return_index=True)
        for way in ("f", "b"):
            at, d_h = 0 if way == "f" else HIDDEN, np.zeros((n, HIDDEN), np.float32)
            d_gates_w, d_new_w = np.zeros_like(p[f"gates_{way}"]), np.zeros_like(p[f"new_{way}"])
            d_steps = np.empty((steps, n, 3 * HIDDEN), np.float32)
            for t, h, reset, update, inner, new in reversed(kept[way]):
                d_after = (d_h + d_states[t, :, at:at + HIDDEN]) * there[t]
                d_new = d_after * (1 - update) * (1 - new ** 2)
                d_gate = np.concatenate([d_new * inner * reset * (1 - reset), d_after * (h - new) * update * (1 - update)], axis=1)
                d_inner = d_new * reset
                d_gates_w += h.T @ d_gate
                d_new_w += h.T @ d_inner
                d_h = d_after * update + d_gate @ p[f"gates_{way}"].T + d_inner @ p[f"new_{way}"].T
                d_steps[t, :, :2 * HIDDEN], d_steps[t, :, 2 * HIDDEN:] = d_gate, d_new
            d_terms = np.zeros((len(inputs), 3 * HIDDEN), np.float32)
            d_terms[words] = np.add.reduceat(d_steps.reshape(-1, 3 * HIDDEN)[order_of], first, axis=0)
            grads |= {f"gates_{way}": d_gates_w, f"new_{way}": d_new_w, f"in_{way}": inputs.T @ d_terms, f"bias_{way}": d_terms.sum(axis=0)}
            d_inputs += d_terms @ p[f"in_{way}"].T
        return grads, d_inputs


class Model:
    """A trained network, its known words and the line from the strongest window's logit to the document's."""

    def __init__(self, known: dict[str, int], network: Network, slope: float = 1.0, offset: float = 0.0):
        self.known, self.network, self.slope, self.offset = known, network, slope, offset
        self.inputs, self.terms = None, None  # words met by this worker

    def logits(self, texts: list[str], batch: int = 1024, most: int = 100_000) -> np.ndarray:
        """The strongest window's logit of each text; windows of many texts pass together, a long text in several passes.
        The input terms of at most about `most` distinct words are kept meanwhile."""
        best = np.full(len(texts), -np.inf)
        numbers, owners, held = [], [], 0

        def flush() -> None:
            nonlocal numbers, owners, held
            if held:
                inputs, done = self.inputs, len(self.terms)
                if len(inputs.index) > done:
                    new = self.network.projected(self.network.embed(*inputs.flat(np.arange(done, len(inputs.index)))))
                    self.terms = np.concatenate([self.terms, new])
                windows, owner = np.concatenate(numbers), np.concatenate(owners)
                for at in range(0, len(windows), batch):
                    part = slice(at, at + batch)
                    np.maximum.at(best, owner[part], self.network.score(self.terms, windows[part]))
            numbers, owners, held = [], [], 0

        for n, text in enumerate(texts):
            if self.inputs is None or len(self.inputs.index) > most:
                flush()
                self.inputs, self.terms = Inputs(self.known), np.zeros((0, 6 * HIDDEN), np.float32)
            words = self.inputs(words_of(text))
            starts = window_starts(len(words))
            if len(words) < WINDOW:
                words = np.concatenate([words, np.zeros(WINDOW - len(words), np.int32)])
            for at in range(0, len(starts), batch):
                part = starts[at:at + batch]
                numbers.append(words[part[:, None] + np.arange(WINDOW)])
                owners.append(np.full(len(part), n))
                held += len(part)
                if held >= 8 * batch:
                    flush()
        flush()
        return best

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(texts) + self.offset, -30, 30)))


def train(texts: list[str], labels: list[int], seed: int = 3, epochs: int = 5, rounds: int = 3, batch: int = 128,
          most_known: int = 8_000, least_steps: int = 120) -> Model:
    """Trains on a sample of labelled texts, each round for `epochs` passes and at least `least_steps` steps. Without texts of both labels every score is the share of toxic ones."""
    toxic = np.array(labels, dtype=bool)
    share = (toxic.sum() + 1) / (len(toxic) + 2)
    random = np.random.default_rng(seed)
    words = [words_of(text) for text in texts]
    seen, bad = Counter(), Counter()
    for own, label in zip(words, toxic):
        seen.update(set(own))
        if label:
            bad.update(set(own))
    known = {word: k + 1 for k, (word, n) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:most_known]) if n > 1}
    network = Network(len(known), seed)
    if toxic.all() or not toxic.any():
        return Model(known, network, 0.0, float(np.log(share / (1 - share))))
    good_docs, bad_docs = (~toxic).sum(), toxic.sum()
    odds = {w: np.log((bad[w] + 0.5) / (bad_docs + 1)) - np.log((seen[w] - bad[w] + 0.5) / (good_docs + 1)) for w in seen}
    inputs = Inputs(known)
    ids = [inputs(own) for own in words]
    padded = [np.concatenate([x, np.zeros(max(0, WINDOW - len(x)), np.int32)]) for x in ids]
    starts = [window_starts(len(x)) for x in ids]
    cut = lambda n, start: padded[n][start:start + WINDOW]
    index, grams, sizes = inputs.flat(np.arange(len(inputs.index)))
    begin = np.concatenate(([0], sizes.cumsum()))
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in network.parts.items()}
    step = 0
    strongest = None
    for _ in range(rounds):
        if strongest is None:  # by the word with the highest odds
            peaks = [max(range(len(own)), key=lambda k: odds[own[k]], default=0) for own in words]
            chosen = [int(np.clip(peak - WINDOW // 2, 0, max(0, len(own) - WINDOW))) for peak, own in zip(peaks, words)]
        else:
            chosen = strongest
        windows_each = len(texts) + 2 * int((~toxic).sum())
        for _ in range(max(epochs, -(-least_steps * batch // windows_each))):
            picked = [(n, chosen[n]) for n in range(len(texts))]
            # jitter keeps the network from learning a place in the window
            jitter = random.integers(-WINDOW // 2, WINDOW // 2 + 1, len(picked))
            last = [max(0, len(x) - WINDOW) for x in ids]
            picked = [(n, int(np.clip(s + jitter[n], 0, last[n]))) if toxic[n] and strongest is None else (n, s) for n, s in picked]
            picked += [(n, int(random.choice(starts[n]))) for n in np.flatnonzero(~toxic).tolist() for _ in range(2)]
            order = random.permutation(len(picked))
            for at in range(0, len(order), batch):
                part = [picked[k] for k in order[at:at + batch]]
                windows = np.stack([cut(n, s) for n, s in part])
                target = toxic[[n for n, _ in part]].astype(np.float32)
                used, place = np.unique(windows, return_inverse=True)
                place = place.reshape(windows.shape)
                if used[0]:
                    used, place = np.concatenate(([0], used)), place + 1
                own_grams = np.concatenate([grams[begin[k]:begin[k + 1]] for k in used.tolist()])
                embedded = network.embed(index[used], own_grams, sizes[used])
                grads, d_inputs = network.gradients(embedded, place, target, np.where(target > 0, 2.0, 1.0))
                grads["word"] = np.zeros_like(network.parts["word"])
                np.add.at(grads["word"], index[used], d_inputs[:, :WORD_DIM] * (index[used] > 0)[:, None])
                grads["gram"] = np.zeros_like(network.parts["gram"])
                np.add.at(grads["gram"], own_grams, np.repeat(d_inputs[:, WORD_DIM:] / np.maximum(sizes[used], 1)[:, None], sizes[used], axis=0))
                step += 1
                for name, grad in grads.items():
                    first, second = moments[name]
                    grad = np.clip(grad, -1, 1) + 1e-5 * network.parts[name]
                    first += 0.1 * (grad - first)
                    second += 0.01 * (grad ** 2 - second)
                    network.parts[name] -= (0.01 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
        terms = network.projected(network.embed(index, grams, sizes))
        strongest, peak = [], np.empty(len(texts))
        flat = np.stack([cut(n, s) for n in range(len(texts)) for s in starts[n]])
        scores = np.concatenate([network.score(terms, flat[at:at + 4096]) for at in range(0, len(flat), 4096)])
        at = 0
        for n, own in enumerate(starts):
            best = int(scores[at:at + len(own)].argmax())
            strongest.append(int(own[best]))
            peak[n] = scores[at + best]
            at += len(own)
    return Model(known, network, *_line(peak, toxic))


def _line(x: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the labels on the logits, by Newton steps with a small ridge; the slope stays positive."""
    design = np.stack([x / 4, np.ones_like(x)], axis=1)
    weights = np.zeros(2)
    target = np.where(toxic, (toxic.sum() + 1) / (toxic.sum() + 2), 1 / ((~toxic).sum() + 2))
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        curve = (design * (chance * (1 - chance))[:, None]).T @ design + 1e-2 * np.eye(2)
        weights += np.clip(np.linalg.solve(curve, design.T @ (target - chance) - 1e-2 * weights), -2, 2)
    return float(max(weights[0], 1e-3) / 4), float(weights[1])


def held_out() -> Column:
    """The fold no label is learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, sample: int = 1600, most_chars: int = 8000, seed: int = 3) -> Model:
    """Trains on at most `sample` toxic and `sample` other labelled documents of at most `most_chars` characters, those
    with the lowest hash of the id, never from the held-out fold. Rows without id or label are left out."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).dropDuplicates(["doc_id"]).where(~held_out())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("body")).where(F.length("body") <= most_chars)
    usable = marked.join(rows.select("doc_id").distinct(), "doc_id")  # ids only: texts are read once the sample is known
    order = F.xxhash64("doc_id", F.lit(seed))
    chosen = [usable.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(sample) for label in (1, 0)]
    # at most twice `sample` rows
    texts = rows.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").groupBy("doc_id", "toxic").agg(F.min("body").alias("body"))
    found = sorted(((r["doc_id"], r["body"], r["toxic"]) for r in texts.collect()))
    return train([body for _, body, _ in found], [toxic for _, _, toxic in found], seed)


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """One row per row of `docs`: doc_id, text_mark (64-bit hash of the text), held_out, score, predicted.

    The score is of the text alone. Null and empty texts are one window of padding; a null id is in no fold
    (`held_out` false); repeated rows score alike; other columns are not read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts_task("trigrams")
        keeps("trigrams", GRAMS.clear)
        for batch in batches:
            found = model.scores(batch["body"].tolist()) if len(batch) else np.zeros(0)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text_mark": batch["text_mark"], "held_out": batch["held_out"], "score": found})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_mark"),
                       F.coalesce(held_out(), F.lit(False)).alias("held_out"), text_of().alias("body"))
    scored = rows.mapInPandas(run, "doc_id long, text_mark long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of `docs` that score below the threshold, with all their columns, in one pass and without a join."""
    import pyarrow as pa

    name = "_tx_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts_task("trigrams")
        keeps("trigrams", GRAMS.clear)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(name)).to_pylist()
            keep = model.scores(texts) < threshold if texts else np.zeros(0, dtype=bool)
            rest = [n for n, field in enumerate(batch.schema.names) if field != name]
            yield batch.select(rest).filter(pa.array(keep, pa.bool_()))

    return docs.withColumn(name, text_of()).mapInArrow(run, docs.schema)
