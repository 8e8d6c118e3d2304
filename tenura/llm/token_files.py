"""Token ids in files of Re-Pair grammars.

Documents are dealt to tasks by ranges of doc_id and written in that order. Each shard (a bounded number of ids, whole
documents) is one row of a Parquet table: a binary payload with its grammar, the length of every rule's expansion and
the place of every document, so that one document can be decoded without the others.

Payload, little-endian: 4 bytes `RPG1`; int64 x 5: base (first nonterminal), rules, documents, symbols, symbol width in
bytes; then left and right of each rule (uint32), expansion length of each rule (uint32), ids of the documents with a
null flag (int64, uint8), first symbol of each document and the end (int64), first id of each and the end (int64), symbols.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.common import saved, text_of, vocabulary
from tenura.llm.word_ids import encoder

SHARD = "part int, shard int, documents long, ids long, payload binary"
MAGIC = b"RPG1"
HASH_BITS = 18


def grammar(ids: np.ndarray, ends: np.ndarray, base: int, most_rules: int, rounds: int = 12,
            least: int = 4, each_round: int = 4096) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, last flags, rules): frequent pairs replaced by nonterminals from `base` on, round by round.

    `ends` flags the last id of each document; no pair crosses it. A round replaces its most frequent pairs together,
    from left to right, and the next one counts anew; it ends when no pair occurs `least` times, the round saves less
    than one symbol in 200, or `most_rules` are made.
    """
    x, last = ids.astype(np.uint32), ends.copy()
    made: list[np.ndarray] = []
    rules = 0
    for _ in range(rounds):
        if len(x) < 2 * least or rules >= most_rules:
            break
        hashed = ((x[:-1] * np.uint32(2654435761) + x[1:] * np.uint32(2246822519)) >> np.uint32(32 - HASH_BITS)).astype(np.intp)
        held = np.bincount(hashed, minlength=1 << HASH_BITS)
        # a pair is at most as frequent as its hash: the most frequent pairs are behind the most frequent hashes
        floor = max(least, int(np.partition(held, -2 * each_round)[-2 * each_round]))
        while True:
            at = np.flatnonzero((held >= floor)[hashed] & ~last[:-1])
            pair = x[at].astype(np.uint64) << np.uint64(32) | x[at + 1]
            ordered = np.sort(pair)
            first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(ordered)))
            chosen = np.flatnonzero(count >= least)
            if len(chosen) or floor == least:
                break
            floor = least
        room = min(each_round, most_rules - rules)
        if len(chosen) > room:
            chosen = np.sort(chosen[np.argsort(-count[chosen], kind="stable")[:room]])
        if not len(chosen):
            break
        wanted = ordered[first[chosen]]
        rule = np.minimum(np.searchsorted(wanted, pair), len(wanted) - 1)
        hit = wanted[rule] == pair
        at, rule = at[hit], rule[hit]
        run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, np.arange(len(at)), 0))
        alternate = (np.arange(len(at)) - run) % 2 == 0  # of overlapping pairs the left one, then every other
        at, rule = at[alternate], rule[alternate]
        uses = np.bincount(rule, minlength=len(wanted)) >= 2
        keep = uses[rule]
        number = np.cumsum(uses) - 1
        at, rule = at[keep], number[rule[keep]]
        if not len(at):
            break
        made.append(np.stack([wanted[uses] >> np.uint64(32), wanted[uses] & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32))
        x[at] = (base + rules + rule).astype(np.uint32)
        last[at] = last[at + 1]
        rules += len(made[-1])
        stay = np.ones(len(x), dtype=bool)
        stay[at + 1] = False
        saved_symbols = len(at)
        x, last = x[stay], last[stay]
        if saved_symbols * 200 < len(x):
            break
    return x, last, np.concatenate(made) if made else np.zeros((0, 2), dtype=np.uint32)


def to_payload(doc_ids: list, ids: list[bytes], base: int) -> bytes:
    """Payload of documents; symbols take two bytes where the vocabulary leaves room for nonterminals below 2**16."""
    sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    flat = np.frombuffer(b"".join(ids), dtype="<u4")
    ends = np.zeros(len(flat), dtype=bool)
    ends[sizes.cumsum() - 1] = True
    wide = base >= 60_000
    symbols, last, rules = grammar(flat, ends, base, (1 << 22) if wide else (1 << 16) - base)
    length = np.ones(len(rules), dtype=np.uint32)
    for n, (a, b) in enumerate(rules.tolist()):
        length[n] = sum(1 if k < base else length[k - base] for k in (a, b))
    first_symbol = np.concatenate(([0], np.flatnonzero(last) + 1)).astype(np.int64)
    first_id = np.concatenate(([0], sizes.cumsum())).astype(np.int64)
    head = np.array([base, len(rules), len(ids), len(symbols), 4 if wide else 2], dtype="<i8")
    null = np.array([x is None for x in doc_ids], dtype=np.uint8)
    numbers = np.array([0 if x is None else x for x in doc_ids], dtype="<i8")
    return b"".join(x.tobytes() for x in (
        np.frombuffer(MAGIC, dtype=np.uint8), head, rules[:, 0].astype("<u4"), rules[:, 1].astype("<u4"), length.astype("<u4"),
        numbers, null, first_symbol.astype("<i8"), first_id.astype("<i8"), symbols.astype("<u4" if wide else "<u2")))


class Shard:
    """A payload read back; `ids(n)` decodes document n alone."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a grammar payload")
        self.base, rules, self.documents, symbols, width = np.frombuffer(payload, "<i8", 5, 4).tolist()
        at = 44

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(payload, kind, n, at)
            at += found.nbytes
            return found

        self.left, self.right, self.length = take("<u4", rules), take("<u4", rules), take("<u4", rules)
        self.numbers, self.null = take("<i8", self.documents), take("u1", self.documents)
        self.first_symbol, self.first_id = take("<i8", self.documents + 1), take("<i8", self.documents + 1)
        self.symbols = take(f"<u{width}", symbols)
        grown: list[bytes] = []
        word = np.dtype("<u4")
        for a, b in zip(self.left.tolist(), self.right.tolist()):
            grown.append(b"".join(grown[k - self.base] if k >= self.base else k.to_bytes(4, "little") for k in (a, b)))
        self.flat = np.concatenate([np.arange(self.base, dtype=word), np.frombuffer(b"".join(grown), dtype=word)])
        self.size = np.concatenate([np.ones(self.base, dtype=np.int64), self.length.astype(np.int64)])
        self.begin = self.size.cumsum() - self.size

    def ids(self, n: int) -> np.ndarray:
        symbols = self.symbols[self.first_symbol[n]:self.first_symbol[n + 1]]
        size = self.size[symbols]
        before = size.cumsum() - size
        return self.flat[np.repeat(self.begin[symbols] - before, size) + np.arange(size.sum())]


def write_tokens(docs: DataFrame, vocabulary_path: str | None = None, end_id: int = 1, shard_ids: int = 2_000_000,
                 vocabulary_size: int = 49_408, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the shards of `docs` in ascending doc_id order and returns them read back: (part, shard, documents, ids, payload).

    A shard closes at the document with which it reaches `shard_ids` ids. A null text is an empty one (`end_id` alone),
    null ids come first, rows that repeat an id stand beside one another, no rows give an empty table.
    """
    path, end = vocabulary_path or vocabulary("word_bpe_49k.json"), np.uint32(end_id).tobytes()

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, part = encoder(path), TaskContext.get().partitionId()
        numbers, ids, size, shard = [], [], 0, 0

        def close() -> pd.DataFrame:
            row = (part, shard, len(ids), size, to_payload(numbers, ids, vocabulary_size))
            return pd.DataFrame([row], columns=["part", "shard", "documents", "ids", "payload"])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["body"]):
                ids.append(words.encode(text) + end)
                numbers.append(None if doc_id is pd.NA else int(doc_id))
                size += len(ids[-1]) // 4
                if size >= shard_ids:
                    yield close()
                    numbers, ids, size, shard = [], [], 0, shard + 1
        if ids:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("body"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return saved(ordered.mapInPandas(shards, SHARD), "token-files")


def read_tokens(shards: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document, decoded from written shards; start counts the ids of all documents before."""
    totals = shards.groupBy("part").agg(F.sum("ids").alias("part_ids"))  # a row for each writing task
    before = totals.select("part", (F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids")).alias("before"))
    inside = F.sum("ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("ids")
    starts = shards.select("part", "shard", "ids").withColumn("inside", inside).join(before, "part") \
        .select("part", "shard", (F.col("before") + F.col("inside")).alias("first"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, payload in zip(batch["first"], batch["payload"]):
                shard, rows = Shard(payload), []
                for n in range(shard.documents):
                    rows.append((pd.NA if shard.null[n] else int(shard.numbers[n]), int(first + shard.first_id[n]),
                                 shard.ids(n).astype("<u4").tobytes()))
                    if len(rows) == 512:
                        yield pd.DataFrame(rows, columns=["doc_id", "start", "ids"]).astype({"doc_id": "Int64"})
                        rows = []
                yield pd.DataFrame(rows, columns=["doc_id", "start", "ids"]).astype({"doc_id": "Int64"})

    placed = shards.select("part", "shard", "payload").join(starts, ["part", "shard"]).select("first", "payload")
    return placed.mapInPandas(decode, "doc_id long, start long, ids binary")


def digest(read: DataFrame) -> DataFrame:
    return read.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
