"""Best-fit packing of documents into token sequences by bin completion.

Spark encodes the texts, cuts the long ones and counts the pieces of each length. What is packed are lengths, so the
search sees a histogram of at most `capacity` numbers however many documents there are; its plan is a list of fillings
with how often each is used. Spark numbers the pieces of one length and looks up their place in the plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.common import HOT_SHARE, saved, spread, text_of, vocabulary
from tenura.llm.word_ids import encoder

PIECE = "doc_id long, piece int, start long, length int, ids binary"

#: A filling: (how often it is used, ((length, pieces of that length), ...)).
Plan = list[tuple[int, tuple[tuple[int, int], ...]]]


def token_pieces(docs: DataFrame, capacity: int, end_id: int, vocabulary_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids) of every document: its ids and `end_id`, cut only where longer than `capacity`."""
    end, width = np.uint32(end_id).tobytes(), 4 * capacity

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = encoder(vocabulary_path)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["body"]):
                ids = words.encode(text) + end
                for n, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    out.append((doc_id, n, at // 4, len(part) // 4, part))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids"]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("body"))
    return rows.mapInPandas(cut, PIECE)


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing over a histogram: each piece goes to the fullest open sequence that takes it."""
    open_groups: dict[int, list[list]] = {}  # room left -> [[sequences, filling], ...]
    closed: Plan = []

    def add(room: int, sequences: int, filling: tuple) -> None:
        if room:
            open_groups.setdefault(room, []).append([sequences, filling])
        else:
            closed.append((sequences, filling))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        for room in sorted(r for r in open_groups if r >= length):
            each = room // length
            for group in open_groups.pop(room):
                full = min(group[0], left // each)
                if full:
                    add(room - each * length, full, group[1] + ((length, each),))
                    left -= full * each
                rest = group[0] - full
                if rest and left and left < each:
                    add(room - left * length, 1, group[1] + ((length, left),))
                    left, rest = 0, rest - 1
                if rest:
                    add(room, rest, group[1])
        each = capacity // length
        if left // each:
            add(capacity - each * length, left // each, ((length, each),))
        if left % each:
            add(capacity - left % each * length, 1, ((length, left % each),))
    return closed + [(n, filling) for groups in open_groups.values() for n, filling in groups]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer sequences: by total size, and by pieces too large to share with what must stand beside them."""
    best = -(-sum(k * n for k, n in counts.items()) // capacity)
    lengths = np.array(sorted(counts), dtype=np.int64)
    numbers = np.array([counts[k] for k in lengths.tolist()], dtype=np.int64)
    for small in [0, *[k for k in lengths.tolist() if k <= capacity // 2]]:
        big = lengths > capacity - small
        half = (lengths > capacity // 2) & ~big
        rest = (lengths >= small) & (lengths <= capacity // 2)
        over = (lengths[rest] * numbers[rest]).sum() - ((capacity - lengths[half]) * numbers[half]).sum()
        best = max(best, int(numbers[big].sum() + numbers[half].sum() + max(0, -(-over // capacity))))
    return best


def _fillings(counts: dict[int, int], room: int, tries: int, most: int) -> list[tuple[int, tuple]]:
    """(waste, lengths) of undominated fillings of `room`, least waste first; at most `tries` steps, `most` results."""
    lengths = sorted((k for k, n in counts.items() if n and k <= room), reverse=True)
    found: set[tuple] = set()
    stack: list[tuple[int, int, tuple]] = [(room, 0, ())]
    while stack and tries:
        left, at, chosen = stack.pop()
        tries -= 1
        while at < len(lengths) and lengths[at] > left:
            at += 1
        if at == len(lengths):
            found.add(chosen)
            if not left and len(found) >= most:
                break
            continue
        length = lengths[at]
        stack.append((left, at + 1, chosen))
        if chosen.count(length) < counts[length]:
            stack.append((left - length, at, chosen + (length,)))
    if not found:
        found.add(())
    kept: list[tuple] = []
    for filling in sorted(found, key=lambda f: (-sum(f), f)):
        larger = any(len(k) == len(filling) and all(a >= b for a, b in zip(k, filling)) for k in kept)
        if not larger and sum(filling) + min(lengths, default=room) <= room and filling:
            rest = room - sum(filling)
            larger = any(k <= rest and filling.count(k) < counts[k] for k in lengths)  # not maximal
        if not larger:
            kept.append(filling)
    return [(room - sum(f), f) for f in kept[:most]]


def bin_completion(counts: dict[int, int], capacity: int, nodes: int = 2500, tries: int = 200, most: int = 8) -> Plan:
    """Branch and bound: completes a sequence around the largest piece left, by an undominated filling, as often as the
    counts allow; a branch ends when its waste shows that it can't beat the incumbent. Best-fit solutions, of all pieces
    and of what a branch leaves, are the incumbents. `nodes`, `tries` and `most` bound the search, not the pieces."""
    counts = {k: n for k, n in counts.items() if n}
    incumbent = best_fit(counts, capacity)
    used = sum(n for n, _ in incumbent)
    least, total = lower_bound(counts, capacity), sum(k * n for k, n in counts.items())
    if used <= least or not counts:
        return incumbent
    left = dict(counts)
    path: list[tuple[int, tuple[int, ...]]] = []
    waste = 0

    def branches() -> Iterator[tuple[int, tuple[int, ...]]]:
        largest = max(k for k, n in left.items() if n)
        left[largest] -= 1
        options = _fillings(left, capacity - largest, tries, most)
        left[largest] += 1
        return iter([(w, (largest, *f)) for w, f in options])

    stack = [branches()]
    depth_nodes = 0
    while stack and used > least and depth_nodes < nodes:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if path:
                times, filling = path.pop()
                waste -= times * (capacity - sum(filling))
                for k in filling:
                    left[k] += times
            continue
        depth_nodes += 1
        _, filling = step
        times = min(left[k] // filling.count(k) for k in set(filling))
        lost = times * (capacity - sum(filling))
        if waste + lost > (used - 1) * capacity - total:
            continue
        path.append((times, filling))
        waste += lost
        for k in filling:
            left[k] -= times
        done = [(n, tuple((k, f.count(k)) for k in dict.fromkeys(f))) for n, f in path]
        rest = {k: n for k, n in left.items() if n}
        if not rest or depth_nodes % 16 == 1:
            tail = best_fit(rest, capacity) if rest else []
            if sum(n for n, _ in done) + sum(n for n, _ in tail) < used:
                incumbent = done + tail
                used = sum(n for n, _ in incumbent)
        if rest:
            stack.append(branches())
        else:
            path.pop()
            waste -= lost
            for k in filling:
                left[k] += times
    return incumbent


def _lookup(plan: Plan) -> dict[str, np.ndarray]:
    """The plan by length: from which number on, which sequences, how many of the length in each, and the offset there."""
    rows, first, given = [], 0, {}
    for times, filling in plan:
        offset = 0
        for length, each in filling:
            start = given.get(length, 0)
            rows.append(((length << 40) + start, start, first, each, offset))
            given[length] = start + times * each
            offset += length * each
        first += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("key", "start", "first", "each", "offset"), table.T.copy()))


def place(pieces: DataFrame, capacity: int, **search) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length, more columns), which must be a written table."""
    sized = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `capacity` rows
    counts = {r["length"]: r["n"] for r in sized}
    plan = _lookup(bin_completion(counts, capacity, **search))
    total = sum(counts.values())
    share = max(256, total // HOT_SHARE)
    parts = pieces.sparkSession.createDataFrame([(k, -(-n // share)) for k, n in counts.items()], "length int, parts int")
    rows = (pieces.join(F.broadcast(parts), "length")  # at most `capacity` rows
            .withColumn("part", F.pmod(spread("doc_id", "piece"), F.col("parts"))).drop("parts"))
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece")
    before = (rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).drop("n"))
    # at most `capacity` + HOT_SHARE rows
    numbered = (rows.withColumn("number", F.row_number().over(own) - 1).join(F.broadcast(before), ["length", "part"])
                .withColumn("number", (F.col("number") + F.col("before")).cast("long")).drop("part", "before"))
    schema = numbered.drop("number").schema.add("sequence_id", "long").add("offset", "long")

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, number = batch["length"].to_numpy(np.int64), batch.pop("number").to_numpy(np.int64)
            at = np.searchsorted(plan["key"], (length << 40) + number, side="right") - 1
            slot = number - plan["start"][at]
            each = plan["each"][at]
            yield batch.assign(doc_id=batch["doc_id"].astype("Int64"), sequence_id=plan["first"][at] + slot // each,
                               offset=plan["offset"][at] + slot % each * length)

    return numbered.mapInPandas(look_up, schema)


def pack(docs: DataFrame, capacity: int = 2048, end_id: int = 0, vocabulary_path: str | None = None,
         id_col: str = "doc_id", text_col: str = "text", **search) -> tuple[DataFrame, DataFrame]:
    """(pieces with their ids, their places): pieces (doc_id, piece, start, length, ids) as a written table, places with
    sequence_id and offset and the unsigned crc32 of the ids.

    A null text is an empty one: one piece with `end_id` alone. Rows that repeat an id or a whole row are packed each.
    A null id is kept. No rows give no sequences. Other columns are not read.
    """
    pieces = saved(token_pieces(docs, capacity, end_id, vocabulary_path or vocabulary("word_bpe_49k.json"), id_col, text_col),
                   "pack-pieces")
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pieces, place(saved(narrow, "pack-lengths"), capacity, **search)


def sequences(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, little-endian unsigned 32-bit ids."""
    joined = pieces.select("doc_id", "piece", "ids").join(places.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most `capacity` ids a sequence
    parts = F.transform(ordered, lambda x: F.hex(x["ids"]))
    return joined.groupBy("sequence_id").agg(F.unhex(F.concat_ws("", parts)).alias("ids"))

