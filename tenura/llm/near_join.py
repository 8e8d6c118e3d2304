"""Jaccard join on word n-grams: MinHash LSH forest, then exact verification.

Documents with equal shingle sets are one class. Each class has a signature of `trees` x `deep` minimum hashes; a tree
is the prefix trie of one stretch of the signatures. The matched prefix is shortened from `deep` until two sets at the
threshold meet in some tree with the target recall; the classes that share such a prefix are a bucket. Large buckets
are cut into blocks whose pairs are tasks of their own. A task compares its classes in memory (signatures first, then
the exact sets) and gives out sums and a spanning forest, never the pairs. A pair belongs to the first tree in which it
meets, so it counts once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import key_counts, saved, spread, spread_join, starts_task, text_of

WORD = re.compile(r"\w+")
NO_ID = -(2 ** 63)
BLOCK = 1024
#: Signatures of two sets at the threshold agree in at least this many places of 100 but for one pair in millions.
SIGNATURE_SLACK = 0.25


def matched_depth(threshold: float, trees: int, deep: int, target_recall: float) -> int:
    """The longest prefix at which sets at the threshold still meet in one of the trees with the target recall."""
    depth = deep
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < target_recall:
        depth -= 1
    return depth


class Shingler:
    """Sorted distinct 64-bit hashes of the n-grams of lower-cased words; a shorter text is one n-gram, an empty one has none."""

    def __init__(self, n: int, most: int = 300_000):
        self.n, self.most, self.kept = n, most, {}

    def __call__(self, text: str) -> np.ndarray:
        words = WORD.findall(text.lower())
        if not words:
            return np.zeros(0, dtype=np.uint64)
        kept = self.kept
        if len(kept) > self.most:
            kept.clear()
        for word in set(words).difference(kept):
            kept[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(kept.__getitem__, words), dtype=np.uint64, count=len(words))
        n = min(self.n, len(words))
        mixed = np.full(len(words) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(hashes) - n + 1 + k]
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


def signature(shingles: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    low = (shingles >> np.uint64(32)).astype(np.uint32)[:, None]
    best = None
    for at in range(0, len(low), 1024):
        part = (low[at:at + 1024] * factors + terms).min(axis=0)
        best = part if best is None else np.minimum(best, part)
    return best


def _functions(size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    return (random.integers(1, 1 << 31, size, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            random.integers(0, 1 << 32, size, dtype=np.uint32))


def _prefixes(signatures: np.ndarray, trees: int, deep: int, depth: int) -> np.ndarray:
    """(rows, trees): hash of the first `depth` labels in each tree."""
    labels = signatures.reshape(len(signatures), trees, deep)[:, :, :depth].astype(np.uint64)
    mixed = np.broadcast_to(np.arange(1, trees + 1, dtype=np.uint64), labels.shape[:2]).copy()
    for k in range(depth):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + labels[:, :, k]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed.view(np.int64)


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each run of equal keys, across batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        if held:
            batch = pd.concat([*held, batch], ignore_index=True)
            held = []
        values = [batch[k].to_numpy() for k in keys]
        change = np.zeros(len(batch) - 1, dtype=bool)
        for v in values:
            change |= v[1:] != v[:-1]
        starts = np.concatenate(([0], np.flatnonzero(change) + 1))
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            yield batch.iloc[a:b]
        held = [batch.iloc[starts[-1]:]]
    if held:
        yield held[0]


class Forest:
    """What the tasks share: shape of the forest and hash functions."""

    def __init__(self, threshold: float, n: int, trees: int, deep: int, target_recall: float, seed: int):
        self.threshold, self.n, self.trees, self.deep = threshold, n, trees, deep
        self.depth = matched_depth(threshold, trees, deep, target_recall)
        self.factors, self.terms = _functions(trees * deep, seed)

    def pairs(self, group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Candidate pairs (rows of the group) that the group's tree owns, by signatures."""
        signatures = np.frombuffer(b"".join(group["signature"]), dtype=np.uint32).reshape(len(group), -1)
        side = group["side"].to_numpy()
        left = np.flatnonzero(side <= 0)  # 0: a block with itself, -1 and 1: two blocks
        right = np.flatnonzero(side >= 0)
        tree = int(group["tree"].iloc[0])
        prefixes = _prefixes(signatures, self.trees, self.deep, self.depth)
        own = prefixes[left, tree][:, None] == prefixes[right, tree][None, :]
        if side[0] == 0:
            own &= left[:, None] < right[None, :]
        for t in range(tree):
            own &= prefixes[left, t][:, None] != prefixes[right, t][None, :]
        a, b = np.nonzero(own)
        a, b = left[a], right[b]
        wanted = (self.threshold - SIGNATURE_SLACK) * signatures.shape[1]
        keep = np.zeros(len(a), dtype=bool)
        for at in range(0, len(a), 1 << 15):
            part = slice(at, at + (1 << 15))
            keep[part] = (signatures[a[part]] == signatures[b[part]]).sum(axis=1) >= wanted
        return a[keep], b[keep]

    def linked(self, sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs have an exact Jaccard similarity of at least the threshold."""
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        shared = np.zeros(len(a), dtype=np.int64)
        used = np.unique(np.concatenate([a, b]))
        pooled, column = np.unique(np.concatenate([sets[k] for k in used.tolist()]), return_inverse=True)
        if len(a) * int(sizes[used].mean()) * 40 > len(used) ** 2 * len(pooled):
            row = np.repeat(np.arange(len(used)), sizes[used])
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
            counts = np.zeros((len(used), len(used)), dtype=np.float32)
            for start in range(0, len(pooled), 2048):
                low, high = np.searchsorted(column, [start, start + 2048])
                dense = np.zeros((len(used), 2048), dtype=np.float32)
                dense[row[low:high], column[low:high] - start] = 1
                counts += dense @ dense.T
            shared = counts[np.searchsorted(used, a), np.searchsorted(used, b)].astype(np.int64)
        else:
            for k, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
                x, y = (sets[i], sets[j]) if len(sets[i]) <= len(sets[j]) else (sets[j], sets[i])
                shared[k] = (y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()
        return shared >= self.threshold * (sizes[a] + sizes[b] - shared) - 1e-9


def _spanning(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a star for each component of the pairs."""
    root = list(range(n))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i, j in zip(a.tolist(), b.tolist()):
        i, j = find(i), find(j)
        if i != j:
            root[max(i, j)] = min(i, j)
    return [(k, find(k)) for k in range(n) if find(k) != k]


TASK = ["tree", "bucket", "low", "high"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of the connected component of every node of edges (a, b). Least labels of the
    neighbours and jumps to the label's label, written after each round, until nothing changes."""
    both = saved(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-edges")
    degrees = key_counts(both.select(F.col("b").alias("node")), "node")
    total = both.count()
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                   .select("node", F.least("node", "low").alias("root")), "near-labels")
    while True:
        told = spread_join(both.select("a", F.col("b").alias("node")), labels, ["node"], degrees, total)
        least = told.groupBy(F.col("a").alias("node")).agg(F.min("root").alias("low"))
        near = saved(labels.join(least, "node").select("node", F.least("root", "low").alias("root")), "near-labels")
        sizes = key_counts(near, "root")
        jumped = spread_join(near, near.select(F.col("node").alias("root"), F.col("root").alias("further")), ["root"], sizes, total)
        after = saved(jumped.select("node", F.col("further").alias("root"), ), "near-labels")
        moved = after.join(labels.withColumnRenamed("root", "old"), "node").where("root <> old").limit(1).count()
        labels = after
        if not moved:
            return labels


def near_join(docs: DataFrame, threshold: float = 0.8, words: int = 5, trees: int = 20, deep: int = 5,
              target_recall: float = 0.9999, id_col: str = "doc_id", text_col: str = "text", seed: int = 11) -> DataFrame:
    """One row per row of `docs`: doc_id, text_mark, class_id, n_links, class_size, kept.

    Two documents are linked when the Jaccard similarity of their sets of `words`-word n-grams (lower-cased; a text of
    fewer words is one n-gram) is at least `threshold`. `class_id` is the least id of all documents joined by links,
    `n_links` the number of other documents linked to this one, copies included, `class_size` that of equal sets, `kept` marks one
    document of each class (of equal ids the least text_mark, the 64-bit hash of the text). Texts without words, null
    ones too, are equal to one another. Null ids are smaller than any other. Repeated rows count as documents each, and
    are kept both. Other columns are not read.
    """
    forest = Forest(threshold, words, trees, deep, target_recall, seed)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("body"))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts_task("shingles")
        shingle = Shingler(forest.n)
        for batch in batches:
            sets = [shingle(text) for text in batch["body"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "text_mark": batch["text_mark"],
                "cls": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                "signature": [signature(s, forest.factors, forest.terms).tobytes() if len(s) else None for s in sets]})

    signed = saved(rows.withColumn("text_mark", F.xxhash64("body")).select("doc_id", "text_mark", "body")
                   .mapInPandas(sign, "doc_id long, text_mark long, cls binary, signature binary"), "near-signed")
    total = signed.count()
    place = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text_mark")
    classes = saved(signed.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"),
                                              F.first("signature").alias("signature")), "near-classes")

    def buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = np.frombuffer(b"".join(batch["signature"]), dtype=np.uint32).reshape(len(batch), -1)
                prefixes = _prefixes(found, forest.trees, forest.deep, forest.depth)
                yield pd.DataFrame({"cls": np.repeat(batch["cls"].to_numpy(dtype=object), forest.trees),
                                    "tree": np.tile(np.arange(forest.trees, dtype=np.int32), len(batch)), "bucket": prefixes.ravel()})

    met = classes.where(F.col("signature").isNotNull()).select("cls", "signature") \
        .mapInPandas(buckets, "cls binary, tree int, bucket long")
    met = saved(met, "near-buckets")
    sizes = saved(key_counts(met, "tree", "bucket").where("n > 1"), "near-sizes")
    members = spread_join(met, sizes, ["tree", "bucket"], sizes, total * forest.trees, BLOCK)
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(spread("cls", "tree"), blocks).cast("int")
    dealt = (members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("tree", "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                     F.signum(F.col("own") - F.col("other")).cast("int").alias("side"), "cls"))
    dealt = saved(dealt.join(classes.select("cls", "signature", F.col("n").alias("copies")), "cls"), "near-dealt")

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(batches, TASK):
            if len(group) > 1:
                a, b = forest.pairs(group)
                if len(a):
                    yield group.iloc[np.unique(np.concatenate([a, b]))]

    by_task = dealt.repartition(*TASK).sortWithinPartitions(*TASK)
    wanted = saved(by_task.mapInPandas(candidates, dealt.schema), "near-wanted")
    needed = wanted.select("cls").distinct().join(classes.select("cls", "first"), "cls")
    needed = needed.select(F.col("cls").alias("wanted"), F.col("first.doc_id").alias("at"), F.col("first.text_mark").alias("mark"))

    def shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(forest.n)
        for batch in batches:
            yield pd.DataFrame({"cls": batch["wanted"], "shingles": [shingle(text).tobytes() for text in batch["body"]]})

    texts = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("at"), F.xxhash64("body").alias("mark"), "body")
    sets = texts.join(needed, ["at", "mark"]).dropDuplicates(["wanted"]).select("wanted", "body") \
        .mapInPandas(shingles, "cls binary, shingles binary")
    full = wanted.join(saved(sets, "near-sets"), "cls").repartition(*TASK).sortWithinPartitions(*TASK)

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(batches, TASK):
            a, b = forest.pairs(group)
            sets = [np.frombuffer(s, dtype=np.uint64) for s in group["shingles"]]
            true = forest.linked(sets, a, b)
            a, b = a[true], b[true]
            if not len(a):
                continue
            copies = group["copies"].to_numpy()
            links = np.zeros(len(group), dtype=np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root = dict(_spanning(len(group), a, b))
            cls = group["cls"].to_numpy(dtype=object)
            at = np.flatnonzero(links)
            yield pd.DataFrame({"cls": cls[at], "links": links[at], "root": [cls[root.get(k, k)] for k in at.tolist()]})

    verified = saved(full.mapInPandas(verify, "cls binary, links long, root binary"), "near-links")
    links = verified.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(verified.select(F.col("cls").alias("a"), F.col("root").alias("b")).where("a <> b"))
    placed = classes.select("cls", "n", "first").join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
    placed = saved(placed.withColumn("root", F.coalesce("root", "cls")).join(links, "cls", "left"), "near-placed")
    leaders = placed.groupBy("root").agg(F.min("first").alias("leader"))
    members_of = key_counts(placed, "root")
    classed = spread_join(placed, leaders, ["root"], members_of, total).select(
        "cls", "leader", F.col("n").alias("class_size"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    found = spread_join(signed.select("doc_id", "text_mark", "cls"), classed, ["cls"], classes.select("cls", "n"), total)
    leader_id = F.col("leader.doc_id")
    return found.select(
        "doc_id", "text_mark", F.when(leader_id != NO_ID, leader_id).alias("class_id"), "n_links", "class_size",
        ((F.coalesce("doc_id", F.lit(NO_ID)) == leader_id) & (F.col("text_mark") == F.col("leader.text_mark"))).alias("kept"))
