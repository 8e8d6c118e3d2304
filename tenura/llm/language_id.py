"""Language identification with bit-sliced Bloom filters of n-grams.

Every language has a Bloom filter of its frequent letter n-grams. All filters have the same size and hash functions and
are stored transposed: a position holds one bit for each language, so that the AND of an n-gram's few positions is the set
of all languages that know it. A text's set bits are counted by language, each count is corrected for what the filter
lets through by chance, and the language with the largest corrected count is the prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import saved

LENGTHS = (2, 3, 4)
#: A text goes through in pieces of so many letters, so that one of any length needs bounded memory.
PIECE = 1 << 18
#: Positions of a filter that are put together in one task while it is built.
BLOCK_BITS = 12

LETTERS = re.compile(r"[^\W\d_]+")
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


def letters_of(text: str) -> np.ndarray:
    """Code points of the lower-cased words, one blank around each; empty for a text without letters."""
    words = LETTERS.findall(text)
    if not words:
        return np.zeros(0, dtype=np.uint32)
    return np.frombuffer((" " + " ".join(words).lower() + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def pieces(texts: list[str | None], most: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(letters, first place of each text, its number, places whose n-grams count): texts one behind the other up to
    `most` letters. A longer text is cut into pieces that overlap by the longest n-gram less a letter; n-grams that
    start in the overlap count in the next piece."""
    overlap, room, held = max(LENGTHS) - 1, most, []

    def together() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(part) + 1 for _, part, _ in held])
        zero = np.zeros(1, dtype=np.uint32)
        own = np.concatenate([np.arange(len(part) + 1) < n for _, part, n in held])
        return (np.concatenate([x for _, part, _ in held for x in (part, zero)]), np.concatenate([[0], sizes.cumsum()[:-1]]),
                np.array([number for number, _, _ in held]), own)

    for number, text in enumerate(texts):
        found = letters_of(text) if text else np.zeros(0, dtype=np.uint32)
        for start in range(0, max(1, len(found) - overlap), most):
            part = found[start:start + most + overlap]
            if len(part) > room and held:
                yield together()
                held, room = [], most
            held.append((number, part, most if start + most + overlap < len(found) else len(part)))
            room -= len(part) + 1
    if held:
        yield together()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def grams(letters: np.ndarray, own: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, hash of the n-gram that starts at each place, whether it counts and lies inside one text)."""
    wide = letters.astype(np.uint64)
    hashed = wide.copy()
    inside = own & (letters != 0)
    for length in range(2, max(LENGTHS) + 1):
        if len(letters) < length:
            return
        hashed = hashed[:-1] * MIX[2] + wide[length - 1:]
        inside = inside[:-1] & (letters[length - 1:] != 0)
        if length in LENGTHS:
            yield length, mixed(hashed + np.uint64(length)), inside


def positions(hashed: np.ndarray, bits: int, hashes: int) -> Iterator[np.ndarray]:
    """`hashes` positions of each n-gram among 2**bits, by double hashing."""
    step = mixed(hashed + MIX[2]) | np.uint64(1)
    for k in range(hashes):
        yield ((hashed + np.uint64(k) * step) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Filters:
    """`table[word, position]`: bit b is set where the filter of language 64 * word + b has the position set."""

    languages: list[str]
    table: np.ndarray
    bits: int
    hashes: int

    def __post_init__(self):
        filled = np.array([(self.table[n // 64] >> np.uint64(n % 64) & np.uint64(1)).mean() for n in range(len(self.languages))])
        self.by_chance = filled ** self.hashes

    def counts(self, letters: np.ndarray, starts: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams of each text, those that each language knows)."""
        total, known = np.zeros(len(starts), dtype=np.int64), np.zeros((len(starts), len(self.languages)), dtype=np.int64)
        for _, hashed, inside in grams(letters, own):
            there = np.flatnonzero(inside)
            if not len(there):
                continue
            # places whose texts have no n-gram of this length get no sum
            edges = np.searchsorted(there, np.append(starts, len(letters)))
            some = np.flatnonzero(edges[1:] > edges[:-1])
            first = edges[some]
            total[some] += edges[some + 1] - first
            at = list(positions(hashed[there], self.bits, self.hashes))
            for word in range(len(self.table)):
                sets = self.table[word][at[0]]
                for place in at[1:]:
                    sets &= self.table[word][place]
                for n in range(64 * word, min(64 * word + 64, len(self.languages))):
                    bit = (sets >> np.uint64(n % 64)).astype(np.uint8) & np.uint8(1)
                    known[some, n] += np.add.reduceat(bit, first, dtype=np.int64)
        return total, known

    def shares(self, total: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Share of a text's n-grams that a language really holds: of those it lacks, `by_chance` seem known."""
        seen = known / np.maximum(total, 1)[:, None]
        return np.clip((seen - self.by_chance) / np.maximum(1 - self.by_chance, 1e-9), 0, 1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text; the score is the winner's share of its own and the runner-up's count."""
        total, known = np.zeros(len(texts), dtype=np.int64), np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        for letters, starts, numbers, own in pieces(texts):
            some, its = self.counts(letters, starts, own)
            np.add.at(total, numbers, some)
            np.add.at(known, numbers, its)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        shares = self.shares(total, known)
        best = shares.argmax(axis=1)
        ranked = np.sort(shares, axis=1)
        top, second = ranked[:, -1], ranked[:, -2] if len(self.languages) > 1 else np.zeros(len(texts))
        score = np.where(top > 0, top / np.maximum(top + second, 1e-12), 0.0)
        return ["und" if not n else self.languages[b] for n, b in zip(total, best)], np.where(total > 0, score, 0.0)


def learned_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows to learn from: crc32 of the id as text is no multiple of 5. Rows without id are neither learned from nor held out."""
    return docs.where(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = 4000,
        least_share: float = 1 / 20000, bits: int = 20, hashes: int = 4, seed: int = 11) -> Filters:
    """Filters of all languages of `docs` (null texts and languages are left out).

    N-grams are counted over about `sample_docs` documents of each language, taken by a hash of the id. A language holds
    the n-grams that make up at least `least_share` of its n-grams of that length, thus at most 1 / least_share of each
    length; the filters take 2**bits positions of 8 bytes for every 64 languages. Languages stand in order of their
    documents, most first, so that this decides ties. Without documents there are no languages.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    held = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a language
    held.sort(key=lambda r: (-r["n"], r["lang"]))
    languages = [r["lang"] for r in held]
    words = max(1, -(-len(languages) // 64))
    table = np.zeros((words, 1 << bits), dtype=np.uint64)
    if not languages:
        return Filters(languages, table, bits, hashes)
    number = docs.sparkSession.createDataFrame(
        [(r["lang"], n, min(1.0, sample_docs / r["n"])) for n, r in enumerate(held)], "lang string, number int, share double")
    dealt = F.shiftrightunsigned(F.xxhash64("id", F.lit(seed)), 11).cast("double") / float(1 << 53)
    sample = rows.join(F.broadcast(number), "lang").where(dealt < F.col("share")).select("number", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for language, texts in batch.groupby("number")["text"]:
                for letters, _, _, own in pieces(texts.tolist()):
                    for length, hashed, inside in grams(letters, own):
                        found, n = np.unique(hashed[inside].view(np.int64), return_counts=True)
                        yield pd.DataFrame({"number": np.int32(language), "length": np.int32(length), "gram": found, "n": n})

    counts = sample.mapInPandas(count, "number int, length int, gram long, n long").groupBy("number", "length", "gram").agg(F.sum("n").alias("n"))
    counts = saved(counts, "language-grams")
    totals = counts.groupBy("number", "length").agg(F.sum("n").alias("total"))  # one row a language and length
    frequent = counts.join(F.broadcast(totals), ["number", "length"]).where(F.col("n") >= least_share * F.col("total")).select("number", "gram")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in positions(batch["gram"].to_numpy(np.int64).view(np.uint64), bits, hashes):
                yield pd.DataFrame({"word": batch["number"] // 64, "block": at >> BLOCK_BITS, "place": at & ((1 << BLOCK_BITS) - 1),
                                    "mask": np.int64(1) << (batch["number"] % 64)})

    set_bits = frequent.mapInPandas(place, "word int, block long, place int, mask long") \
        .groupBy("word", "block", "place").agg(F.bit_or("mask").alias("mask"))

    def block(group: pd.DataFrame) -> pd.DataFrame:
        masks = np.zeros(1 << BLOCK_BITS, dtype=np.int64)
        masks[group["place"]] = group["mask"]
        return pd.DataFrame({"word": group["word"][:1], "block": group["block"][:1], "masks": [masks.tobytes()]})

    for row in set_bits.groupBy("word", "block").applyInPandas(block, "word int, block long, masks binary").collect():  # 8 bytes a position
        start = row["block"] << BLOCK_BITS
        table[row["word"], start:start + (1 << BLOCK_BITS)] = np.frombuffer(row["masks"], dtype=np.uint64)
    return Filters(languages, table, bits, hashes)


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of `docs`, from whole texts.

    A text that is null or has no letter is `und` with score 0, and so is every text when no language was learned. A text
    whose n-grams no language knows, and any other tie, gets the language with more documents, with score 0 or 0.5.
    Rows without id are not held out. Other columns are not read, whatever their names.
    """
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("text"))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, score = filters.predict(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "lang_pred": found, "score": score})

    return rows.mapInPandas(predict, "doc_id long, held_out boolean, lang_pred string, score double")
