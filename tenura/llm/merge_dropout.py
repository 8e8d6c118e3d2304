"""SentencePiece encoding with seeded merge-dropout, and its lossless decoding.

A merge-type vocabulary joins the adjacent pair with the best score until none is left. Here every candidate taken from
the agenda is skipped with the chance of the dropout rate; a pair that a later merge makes anew is a new candidate. The
draws come from a keyed hash of (seed, document's id, place of the chunk), so every occurrence of a word is cut by draws
of its own, the same in every run. What is kept between occurrences are facts without chance: how a word is cut when
given ones of its candidates are skipped. With rate 0 the ids are those of the library.
"""

from __future__ import annotations

import heapq
import re
import struct
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import text_of, vocabulary

SPACE = "▁"
SHORT, NONE = 48, float("inf")
#: Ways with more skipped candidates are made anew each time: there are too many to be met again.
KEPT_DROPS = 1
GOLDEN, LOW = 0x9E3779B97F4A7C15, 0xFFFFFFFFFFFFFFFF
#: In arrays: a symbol merged into the one before it, no piece, characters that are no piece, an agenda's place without a candidate.
GONE, NO, OTHER, SHIFT, DONE = -1, -1, 1 << 20, 22, 1 << 40
#: Words are run together by length, up to these many characters; longer ones than SHORT by themselves.
WIDTHS = np.array([*range(2, 11), 12, 14, 16, 20, 24, 32, SHORT])
ENCODED = "doc_id long, text string, ids binary"


class Pieces:
    """Pieces of a merge-type model: ids and scores of the mergeable ones, ids of the bytes, spelling of every id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.ids, self.scores, self.byte_ids, self.spelled = {}, {}, [0] * 256, []
        for n in range(model.get_piece_size()):
            piece = model.id_to_piece(n)
            if model.is_byte(n):
                self.byte_ids[int(piece[3:5], 16)] = n
                self.spelled.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(n) or model.is_unknown(n):
                self.spelled.append(b"")
            else:
                self.ids[piece], self.scores[piece] = n, -model.get_score(n)
                self.spelled.append(piece.replace(SPACE, " ").encode())
        #: Characters in no piece with others: a text may be cut around them.
        joined = {c for piece in self.ids if len(piece) > 1 for c in piece}
        self.lone_newline = "\n" not in joined
        self.inner_space = any(SPACE in piece.lstrip(SPACE) for piece in self.ids)
        #: Neighbouring characters within pieces: no merge crosses any other two.
        self.pairs = {piece[k:k + 2] for piece in self.ids for k in range(len(piece) - 1)}


class Merges:
    """The merges as arrays. A symbol is the id of a piece, or OTHER and the code of a character that is none."""

    def __init__(self, pieces: Pieces):
        ids = pieces.ids
        self.of_char = np.arange(0x110000, dtype=np.int64) + OTHER
        for piece, n in ids.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = n
        scores = np.array([pieces.scores.get(piece, NONE) for piece in ids])
        self.rank = np.full(len(pieces.spelled) + 1, DONE, dtype=np.int64)  # the last one, NO, is of no piece
        values, order = np.unique(scores, return_inverse=True)
        self.rank[np.fromiter(ids.values(), np.int64, len(ids))] = order
        self.ranks = len(values)
        both = {}
        for piece, n in ids.items():
            for k in range(1, len(piece)):
                left, right = (ids.get(x, OTHER + ord(x) if len(x) == 1 else NO) for x in (piece[:k], piece[k:]))
                if left != NO and right != NO:
                    both[left << SHIFT | right] = n
        self.keys, self.values = np.full(1 << (8 * len(both)).bit_length(), NO, dtype=np.int64), np.full(1 << (8 * len(both)).bit_length(), NO, dtype=np.int32)
        self.down = np.uint64(64 - (len(self.keys).bit_length() - 1))
        for key, n in both.items():
            at = (key * GOLDEN & LOW) >> int(self.down)
            while self.keys[at] != NO:
                at = (at + 1) % len(self.keys)
            self.keys[at], self.values[at] = key, n
        self.pairs = np.array(sorted(ord(x[0]) << SHIFT | ord(x[1]) for x in pieces.pairs), dtype=np.int64)
        self.byte_ids = np.array(pieces.byte_ids, dtype=np.int64)

    def made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the pieces that pairs of symbols make, or NO: looked up by hash, the next place where another one is."""
        keys = left << SHIFT | right
        at = ((keys.astype(np.uint64) * np.uint64(GOLDEN)) >> self.down).astype(np.int64)
        there = self.keys[at]
        found = np.where(there == keys, self.values[at], NO).astype(np.int64)
        further = np.nonzero((there != keys) & (there != NO))
        while len(further[0]):
            at[further] = (at[further] + 1) % len(self.keys)
            there = self.keys[at[further]]
            same = there == keys[further]
            found[tuple(x[same] for x in further)] = self.values[at[further][same]]
            further = tuple(x[~same & (there != NO)] for x in further)
        return found

    def neighbours(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether characters stand side by side in some piece."""
        if not len(self.pairs):
            return np.zeros(left.shape, dtype=bool)
        keys = left << SHIFT | right
        return self.pairs[np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)] == keys

    def spelled(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of symbols one after the other, characters without a piece in bytes, and the number of each row's."""
        here = symbols != GONE
        flat, counts = symbols[here], here.sum(axis=1)
        other = flat >= OTHER
        if not other.any():
            return flat, counts
        codes = np.where(other, flat - OTHER, 0)
        sizes = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        starts, ids = np.cumsum(sizes) - sizes, np.repeat(flat, sizes)
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])
        for k in range(4):
            at = np.flatnonzero(other & (sizes > k))
            bits = codes[at] >> 6 * (sizes[at] - 1 - k)
            ids[starts[at] + k] = self.byte_ids[lead[sizes[at]] | bits if k == 0 else 0x80 | bits & 0x3F]
        return ids, np.bincount(np.repeat(np.arange(len(counts)), counts), weights=sizes, minlength=len(counts)).astype(np.int64)


class Way:
    """How a part is cut when the candidates numbered `drops` are skipped and all after them taken: `left` is the number of
    candidates after the last skipped one, `further` the ways with one more skipped, by its place among those."""

    __slots__ = ("drops", "left", "ids", "further")

    def __init__(self, drops: tuple, left: int, ids: bytes):
        self.drops, self.left, self.ids, self.further = drops, left, ids, None


class Encoder:
    """`variants` bounds the ways one word is cut; None lets every occurrence have its own draws."""

    def __init__(self, path: str, rate: float, seed: int, variants: int | None = None, most: int = 200_000):
        self.pieces, self.seed, self.variants, self.most = Pieces(path), seed, variants, most
        if self.pieces.inner_space or not self.pieces.lone_newline:
            raise ValueError("the vocabulary has pieces across words")
        #: Bounds of a 32-bit hash for so many candidates taken before the next one is skipped, ascending.
        bounds, chance = [], 1 - rate
        while rate > 0 and (bound := int(chance * 2 ** 32)) > 0:
            bounds.append(bound)
            chance *= 1 - rate
        self.bounds = bounds[::-1]
        self.bounds_at = np.array(self.bounds, dtype=np.uint64)
        self.never = rate <= 0
        self.kept: dict[str, tuple[float, bytes, list[tuple[str, Way]]]] = {}
        self.held = 0
        self.chunks = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        self.merges = Merges(self.pieces)
        self.mark = np.array([self.pieces.byte_ids[b] for b in SPACE.encode()], dtype="<u4").tobytes()

    def taken(self, key: int, n: int) -> float:
        """How many candidates are taken before the next skipped one: draw `n` of a key."""
        if self.never:
            return NONE
        x = (key + n * GOLDEN) & LOW
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & LOW
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & LOW
        return len(self.bounds) - bisect_right(self.bounds, (x ^ (x >> 31)) >> 32)

    def first_taken(self, keys: np.ndarray) -> list:
        """`taken` of many keys, draw 0."""
        return [NONE] * len(keys) if self.never else self.taken_of(keys).tolist()

    def taken_of(self, keys: np.ndarray) -> np.ndarray:
        """`taken` of many keys, to which GOLDEN times the draw is added."""
        x = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (len(self.bounds) - np.searchsorted(self.bounds_at, (x ^ (x >> np.uint64(31))) >> np.uint64(32), side="right"))

    def drops(self, key: int) -> Iterator[float]:
        """Numbers of the skipped candidates."""
        at, n = -1, 0
        while True:
            at += self.taken(key, n) + 1
            n += 1
            yield at

    def cut(self, chunk: str, key: int) -> list[str]:
        """The chunk's segments with the draws of a key."""
        return self.merged(chunk, self.drops(key))[0]

    def cut_long(self, chunk: str, key: int) -> list[str]:
        return self.merged_long(chunk, self.drops(key))[0]

    def merged(self, chunk: str, drops: Iterable[float]) -> tuple[list[str], int]:
        """The chunk's segments after merging the best candidate, the left one of equals, until none is left, and the number
        of candidates. One whose number is in `drops` (ascending) is out until a neighbour's merge makes a new one there."""
        if len(chunk) > SHORT:
            return self.merged_long(chunk, drops)
        scores, drops = self.pieces.scores, iter(drops)
        parts, seen, skip = list(chunk), 0, next(drops, NONE)
        agenda = [scores.get(a + b, NONE) for a, b in zip(parts, parts[1:])]
        while agenda:
            score = min(agenda)
            if score == NONE:
                break
            k = agenda.index(score)
            seen += 1
            if seen > skip:
                agenda[k], skip = NONE, next(drops, NONE)
                continue
            pair = parts[k] = parts[k] + parts[k + 1]
            del parts[k + 1], agenda[k]
            if k:
                agenda[k - 1] = scores.get(parts[k - 1] + pair, NONE)
            if k < len(agenda):
                agenda[k] = scores.get(pair + parts[k + 1], NONE)
        return parts, seen

    def merged_long(self, chunk: str, drops: Iterable[float]) -> tuple[list[str], int]:
        """The same for long chunks, from a heap of (score, place) candidates."""
        scores, drops = self.pieces.scores, iter(drops)
        parts, seen, skip = list(chunk), 0, next(drops, NONE)
        size = len(parts)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        agenda = []
        for k in range(size - 1):
            pair = parts[k] + parts[k + 1]
            score = scores.get(pair)
            if score is not None:
                agenda.append((score, k, len(pair)))
        heapq.heapify(agenda)
        while agenda:
            score, k, length = heapq.heappop(agenda)
            left = parts[k]
            right_at = after[k]
            if not left or right_at >= size:
                continue
            pair = left + parts[right_at]
            if len(pair) != length or scores.get(pair) != score:
                continue  # an end was merged meanwhile
            seen += 1
            if seen > skip:
                skip = next(drops, NONE)
                continue
            parts[k], parts[right_at] = pair, ""
            following = after[k] = after[right_at]
            if following < size:
                before[following] = k
                new = pair + parts[following]
                score = scores.get(new)
                if score is not None:
                    heapq.heappush(agenda, (score, k, len(new)))
            previous = before[k]
            if previous >= 0:
                new = parts[previous] + pair
                score = scores.get(new)
                if score is not None:
                    heapq.heappush(agenda, (score, previous, len(new)))
        return [part for part in parts if part], seen

    def _ids(self, pieces: list[str]) -> bytes:
        ids, out = self.pieces.ids, []
        for piece in pieces:
            n = ids.get(piece)
            out += [n] if n is not None else [self.pieces.byte_ids[b] for b in piece.encode()]
        return struct.pack(f"<{len(out)}I", *out)

    def _way(self, part: str, drops: tuple) -> Way:
        pieces, seen = self.merged(part, drops)
        return Way(drops, seen - (drops[-1] + 1 if drops else 0), self._ids(pieces))

    def _parts(self, chunk: str) -> list[str]:
        """Parts of a chunk, between which no merge is possible."""
        pairs = self.pieces.pairs
        ends = [k for k in range(1, len(chunk)) if chunk[k - 1:k + 1] not in pairs]
        return [chunk[start:end] for start, end in zip([0, *ends], [*ends, len(chunk)])] if ends else [chunk]

    def _once(self, chunk: str, taken: float, key: int) -> bytes:
        """Ids of a chunk with the draws of `key`, the first of them `taken`; nothing is kept."""
        found, n = [], 0
        for part in self._parts(chunk):
            if len(part) == 1:
                found.append(self._ids([part]))
            else:
                ids, taken, n = self._alone(part, (taken,), key, n)
                found.append(ids)
        return b"".join(found)

    def _whole(self, chunk: str) -> tuple[float, bytes, list[tuple[str, Way]]]:
        """Of a chunk with nothing skipped: number of candidates, ids, and its parts."""
        parts = []
        for part in self._parts(chunk):
            same = self.kept.get(part)
            parts.append(same[2][0] if same and len(same[2]) == 1 else (part, self._way(part, ())))
        self.held += 1 + len(parts)
        self.kept[chunk] = whole = sum(way.left for _, way in parts), b"".join(way.ids for _, way in parts), parts
        return whole

    def _alone(self, part: str, drops: tuple, key: int, n: int) -> tuple[bytes, int, int]:
        """Ids of a part whose first skipped candidates are `drops`, the last one from draw `n`; candidates taken after it
        before the next skipped one, and that one's draw."""
        at = drops[-1]

        def numbers() -> Iterator[int]:
            nonlocal at, n
            yield from drops
            while True:
                n += 1
                at += self.taken(key, n) + 1
                yield at

        pieces, seen = self.merged(part, numbers())
        return self._ids(pieces), at - seen, n

    def _skipping(self, parts: list[tuple[str, Way]], taken: float, key: int) -> bytes:
        """Ids of a chunk of which the draws of `key` skip candidates; the first after `taken` ones."""
        found, n = [], 0
        for part, way in parts:
            while taken < way.left:
                further = way.further.get(taken) if way.further else None
                if further is None:
                    drops = (*way.drops, (way.drops[-1] + 1 if way.drops else 0) + taken)
                    if len(drops) > KEPT_DROPS:
                        ids, taken, n = self._alone(part, drops, key, n)
                        break
                    further = self._way(part, drops)
                    way.further = {**(way.further or {}), taken: further}
                    self.held += 1
                way = further
                n += 1
                taken = self.taken(key, n)
            else:
                ids = way.ids
                taken -= way.left
            found.append(ids)
        return b"".join(found)

    def _scalar(self, chunk: str, taken: float, key: int) -> bytes:
        """Ids of one occurrence of a chunk, with what is kept of earlier ones."""
        if self.held > self.most:
            self.held = 0
            self.kept.clear()
        whole = self.kept.get(chunk)
        if not whole:
            if whole is None:  # most chunks are met once
                self.kept[chunk] = ()
                self.held += 1
                return self._once(chunk, taken, key)
            whole = self._whole(chunk)
        return whole[1] if taken >= whole[0] else self._skipping(whole[2], taken, key)

    def _matrix(self, chunks: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of chunks of at most `width` characters, filled up with GONE, and the number of each one's part."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        chars = np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4").astype(np.int64)
        inside = np.arange(width) < sizes[:, None]
        codes = np.zeros(inside.shape, dtype=np.int64)
        codes[inside] = chars
        symbols = np.where(inside, self.merges.of_char[codes], GONE)
        ends = ~self.merges.neighbours(codes[:, :-1], codes[:, 1:])
        parts = np.zeros(inside.shape, dtype=np.int64)
        np.cumsum(ends, axis=1, out=parts[:, 1:])
        return symbols, parts

    def _agendas(self, symbols: np.ndarray, parts: np.ndarray, taken: np.ndarray | None = None, keys: np.ndarray | None = None) -> np.ndarray:
        """`merged` of many chunks at once, a candidate of each in a step: the symbols left, with GONE between them. Parts come
        one after the other. The first skipped candidate follows `taken` ones, later ones the draws of `keys`; none without."""
        merges, (n, width) = self.merges, symbols.shape
        symbols, made = symbols.ravel().copy(), np.full((n, width), NO, dtype=np.int64)
        made[:, :-1] = merges.made(symbols.reshape(n, width)[:, :-1], symbols.reshape(n, width)[:, 1:])
        first = (parts * merges.ranks).ravel()
        agenda = np.where(made == NO, DONE, parts * merges.ranks + merges.rank[made])
        made, after, before = made.ravel(), np.tile(np.arange(1, width + 1), n), np.tile(np.arange(-1, width - 1), n)
        rows, draws = np.arange(n), np.zeros(n, dtype=np.uint64)
        left = None if taken is None else taken.copy()
        while len(rows):
            at = agenda.argmin(axis=1)
            open_ = agenda[np.arange(len(rows)), at] < DONE
            if not open_.all():
                agenda, rows, at = agenda[open_], rows[open_], at[open_]
            here = np.arange(len(rows))
            if left is not None:
                out = left[rows] == 0
                if out.any():
                    of, k = rows[out], at[out]
                    agenda[here[out], k] = DONE
                    draws[of] += np.uint64(1)
                    left[of] = self.taken_of(keys[of] + draws[of] * np.uint64(GOLDEN))
                    here, at = here[~out], at[~out]
                left[rows[here]] -= 1
            start = rows[here] * width
            one = start + at
            two = start + after[one]
            symbols[one], symbols[two] = made[one], GONE
            agenda[here, two - start] = DONE
            following, previous = after[two], before[one]
            after[one] = following
            some = following < width
            before[(start + following)[some]] = at[some]
            new = np.full(len(one), NO, dtype=np.int64)
            new[some] = merges.made(symbols[one[some]], symbols[(start + following)[some]])
            made[one] = new
            agenda[here, at] = np.where(new == NO, DONE, first[one] + merges.rank[new])
            some = previous >= 0
            one, earlier = one[some], (start + previous)[some]
            new = merges.made(symbols[earlier], symbols[one])
            made[earlier] = new
            agenda[here[some], previous[some]] = np.where(new == NO, DONE, first[earlier] + merges.rank[new])
        return symbols.reshape(n, width)

    def _blocks(self, chunks: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(width, places) of the chunks whose agendas are run together."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        classes = np.searchsorted(WIDTHS, sizes)
        for k, width in enumerate(WIDTHS):
            if len(places := np.flatnonzero((classes == k) & (sizes > 0))):
                yield width, places

    def encode(self, text: str, doc_id: int) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. A mark that stands for a space elsewhere is spelled in bytes."""
        return self.encode_all([text], [doc_id])[0]

    def encode_all(self, texts: list[str], doc_ids: list[int]) -> list[bytes]:
        """`encode` of several texts: the agendas of all their words are run together, by numpy."""
        chunks, keys, ends = [], [], []
        for text, doc_id in zip(texts, doc_ids):
            segments = (" " + text).split(SPACE) if text and SPACE in text else [" " + text] if text else []
            for n, segment in enumerate(segments):
                if n:
                    chunks.append("")  # stands for a mark
                    keys.append(np.zeros(1, dtype=np.uint64))
                found = self.chunks.findall(segment.replace(" ", SPACE))
                first = xxhash.xxh64_intdigest(f"{doc_id}/{n}", self.seed)
                chunks += found
                keys.append(np.arange(len(found), dtype=np.uint64) + np.uint64(first))
            ends.append(len(chunks))
        if not chunks:
            return [b""] * len(texts)
        keys = np.concatenate(keys)
        if self.variants:
            keys = (keys * np.uint64(GOLDEN) >> np.uint64(32)) % np.uint64(self.variants)
        distinct = list(dict.fromkeys(chunks))
        numbers = dict(zip(distinct, range(len(distinct))))
        codes = np.fromiter(map(numbers.__getitem__, chunks), np.int64, len(chunks))
        sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
        flat, counts, starts, held = [], np.zeros(len(chunks), dtype=np.int64), np.zeros(len(chunks), dtype=np.int64), 0

        def keep(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
            """Ids of rows one after the other are stored; their starts."""
            nonlocal held
            flat.append(ids)
            found = held + np.cumsum(lengths) - lengths
            held += len(ids)
            return found

        taken = None if self.never else self.taken_of(keys)
        matrices, whole, whole_starts = {}, np.zeros(len(distinct), dtype=np.int64), np.zeros(len(distinct), dtype=np.int64)
        candidates, place = np.zeros(len(distinct), dtype=np.int64), np.zeros(len(distinct), dtype=np.int64)
        if "" in numbers:
            mark = np.frombuffer(self.mark, "<u4")
            whole[numbers[""]], whole_starts[numbers[""]] = len(mark), keep(mark, np.array([len(mark)]))[0]
        for width, places in self._blocks(distinct):
            matrices[width] = symbols, parts = self._matrix([distinct[k] for k in places], width)
            place[places] = np.arange(len(places))
            left = self._agendas(symbols, parts)
            candidates[places] = sizes[places] - (left != GONE).sum(axis=1)  # each one takes two symbols together
            ids, whole[places] = self.merges.spelled(left)
            whole_starts[places] = keep(ids, whole[places])
        counts[:], starts[:] = whole[codes], whole_starts[codes]
        if taken is not None:
            skips = taken < candidates[codes]
            classes = np.searchsorted(WIDTHS, sizes)[codes]
            for width, (symbols, parts) in matrices.items():
                at = np.flatnonzero(skips & (classes == np.searchsorted(WIDTHS, width)))
                if len(at):
                    of = place[codes[at]]
                    ids, counts[at] = self.merges.spelled(self._agendas(symbols[of], parts[of], taken[at], keys[at]))
                    starts[at] = keep(ids, counts[at])
        for k in np.flatnonzero(sizes[codes] > SHORT).tolist():
            ids = np.frombuffer(self._scalar(chunks[k], NONE if taken is None else int(taken[k]), int(keys[k])), "<u4")
            counts[k] = len(ids)
            starts[k] = keep(ids, counts[k:k + 1])[0]
        totals = np.cumsum(counts)
        picked = np.repeat(starts - (totals - counts), counts) + np.arange(totals[-1])
        out = np.concatenate(flat).astype("<u4")[picked].tobytes()
        bounds = [0, *[int(totals[end - 1]) * 4 if end else 0 for end in ends]]
        return [out[a:b] for a, b in zip(bounds, bounds[1:])]


def blocks(sizes: Iterable[int], most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """(start, number) of neighbouring values of about `most` bytes together."""
    start = held = k = 0
    for k, size in enumerate(sizes, 1):
        held += size
        if held >= most:
            yield start, k - start
            start, held = k, 0
    if start < k:
        yield start, k - start


def _sliced(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """A batch in pieces, by the bytes of a column, so that what a worker makes at once stays small."""
    for start, number in blocks(pc.binary_length(batch.column(column)).to_pylist()):
        yield batch.slice(start, number)


_MADE: dict[tuple, Encoder] = {}
_PIECES: dict[str, Pieces] = {}


def encode(docs: DataFrame, rate: float = 0.1, seed: int = 17, variants: int | None = None, vocabulary_path: str | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, ids): little-endian unsigned 32-bit ids of every text, with merges dropped at `rate`.

    Every occurrence of a word has draws of its own; `variants` bounds them. A null text is an empty one and has no ids;
    a null id counts as -1 for the draws and stays null; repeated rows are cut alike; other columns are not read.
    """
    key = (vocabulary_path or vocabulary("piece_bpe_32k.model"), rate, seed, variants)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _MADE:
            _MADE[key] = Encoder(*key)
        made = _MADE[key]
        for some in (part for batch in batches for part in _sliced(batch, "text")):
            ids = made.encode_all(some.column("text").to_pylist(), [-1 if n is None else n for n in some.column("doc_id").to_pylist()])
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(ids, pa.binary())], ["doc_id", "text", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """`encoded` (doc_id, text, ids) with `decoded`, made from the ids alone."""
    path = vocabulary_path or vocabulary("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _PIECES:
            _PIECES[path] = Pieces(path)
        spelled = _PIECES[path].spelled
        for some in (part for batch in batches for part in _sliced(batch, "ids")):
            texts = [b"".join(map(spelled.__getitem__, np.frombuffer(ids, "<u4").tolist()))[1:].decode() for ids in some.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(texts, pa.string())], ["doc_id", "text", "ids", "decoded"])

    return encoded.mapInArrow(run, ENCODED + ", decoded string")
