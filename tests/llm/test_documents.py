"""Operators on documents against brute force, on odd documents and on the smallest tables."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.llm import near_join as near
from tenura.llm.common import vocabulary
from tenura.llm.exact_dedup import directory, exact_dedup
from tenura.llm.line_chunks import chunks_of, let, line_dedup, lines_of, not_covered, passage_dedup
from tenura.llm.packing import best_fit, bin_completion, lower_bound, pack, sequences
from tenura.llm.token_files import Shard, digest, read_tokens, to_payload, write_tokens
from tenura.llm.word_ids import WordEncoder
from tests.llm.helpers import frame, odd_documents, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


# exact dedup

def dedup_by_hand(rows):
    lowered = [(i, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for i, t in rows]
    groups = collections.defaultdict(list)
    for i, body in lowered:
        groups[body].append(i)
    best = {body: max((i for i in ids if i is not None), default=None) for body, ids in groups.items()}
    return [(i, best[b], len(groups[b]), hashlib.sha256(b.encode()).hexdigest()) for i, b in lowered]


@pytest.mark.parametrize("bits,hot", [(64, 256), (4, 256), (64, 3), (3, 2)])
def test_exact_dedup(spark, bits, hot):
    rows = odd_documents()
    got = exact_dedup(frame(spark, rows), key_bits=bits, hot_least=hot, bucket_keys=8).collect()
    found = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr)
    assert found == sorted(dedup_by_hand(rows), key=repr)
    kept = collections.Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len({r["text_sha256"] for r in got})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_directory_doubles():
    cells = [(k, 1) for k in range(0, 1 << 16, 7)]
    depth, places = directory(cells, 100)
    held = collections.Counter(int(places[c >> (16 - depth)]) for c, _ in cells)
    assert len(places) == 1 << depth and max(held.values()) <= 100
    assert directory([], 5)[0] == 0 and directory([(3, 10 ** 9)], 5)[0] == 16


# tokens

def test_word_encoder_is_the_library(tokenizer):
    encoder = WordEncoder(vocabulary("word_bpe_49k.json"), most=50)
    random.seed(3)
    letters = [chr(c) for c in [*range(32, 0x180), 0x301, 0x308, 0x3a3, 0x130, 0x212b, 0x1e9e, 0x2028, 0x85, 0xa0]] + ["'s", "'ll", "<|endoftext|>", "日本"] * 4
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 40))) for _ in range(3000)]
    for text in [*texts, "", " ", "ΑΣ Σ it's IT'S 12 !!??"]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def valid(plan, counts, capacity):
    used = collections.Counter()
    for times, filling in plan:
        assert sum(k * n for k, n in filling) <= capacity
        for k, n in filling:
            used[k] += times * n
    return used == collections.Counter({k: n for k, n in counts.items() if n})


def fewest(items, capacity):
    """Exact, by trying every bin for every item."""
    best = len(items)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for n in range(len(bins)):
            if bins[n] + items[k] <= capacity and bins[n] not in bins[:n]:
                place(k + 1, bins[:n] + [bins[n] + items[k]] + bins[n + 1:])
        place(k + 1, bins + [items[k]])

    place(0, [])
    return best


def test_bin_completion_is_optimal_on_small_sets():
    random.seed(5)
    for _ in range(40):
        items = sorted((random.randint(2, 14) for _ in range(random.randint(1, 9))), reverse=True)
        counts = collections.Counter(items)
        plan = bin_completion(counts, 20, nodes=20000, tries=2000, most=50)
        assert valid(plan, counts, 20) and valid(best_fit(counts, 20), counts, 20)
        assert sum(n for n, _ in plan) == fewest(items, 20)


def test_bin_completion_beats_or_equals_best_fit():
    random.seed(6)
    for size, low, high in ((200, 100, 900), (3000, 1, 999), (500, 300, 520), (7, 1000, 1000), (0, 1, 2)):
        counts = collections.Counter(random.randint(low, high) for _ in range(size))
        plan = bin_completion(counts, 1000)
        assert valid(plan, counts, 1000)
        assert lower_bound(counts, 1000) <= sum(n for n, _ in plan) <= sum(n for n, _ in best_fit(counts, 1000))


def test_pack(spark, tokenizer):
    rows = odd_documents()
    pieces, places = pack(frame(spark, rows), capacity=256, nodes=300)
    expected = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        expected += [(doc_id, n, at, len(ids[at:at + 256]), crc(ids[at:at + 256])) for n, at in enumerate(range(0, len(ids), 256))]
    got = places.collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=repr) == sorted(expected, key=repr)
    held = collections.defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(held) <= lower_bound(collections.Counter(e[3] for e in expected), 256) + 1
    whole = places.where("doc_id = 9")
    joined = {r["sequence_id"]: r["ids"] for r in sequences(pieces.where("doc_id = 9"), whole).collect()}
    assert sum(len(x) for x in joined.values()) == 4 * sum(r["length"] for r in got if r["doc_id"] == 9)


@pytest.mark.parametrize("shard_ids", [50, 2_000_000])
def test_token_files(spark, tokenizer, shard_ids):
    rows = [r for r in odd_documents() if r[0] is not None]
    got = sorted(tuple(r) for r in digest(read_tokens(write_tokens(frame(spark, rows), shard_ids=shard_ids))).collect())
    start, left = 0, collections.defaultdict(collections.Counter)
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        left[doc_id][(len(ids), crc(ids))] += 1
    for doc_id, at, n, digest_ in sorted(got, key=lambda r: r[1]):
        assert at == start
        start += n
        left[doc_id][(n, digest_)] -= 1
    assert all(n == 0 for c in left.values() for n in c.values()) and [r[0] for r in sorted(got, key=lambda r: r[1])] == sorted(r[0] for r in rows)
    null_ids = digest(read_tokens(write_tokens(frame(spark, [(None, "a"), (1, "b"), (None, None)])))).orderBy("start").collect()
    assert [r["doc_id"] for r in null_ids] == [None, None, 1]


@pytest.mark.parametrize("base", [49408, 70000])
def test_grammar_round_trip(base):
    random = np.random.default_rng(4)
    for _ in range(20):
        docs = [random.integers(0, random.integers(2, 40), random.integers(1, 400)).astype("<u4") for _ in range(random.integers(1, 30))]
        docs[0] = np.full(101, 7, dtype="<u4")
        payload = to_payload(list(range(len(docs))), [d.tobytes() for d in docs], base)
        shard = Shard(payload)
        assert len(shard.left) > 0
        for n in reversed(range(len(docs))):  # any document alone
            assert (shard.ids(n) == docs[n]).all()


# line dedup

def test_line_dedup(spark):
    rows = odd_documents()
    docs = frame(spark, rows)
    got = [(r["doc_id"], r["text"], r["removed_chunks"]) for r in line_dedup(docs, hot_least=2).collect()]
    cut = docs.where("text is not null").select("doc_id", "text", let(lines_of(F.col("text")), lambda x: chunks_of(x, 3)).alias("c")).distinct().collect()
    seen = collections.defaultdict(list)
    chunks = {}
    for r in cut:
        lines = r["text"].split("\n")
        own = [(c["start"], "\n".join(lines[c["start"]:c["start"] + c["lines"]]), c["filled"]) for c in r["c"]]
        assert "\n".join(text for _, text, _ in own) == r["text"]
        chunks[(r["doc_id"], r["text"])] = own
        for start, text, filled in own:
            if filled >= 2:
                seen[text].append((-2 ** 63 if r["doc_id"] is None else r["doc_id"], r["text"], start))
    expected = []
    for doc_id, text in rows:
        if text is None:
            expected.append((doc_id, None, 0))
            continue
        kept = [t for start, t, filled in chunks[(doc_id, text)]
                if filled < 2 or min(seen[t], key=lambda p: (p[0], p[2])) == (-2 ** 63 if doc_id is None else doc_id, text, start)]
        expected.append((doc_id, "\n".join(kept), len(chunks[(doc_id, text)]) - len(kept)))
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert sum(n for _, _, n in got) > 10


def passages_by_hand(rows, long_line=50):
    """Texts without what occurs at an earlier place: two lines that follow one another, or a long line."""
    places = sorted({(-2 ** 63 if i is None else i, t) for i, t in rows if t is not None})
    first, gone = {}, collections.defaultdict(set)
    for doc in places:
        lines = doc[1].split("\n")
        filled = [k for k, line in enumerate(lines) if line.strip(" ")]
        units = [(a, b) for a, b in zip(filled, filled[1:])] + [(k, k) for k in filled if len(lines[k].split()) >= long_line]
        for a, b in sorted(units):
            key = lines[a] if a == b else (lines[a], lines[b])
            earlier = first.setdefault(key, (doc, a, b))
            if earlier[0] != doc or a > earlier[2] or a == b != earlier[1]:
                gone[doc] |= set(range(a, b + 1))
    return {doc: ("\n".join(line for k, line in enumerate(doc[1].split("\n")) if k not in gone[doc]), len(gone[doc])) for doc in places}


def passage_rows():
    """Passages of 2 to 5 lines and one long line, each in several documents with lines of their own around."""
    rows = []
    for size in range(2, 6):
        passage = [" ".join(words(7000 + 10 * size + k, 14)) for k in range(size)]
        for copy in range(4):
            own = [" ".join(words(8000 + 100 * size + 10 * copy + k, 7)) for k in range(2 + copy)]
            inner = [passage[0], "", *passage[1:]] if copy == 3 else passage
            rows.append((1000 + 10 * size + copy, "\n".join([*own[:1 + copy], *inner, *own[1 + copy:]])))
    long = " ".join(words(9000, 60))
    rows += [(2000 + copy, "\n".join([f"before {copy}", long, f"after {copy}"])) for copy in range(3)]
    return rows + [(2100, "\n".join(["again"] * 5)), (2101, "again\nonly one shared line\nagain")]


def long_copies():
    """Texts of many lines: copies with lines put in, parts of others, and a text whose second half is its first."""
    lines = [" ".join(words(9100 + k, 6)) for k in range(60)]
    put_in = [x for k, line in enumerate(lines) for x in ([line, f"own line {k}"] if k % 17 == 5 else [line])]
    spaced = [x for k, line in enumerate(lines) for x in ([line, "", " "] if k % 5 == 0 else [line])]
    shared = ["own start", *lines[10:40], "own middle", *lines[45:60], *lines[:3]]
    return [(3000 + k, "\n".join(x)) for k, x in enumerate([lines, put_in, spaced, shared, lines[:30] + lines[:30], ["a", "b"] * 12])]


@pytest.mark.parametrize("hot, one_in", [(2, 4), (256, 4), (256, 1), (256, 2), (256, 10 ** 9)])
def test_passages_of_any_place_go(spark, hot, one_in):
    rows = passage_rows() + odd_documents() + long_copies()
    expected = passages_by_hand(rows)
    got = [(r["doc_id"], r["text"], r["removed_lines"]) for r in passage_dedup(frame(spark, rows), hot_least=hot, one_in=one_in).collect()]
    assert sorted(got, key=repr) == sorted(((i, *(expected[(-2 ** 63 if i is None else i, t)] if t is not None else (None, 0))) for i, t in rows), key=repr)
    lines = {i: n for i, _, n in got}
    assert [lines[1000 + 10 * size + copy] for size in range(2, 6) for copy in range(3)] == [n for size in range(2, 6) for n in (0, size, size)]
    assert [lines[1000 + 10 * size + 3] for size in range(2, 6)] == [3, 4, 5, 6]
    assert [lines[2000 + copy] for copy in range(3)] == [0, 1, 1]


# near join

def near_by_hand(rows):
    sets = []
    for _, text in rows:
        words = re.findall(r"\w+", (text or "").lower())
        n = min(5, len(words))
        sets.append(frozenset(tuple(words[k:k + n]) for k in range(len(words) - n + 1)) if words else frozenset())
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x == y or (x and y and len(x & y) >= 0.8 * len(x | y)):
            links[a] += 1
            links[b] += 1
            root[max(find(a), find(b))] = min(find(a), find(b))
    classes = collections.defaultdict(list)
    for k in range(len(rows)):
        classes[find(k)].append(rows[k][0])
    least = {k: (None if None in ids else min(ids)) for k, ids in classes.items()}
    return [(rows[k][0], least[find(k)], links[k]) for k in range(len(rows))], len(classes)


@pytest.mark.parametrize("block", [1024, 8])
def test_near_join(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    rows = odd_documents()
    got = near.near_join(frame(spark, rows)).collect()
    expected, classes = near_by_hand(rows)
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in got), key=repr) == sorted(expected, key=repr)
    assert len({(r["doc_id"], r["text_mark"]) for r in got if r["kept"]}) == classes


def test_near_join_on_documents(spark, documents):
    got = near.near_join(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    expected, _ = near_by_hand(documents)
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == sorted(expected)


def test_linked_both_ways():
    forest = near.Forest(0.8, 5, 20, 5, 0.9999, 1)
    random = np.random.default_rng(2)
    base = np.unique(random.integers(0, 1 << 60, 60, dtype=np.uint64))
    sets = [np.unique(np.concatenate([random.permutation(base)[:56], random.integers(0, 1 << 60, k, dtype=np.uint64)])) for k in range(12) for _ in range(6)]
    a, b = np.triu_indices(len(sets), 1)
    exact = [len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) >= 0.8 for i, j in zip(a, b)]
    assert forest.linked(sets, a, b).tolist() == exact
    assert [forest.linked(sets, a[k:k + 1], b[k:k + 1])[0] for k in range(0, len(a), 97)] == exact[::97]


def test_components_of_paths(spark):
    edges = [(bytes([k]), bytes([k + 1])) for k in range(1, 30)] + [(bytes([100]), bytes([k])) for k in range(101, 140)]
    got = {bytes(r["node"]): bytes(r["root"]) for r in near.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert {k: v for k, v in got.items() if k[0] < 100} == {bytes([k]): bytes([1]) for k in range(1, 31)}
    assert {v for k, v in got.items() if k[0] >= 100} == {bytes([100])} and len(got) == 70


# empty tables

@pytest.mark.parametrize("operator", [exact_dedup, near.near_join, line_dedup, lambda d: pack(d)[1], lambda d: digest(read_tokens(write_tokens(d)))])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).collect() == []


def test_pairs_inside_a_repeated_chunk_are_not_looked_at(spark):
    def flag(start, lines, filled, first=False):
        return (start, lines, filled, 100 * start + filled, 1, first)

    flags = [flag(0, 2, 2), flag(1, 4, 4), flag(1, 2, 2), flag(1, 1, 1), flag(2, 2, 2, True), flag(3, 2, 2), flag(4, 2, 2), flag(4, 1, 1),
             flag(7, 3, 3, True), flag(7, 2, 2), flag(8, 2, 2)]
    rows = spark.createDataFrame([(flags,)], "f array<struct<start int, lines int, filled int, hash long, salts int, first boolean>>")
    left = rows.select(not_covered(F.col("f")).alias("f")).first()["f"]
    assert [(f["start"], f["filled"]) for f in left] == [(0, 2), (1, 4), (2, 2), (4, 1), (4, 2), (7, 2), (7, 3), (8, 2)]
