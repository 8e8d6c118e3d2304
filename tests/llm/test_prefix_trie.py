"""Prefix trie against a plain trie of tuples."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tenura.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, depth long, h1 long, seq string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, "s") for row in rows], SCHEMA)


def by_hand(rows):
    turns = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns.setdefault(conv_id, []).append((turn is not None, turn or 0, mark, role, text))
    turns = {c: [t[3:] for t in sorted(own)] for c, own in turns.items()}
    members, ends = {}, {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
        ends.setdefault(whole, []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    found, sums = [], {}
    for node in sorted(members, key=len, reverse=True):
        its = [sums[child] for child in children.get(node, [])]
        leaves = sum(x for x, _ in its) or 1
        saved = sum(y for _, y in its) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        sums[node] = (leaves, saved)
        found.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(its), leaves, saved,
                      hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()))
    return sorted(found, key=repr)


def check(spark, rows, **options):
    found = P.prefix_trie(table(spark, rows), **options)
    assert found.columns == COLUMNS
    assert sorted((tuple(r) for r in found.collect()), key=repr) == by_hand(rows)


def random_rows(seed, convs, most, texts=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(0, 5 * convs), convs):
        for turn in range(rng.randint(1, most)):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if rng.random() < 0.3 else "user", "é" * (turn % 3) + rng.choice("abc"[:texts])))
    return rows


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 41)] + [(2 ** 40 - 3, 2 ** 40 + 5)]
    rows = spark.createDataFrame(pairs, "a long, b long").select("a", "b", P.two_fattest(F.col("a"), F.col("b")).alias("f")).collect()
    for a, b, f in [tuple(r) for r in rows]:
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)


def test_query_on_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)


@pytest.mark.parametrize("seed, batches", [(1, 1), (2, 2), (3, 3)])
def test_random_conversations(spark, seed, batches):
    check(spark, random_rows(seed, 60, 9, texts=2), batches=batches)


def test_exits_are_common_prefixes(spark):
    """The search finds, for every sequence, how many turns the trie of another batch holds."""
    turns = P.rebuilt(table(spark, random_rows(5, 80, 20, texts=2)))[1]
    found = {}
    for r in turns.collect():
        found.setdefault(r["conv_id"], {})[r["depth"]] = (r["h1"], r["h2"])
    paths = {c: tuple(own[d] for d in range(1, len(own) + 1)) for c, own in found.items()}
    seqs = {path: c for c, path in sorted(paths.items(), reverse=True)}
    prefixes = turns.where(F.col("conv_id").isin(list(seqs.values()))).withColumnRenamed("conv_id", "seq").cache()
    halves = [{c: p for p, c in seqs.items() if c % 2 == half} for half in (0, 1)]
    batch = [spark.createDataFrame([(c, len(p)) for c, p in half.items()], "seq long, length long") for half in halves]
    longest = max(map(len, seqs))
    nodes, _ = P.insert(None, None, batch[0], prefixes, longest)
    held = {p[:d] for p in halves[0].values() for d in range(len(p) + 1)}
    for r in P._exits(nodes, batch[1], prefixes, longest).collect():
        path = halves[1][r["seq"]]
        assert r["met"] == max(d for d in range(len(path) + 1) if path[:d] in held)


def test_long_conversation_over_many_tasks(spark):
    rows = [(7, t, "user", f"turn {t % 50}") for t in range(1500)] + [(8, t, "user", f"turn {t % 50}") for t in range(1200)] + [(207, 1, "user", "x")]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        places = P.rebuilt(table(spark, rows))[1].groupBy("conv_id").agg(F.count(F.lit(1)), F.max("depth"), F.countDistinct("depth")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert all(r[1] == r[2] == r[3] for r in places)
    check(spark, rows)


def test_odd_rows(spark):
    """Nulls, repeated turns and rows, prefixes of one another, a base without turns of its own, turnless conversations, no ids."""
    rows = [(c, t, "user", x) for c in (0, 1, 2, 100, 205, 306) for t, x in enumerate(["a", "b", "c", "d", "e", "f", "g"][:3 + c % 5])]
    rows += [(400, None, None, None), (400, 0, "user", ""), (400, 0, "user", ""), (401, None, "user", "a"), (None, 1, "user", "a"), (-3, 1, "user", "a"),
             (-103, 1, "x", "y"), (499, 3, "user", "late"), (499, 1, "user", "early")] + [(500 + k, 0, "user", "same") for k in range(60)]
    rows += [(600, t, "user", "long " * 3000) for t in range(3)]
    check(spark, rows)
    check(spark, [(1, 0, "user", "a")])
    check(spark, [(9, 0, "user", "a"), (9, 0, "user", "a")])
    check(spark, [])


def test_many_ids_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 16)
    check(spark, [(c, t, "user", str(t)) for c in range(300) for t in range(6 + 40 * (c == 17))])
