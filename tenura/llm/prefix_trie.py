"""Prefix trie of conversations as a z-fast trie kept in tables.

A conversation's prefixes are known by composable hashes, so that numbering turns and hashing prefixes are sums over
partitions and a conversation of any length may lie in many tasks. The compacted trie holds only nodes where conversations
end or part. Each node is found under the hash of one prefix, its handle: the prefix whose length is divisible by the
largest power of two among the lengths of the node's edge. Conversations are inserted in batches: a fat binary search over
handles finds in a logarithm of its length the node where a conversation leaves the trie, the edge there is compared, and
only what lies beyond is looked at turn by turn. At the end edges are expanded into one row for each depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.common import key_counts, saved, spread_join

#: Prefix hashes are two polynomials over this field, so about 122 bits.
FIELD = (1 << 61) - 1
BASES = (1_000_000_007 * 998_244_353 % FIELD, 0x1B873593CC9E2D51 % FIELD)
#: Ids hashed together, and depths of an edge written together.
CHUNK = 1024
#: Rows of a conversation's start that other conversations may take over.
MOST_SHARED = 5

NODE = ["depth", "h1", "h2"]


def two_fattest(low: Column, high: Column) -> Column:
    """Of the numbers in (low, high], the one divisible by the largest power of two: high without the bits below the first
    in which the two differ."""
    differ = low.bitwiseXOR(high)
    for shift in (1, 2, 4, 8, 16, 32):
        differ = differ.bitwiseOR(F.shiftrightunsigned(differ, shift))
    return high.bitwiseAND(F.bitwise_not(F.shiftrightunsigned(differ, 1)))


def _numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, place, h1, h2, points, sum_points): place of each turn in its conversation, hash of the turns up to it,
    code points of its text and of all up to it.

    Rows are sorted over all tasks; a task numbers and hashes its stretch as if its first conversation began there. One
    row of a task then carries on to the next, since the hash of two stretches follows from theirs."""
    order = ("conv_id", "turn", "t1", "t2", "row")
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order)

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, at, state = TaskContext.get().partitionId(), None, (0, 0, 0, 0)
        for batch in batches:
            out = []
            for conv_id, one, two, points in zip(batch["conv_id"].tolist(), batch["t1"].tolist(), batch["t2"].tolist(), batch["points"].tolist()):
                if conv_id != at:
                    at, state = conv_id, (0, 0, 0, 0)
                state = (state[0] + 1, (state[1] * BASES[0] + one) % FIELD, (state[2] * BASES[1] + two) % FIELD, state[3] + points)
                out.append((part, conv_id, *state, points))
            yield pd.DataFrame(out, columns=["part", "conv_id", "place", "h1", "h2", "sum_points", "points"])

    local = saved(ordered.select("conv_id", "t1", "t2", "points").mapInPandas(
        number, "part int, conv_id long, place long, h1 long, h2 long, sum_points long, points long"), "trie-numbered")
    state = F.struct("conv_id", "place", "h1", "h2", "sum_points")
    ends = local.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(state).alias("last")).orderBy("part").collect()  # one row a task
    carried, at, before = {}, None, (0, 0, 0, 0)
    for end in ends:
        if end["first"] != at:
            before = (0, 0, 0, 0)
        if before[0]:
            carried[end["part"]] = (end["first"], *before)
        last = end["last"]
        one = (last["place"], last["h1"], last["h2"], last["sum_points"])
        at, before = last["conv_id"], _joined(before, one) if last["conv_id"] == end["first"] else one
    if not carried:
        return local.drop("part")

    def carry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for part, conv_id, place, h1, h2, sum_points, points in batch.itertuples(index=False, name=None):
                found = carried.get(part)
                own = (place, h1, h2, sum_points)
                out.append((conv_id, *(_joined(found[1:], own) if found and found[0] == conv_id else own), points))
            yield pd.DataFrame(out, columns=["conv_id", "place", "h1", "h2", "sum_points", "points"])

    return local.mapInPandas(carry, "conv_id long, place long, h1 long, h2 long, sum_points long, points long")


def _joined(first: tuple, second: tuple) -> tuple:
    """(length, h1, h2, points) of two stretches one behind the other."""
    return (first[0] + second[0], *((a * pow(base, second[0], FIELD) + b) % FIELD for a, b, base in zip(first[1:3], second[1:3], BASES)), first[3] + second[3])


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id) of all conversations, and (conv_id, depth, h1, h2, points, sum_points) of their rebuilt turns: the first
    h = crc32(conv_id) % 6 turns of conversation conv_id - conv_id % 100, then the own turns after the first h."""
    text, role = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("text", "role"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    halves = [F.conv(F.substring(digest, start, 15), 16, 10).cast("long") for start in (1, 17)]
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.length(text).cast("long").alias("points"), halves[0].alias("t1"), halves[1].alias("t2"))
    # equal rows may change places, and need not lie in one task
    places = saved(_numbered(rows.withColumn("row", F.xxhash64(F.monotonically_increasing_id()))), "trie-places")
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)
    own = saved(places.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), shared.alias("h")), "trie-conversations")
    starts = places.where(F.col("place") <= MOST_SHARED).withColumnRenamed("conv_id", "base")
    taken = own.join(starts, "base").where(F.col("place") <= F.col("h")) \
        .select("conv_id", "h", F.col("place").alias("depth"), "h1", "h2", "points", "sum_points")
    # where the own turns go on: the shared start's hash in place of that of the own first turns
    zero = F.struct(*(F.lit(0).cast("long").alias(name) for name in ("place", "h1", "h2", "sum_points")))
    state = F.struct(F.col("depth").alias("place"), "h1", "h2", "sum_points")
    heads = taken.groupBy("conv_id").agg(F.max(state).alias("head"))
    state = F.struct("place", "h1", "h2", "sum_points")
    tails = places.where(F.col("place") <= MOST_SHARED).join(own, "conv_id").where(F.col("place") <= F.col("h")).groupBy("conv_id").agg(F.max(state).alias("tail"))
    both = own.join(heads, "conv_id", "left").join(tails, "conv_id", "left").select(
        "conv_id", "h", F.coalesce("head", zero).alias("head"), F.coalesce("tail", zero).alias("tail"))
    # a shared start that ends before h moves the own turns up
    later = places.join(both, "conv_id").where(F.col("place") > F.col("h"))

    def go_on(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv_id, place, h1, h2, sum_points, points, h, head, head1, head2, head_points, tail1, tail2, tail_points in batch.itertuples(index=False, name=None):
                more = place - h
                found = ((own_hash + (first - last) * pow(base, more, FIELD)) % FIELD
                         for own_hash, first, last, base in ((h1, head1, tail1, BASES[0]), (h2, head2, tail2, BASES[1])))
                out.append((conv_id, head + more, *found, points, sum_points - tail_points + head_points))
            yield pd.DataFrame(out, columns=["conv_id", "depth", "h1", "h2", "points", "sum_points"])

    went = later.select("conv_id", "place", "h1", "h2", "sum_points", "points", "h", F.col("head.place").alias("head"), F.col("head.h1").alias("head1"),
                        F.col("head.h2").alias("head2"), F.col("head.sum_points").alias("head_points"), F.col("tail.h1").alias("tail1"),
                        F.col("tail.h2").alias("tail2"), F.col("tail.sum_points").alias("tail_points")) \
        .mapInPandas(go_on, "conv_id long, depth long, h1 long, h2 long, points long, sum_points long")
    return own.select("conv_id"), saved(taken.select("conv_id", "depth", "h1", "h2", "points", "sum_points").unionByName(went), "trie-rebuilt")


def _nodes(points: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Nodes of the compacted trie from their places (depth, h1, h2, rep: a sequence through it): the parent's depth, the
    handle, and the first prefix of the edge, under which it is found from its parent."""
    path = saved(prefixes.join(points.select(F.col("rep").alias("seq")).distinct(), "seq", "left_semi").select("seq", *NODE), "trie-paths")
    on_path = spread_join(path, points, NODE, key_counts(path, *NODE), path.count())
    # the nodes on a sequence's path, not its turns; most paths have a few
    above = Window.partitionBy("seq").orderBy("depth")
    edges = on_path.withColumn("parent", F.coalesce(F.lag("depth").over(above), F.lit(0).cast("long"))).where(F.col("seq") == F.col("rep")) \
        .select("rep", "parent", *NODE).withColumn("fat", two_fattest(F.col("parent"), F.col("depth")))
    named = [F.col("seq").alias("rep"), *(F.col(name) for name in NODE)]
    handles = prefixes.select(*named).withColumnsRenamed({"depth": "fat", "h1": "fat1", "h2": "fat2"})
    firsts = prefixes.select(*named).withColumnsRenamed({"depth": "first", "h1": "first1", "h2": "first2"})
    return edges.withColumn("first", F.col("parent") + 1).join(handles, ["rep", "fat"]).join(firsts, ["rep", "first"])


def _exits(nodes: DataFrame, batch: DataFrame, prefixes: DataFrame, longest: int) -> DataFrame:
    """(seq, met): how many turns of each sequence of the batch the trie holds.

    `low` is the depth of the deepest node found, `high` the depth beyond which no handle of the sequence lies; `met` the
    longest prefix known to be in the trie and `rep` a sequence through the node found."""
    none = F.lit(None).cast("long")
    state = batch.select("seq", "length", F.lit(0).cast("long").alias("low"), F.col("length").alias("high"), F.lit(0).cast("long").alias("met"), none.alias("rep"))
    at = prefixes.select("seq", F.col("depth").alias("fat"), F.col("h1").alias("fat1"), F.col("h2").alias("fat2"))
    index = nodes.select("fat", "fat1", "fat2", F.col("depth").alias("extent"), F.col("rep").alias("through"))
    for _ in range(longest.bit_length() + 1):
        going = state.where(F.col("low") < F.col("high")).withColumn("fat", two_fattest(F.col("low"), F.col("high"))).join(at, ["seq", "fat"])
        keys = ["fat", "fat1", "fat2"]
        looked = going.join(_asked(going, index, keys), keys, "left")
        found = F.col("extent").isNotNull()
        state = saved(looked.select(
            "seq", "length", F.when(found, F.col("extent")).otherwise(F.col("low")).alias("low"),
            F.when(found, F.col("high")).otherwise(F.col("fat") - 1).alias("high"),
            F.when(found, F.col("fat")).otherwise(F.col("met")).alias("met"), F.coalesce("through", "rep").alias("rep"))
            .unionByName(state.where(F.col("low") >= F.col("high"))), "trie-search")
    # the node's whole edge, or where that is met, the start of the edge below it
    ends = prefixes.select("seq", F.col("depth").alias("low"), F.col("h1").alias("first1"), F.col("h2").alias("first2"))
    own = nodes.select(F.col("depth").alias("low"), F.col("h1").alias("first1"), F.col("h2").alias("first2"), F.lit(True).alias("whole"))
    keys = ["low", "first1", "first2"]
    at_end = state.join(ends, ["seq", "low"], "left")
    at_end = at_end.join(_asked(at_end, own, keys), keys, "left").select(
        "seq", "length", "rep", "met", "low", (F.coalesce("whole", F.lit(False)) | (F.col("low") == 0)).alias("whole"))
    below = at_end.where("whole").select("seq", (F.col("low") + 1).alias("first")).join(
        prefixes.select("seq", F.col("depth").alias("first"), F.col("h1").alias("first1"), F.col("h2").alias("first2")), ["seq", "first"])
    keys = ["first", "first1", "first2"]
    child = below.join(_asked(below, nodes.select(*keys, F.col("rep").alias("child")), keys), keys).select("seq", "child")
    known = saved(at_end.join(child, "seq", "left").select(
        "seq", "length", F.when(F.col("whole"), F.greatest("low", "met")).otherwise(F.col("met")).alias("met"),
        F.when(F.col("whole"), F.col("child")).otherwise(F.col("rep")).alias("rep")), "trie-exits")
    # along that edge turn by turn: prefixes are equal up to one place, so their count is that place
    mine = prefixes.join(known.where(F.col("rep").isNotNull() & (F.col("met") < F.col("length"))), "seq").where(F.col("depth") > F.col("met"))
    theirs = prefixes.select(F.col("seq").alias("rep"), *NODE)
    wanted = saved(mine.select("seq", "rep", *NODE), "trie-edges")
    keys = ["rep", *NODE]
    along = wanted.join(_asked(wanted, theirs, keys), keys).groupBy("seq").agg(F.max("depth").alias("along"))
    return known.join(along, "seq", "left").select("seq", "length", F.greatest("met", F.coalesce("along", F.lit(0).cast("long"))).alias("met"))


def _asked(rows: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """The index's rows of those keys that are asked for. The keys are reduced before they meet the index, so that a key
    which a third of all rows ask for is one row there; joining it back is left to adaptive execution."""
    return index.join(rows.select(*keys).distinct(), keys)


def insert(nodes: DataFrame | None, points: DataFrame | None, batch: DataFrame, prefixes: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """Nodes and their places after another batch of sequences (seq, length)."""
    if nodes is None:
        left = saved(batch.select("seq", "length", F.lit(0).cast("long").alias("met")), "trie-left")
    else:
        left = saved(_exits(nodes, batch, prefixes, longest), "trie-left")
    beyond = prefixes.join(left, "seq").where(F.col("depth") >= F.col("met"))
    # places where a sequence leaves the trie or ends
    turning = beyond.where((F.col("depth") == F.col("met")) | (F.col("depth") == F.col("length"))).select("seq", *NODE)
    # places where sequences of the batch part: after the same prefix, several next ones
    following = beyond.where(F.col("depth") > F.col("met")).groupBy(*NODE).agg(F.min("seq").alias("seq"))
    before = prefixes.select("seq", (F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"))
    parted = following.join(before, ["seq", "depth"]).groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2")) \
        .agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("seq")).where("n > 1").select("seq", *NODE)
    new = turning.unionByName(parted).groupBy(*NODE).agg(F.min("seq").alias("rep"))
    if points is not None:
        new = new.unionByName(points).groupBy(*NODE).agg(F.min("rep").alias("rep"))
    points = saved(new, "trie-points")
    return saved(_nodes(points, prefixes), "trie-nodes"), points


def _ends(ended: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): the digest of ids in ascending order. Ids are listed in stretches of `CHUNK`
    and a digest is made from its stretches in order, so that a node of very many ids is a row for each stretch."""
    listed = ended.groupBy(*NODE, F.floor(F.col("conv_id") / CHUNK).alias("stretch")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    listed = listed.select(*NODE, "stretch", F.concat_ws(",", F.transform("ids", lambda x: x.cast("string"))).alias("ids"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, found = None, None
        for batch in batches:
            out = []
            for *key, ids in batch.itertuples(index=False, name=None):
                if key != at:
                    if at is not None:
                        out.append((*at, found.hexdigest()))
                    at, found = key, hashlib.sha256(ids.encode())
                else:
                    found.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=[*NODE, "ends_sha256"])
        if at is not None:
            yield pd.DataFrame([(*at, found.hexdigest())], columns=[*NODE, "ends_sha256"])

    in_order = listed.repartition(*NODE).sortWithinPartitions(*NODE, "stretch")
    return saved(in_order.select(*NODE, "ids").mapInPandas(digest, "depth long, h1 long, h2 long, ends_sha256 string"), "trie-ends")


def prefix_trie(conversations: DataFrame, batches: int = 2) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row for each node.

    Conversations are ordered by turn, null first; turns with the same number by the MD5 digest of role and text, a null
    role or text being empty. Every conversation is rebuilt on the start of its hundred's first one (see `rebuilt`), and a node is a distinct
    sequence of their first turns. Rows without conv_id take no part; equal rows are turns of their own; other columns
    are not read. No conversations give no rows, not even a root.
    """
    ids, turns = rebuilt(conversations)
    last = turns.groupBy("conv_id").agg(F.max(F.struct("depth", "h1", "h2", "sum_points")).alias("last"))
    zero = F.lit(0).cast("long")
    ends = saved(ids.join(last, "conv_id", "left").select(
        "conv_id", *(F.coalesce(f"last.{name}", zero).alias(name) for name in ("depth", "h1", "h2", "sum_points"))), "trie-last")
    # equal conversations are one sequence, known by its smallest conversation
    sequences = saved(ends.groupBy(*NODE).agg(F.min("conv_id").alias("seq"), F.count(F.lit(1)).alias("n"), F.max("sum_points").alias("total")), "trie-sequences")
    prefixes = saved(turns.join(sequences.select(F.col("seq").alias("conv_id")), "conv_id", "left_semi").withColumnRenamed("conv_id", "seq"), "trie-prefixes")
    longest = sequences.agg(F.max("depth")).first()[0] or 0
    nodes = points = None
    turned = sequences.where("depth > 0").select("seq", F.col("depth").alias("length"))
    for number in range(batches):
        nodes, points = insert(nodes, points, turned.where(F.pmod(F.xxhash64("seq"), F.lit(batches)) == number), prefixes, longest)

    edges = nodes.select("parent", "first1", "first2", *NODE)
    # every sequence and the nodes on its path; a path that a third of all sequences take is split over tasks
    scalars = sequences.select("seq", F.col("depth").alias("length"), "n", "total")
    passing = saved(spread_join(prefixes, edges, NODE, key_counts(prefixes, *NODE), prefixes.count()), "trie-passing")
    owners = passing.join(scalars, "seq").groupBy(*NODE).agg(F.min("seq").alias("owner"), F.sum("n").alias("n_convs"), F.first("parent").alias("parent"))
    owners = saved(owners, "trie-owners")
    root_owner = sequences.agg(F.min("seq")).first()[0]
    # down to `shared` a sequence's path belongs to smaller ones
    owned = spread_join(passing.select("seq", *NODE, "sum_points"), owners.select(*NODE, "owner"), NODE, key_counts(passing, *NODE), passing.count())
    shared = owned.where(F.col("owner") != F.col("seq")).groupBy("seq").agg(F.max(F.struct("depth", "sum_points")).alias("shared"))
    # a node's parent is the place at depth `parent` on its owner's path
    above = prefixes.select(F.col("seq").alias("owner"), F.col("depth").alias("parent"), F.col("h1").alias("p1"), F.col("h2").alias("p2"))
    linked = saved(owners.join(above, ["owner", "parent"], "left")
                   .select("owner", "n_convs", "parent", *NODE, F.coalesce("p1", zero).alias("p1"), F.coalesce("p2", zero).alias("p2")), "trie-linked")
    counted = linked.groupBy(F.col("parent").alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = saved(counted, "trie-children")
    leaf = sequences.join(counted, NODE, "left_anti").select("seq", F.lit(1).cast("long").alias("leaf"))
    facts = saved(scalars.join(shared, "seq", "left").join(leaf, "seq", "left").select(
        "seq", "n", "total", F.coalesce("leaf", zero).alias("leaf"), F.coalesce("shared.sum_points", zero).alias("not_own")), "trie-facts")
    # code points from a node's last turn on: of all members, less those of each distinct node once, counted by its owner
    start = F.col("sum_points") - F.col("points")
    of_all, of_nodes = F.col("n") * (F.col("total") - start), F.col("total") - F.greatest(start, F.col("not_own"))
    sums = passing.join(facts, "seq").groupBy(*NODE).agg(F.sum("leaf").alias("n_leaves"), F.sum(of_all - of_nodes).alias("saved"))
    whole = linked.join(sums, NODE).join(counted, NODE, "left")
    digests = _ends(ends.select("conv_id", *NODE))
    whole = whole.join(digests, NODE, "left")
    parents = owners.select(F.col("depth").alias("parent"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("owner").alias("above"))
    whole = whole.join(parents, ["parent", "p1", "p2"], "left").withColumn("above", F.coalesce("above", F.lit(root_owner)))
    whole = saved(whole.withColumnsRenamed({"depth": "extent"}).select(
        "owner", "parent", "extent", "above", "n_convs", "n_leaves", "saved", F.coalesce("n_children", zero).alias("n_children"), "ends_sha256"), "trie-whole")
    none = hashlib.sha256(b"").hexdigest()
    # one row for each depth of an edge, in two steps so that no array is long
    low = F.explode(F.sequence(F.col("parent") + 1, "extent", F.lit(CHUNK).cast("long"))).alias("low")
    stretched = whole.select("*", low)
    depths = stretched.select("*", F.explode(F.sequence("low", F.least(F.col("low") + CHUNK - 1, F.col("extent")))).alias("depth"))
    at_end = prefixes.select(F.col("seq").alias("owner"), F.col("depth").alias("extent"), F.col("sum_points").alias("end_sum"), F.col("points").alias("end_points"))
    depths = depths.join(at_end, ["owner", "extent"]).join(prefixes.select(F.col("seq").alias("owner"), "depth", "sum_points", "points"), ["owner", "depth"])
    inner = F.col("depth") < F.col("extent")
    # an edge's turns above its end are saved by the same members
    on_edge = (F.col("n_convs") - 1) * ((F.col("end_sum") - F.col("end_points")) - (F.col("sum_points") - F.col("points")))
    below_root = depths.select(
        F.col("owner").alias("conv_id"), "depth", F.when(F.col("depth") == F.col("parent") + 1, F.col("above")).otherwise(F.col("owner")).alias("parent_conv_id"),
        "n_convs", F.when(inner, F.lit(1).cast("long")).otherwise(F.col("n_children")).alias("n_children"), "n_leaves",
        (F.col("saved") + on_edge).alias("saved_tokens"), F.when(inner, F.lit(none)).otherwise(F.coalesce("ends_sha256", F.lit(none))).alias("ends_sha256"))
    root = facts.agg(F.min("seq").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
                     F.sum(F.col("n") * F.col("total") - (F.col("total") - F.col("not_own"))).alias("saved_tokens")).where(F.col("conv_id").isNotNull())
    at_root = [frame.where("depth = 0").select(name) for frame, name in ((counted, "n_children"), (digests, "ends_sha256"))]
    first = [found[0] if (found := frame.first()) else default for frame, default in zip(at_root, (0, none))]
    root = root.select("conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", F.lit(first[0]).cast("long").alias("n_children"),
                       "n_leaves", "saved_tokens", F.lit(first[1]).alias("ends_sha256"))
    return root.unionByName(below_root)
