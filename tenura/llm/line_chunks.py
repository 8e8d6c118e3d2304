"""Line dedup by chunks that their content defines, with DataFrame functions only.

A chunk ends after a line where a rolling hash over the last two line hashes falls on a boundary value, so that lines put
in before it shift nothing. What occurs again anywhere in the corpus is a candidate by hash; its bytes are compared with
the first occurrence.

`passage_dedup` takes repeated chunks out and follows each passage to its ends: a passage begins and ends inside a chunk,
and a short one fills none, so every two lines that follow one another (and every long line alone) are units too. Those
inside a repeated chunk go with it and are not looked at again; the others carry the passage line by line to both sides.

`line_dedup` compares whole chunks only. Passages that don't fill a chunk stay there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import HOT_SHARE, hot_keys, saved, spread

NO_ID = -(2 ** 63)
#: A line of this many words and more is a passage by itself.
LONG_LINE = 50
#: One in so many lines ends a chunk.
ONE_IN = 4
#: Of what a document has at one line, at most a chunk, a pair and a long line begin there.
UNITS_A_LINE = 3


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def chunks_of(lines: Column, one_in: int) -> Column:
    """Array of (start, lines, filled, hash): first line from 0, number of lines, lines that aren't blank, hash of the line hashes."""

    def ends_of(hashes: Column) -> Column:
        before = F.slice(F.concat(F.array(F.lit(0).cast("long")), hashes), 1, F.size(hashes))
        cut = F.zip_with(hashes, before, lambda here, last: F.pmod(F.xxhash64(last, here), F.lit(one_in)) == 0)
        inner = F.filter(F.transform(cut, lambda c, i: F.when(c, i + 1)), lambda e: e.isNotNull())
        return F.array_union(inner, F.array(F.size(hashes)))

    def chunk(hashes: Column, ends: Column) -> Column:
        def one(end: Column, k: Column) -> Column:
            start = F.when(k == 0, 0).otherwise(F.get(ends, k - 1))
            part = lambda of: F.slice(of, start + 1, end - start)
            filled = F.size(F.filter(part(lines), lambda line: F.trim(line) != ""))
            return F.struct(start.alias("start"), (end - start).alias("lines"), filled.alias("filled"), F.xxhash64(part(hashes)).alias("hash"))

        return F.transform(ends, one)

    return let(F.transform(lines, lambda line: F.xxhash64(line)), lambda hashes: let(ends_of(hashes), lambda ends: chunk(hashes, ends)))


def chunk_text(lines: Column, chunk: Column) -> Column:
    return F.array_join(F.slice(lines, chunk["start"] + 1, chunk["lines"]), "\n")


def units_of(lines: Column, one_in: int = ONE_IN, long_line: int = LONG_LINE) -> Column:
    """Array of (start, lines, filled, hash): chunks of three lines and more, every line with the next one, and every long
    line alone. Blank lines are none, and don't tell chunks or pairs apart."""

    def units(places: Column) -> Column:
        def whole(chunk: Column) -> Column:
            first, last = F.get(places, chunk["start"]), F.get(places, chunk["start"] + chunk["lines"] - 1)
            return F.struct(first.alias("start"), (last - first + 1).alias("lines"), chunk["filled"].alias("filled"), chunk["hash"].alias("hash"))

        def pair(at: Column, k: Column) -> Column:
            after = F.get(places, k + 1)
            return F.when(after.isNotNull(), F.struct(
                at.alias("start"), (after - at + 1).alias("lines"), F.lit(2).alias("filled"), F.xxhash64(F.get(lines, at), F.get(lines, after)).alias("hash")))

        def alone(at: Column) -> Column:
            line = F.get(lines, at)
            long = (F.length(line) >= 2 * long_line - 1) & (F.size(F.split(F.trim(line), r"\s+")) >= long_line)
            return F.when(long, F.struct(at.alias("start"), F.lit(1).alias("lines"), F.lit(1).alias("filled"), F.xxhash64(line).alias("hash")))

        chunks = F.filter(chunks_of(F.transform(places, lambda i: F.get(lines, i)), one_in), lambda c: c["filled"] > 2)
        return F.filter(F.concat(F.transform(chunks, whole), F.transform(places, pair), F.transform(places, alone)), lambda c: c.isNotNull())

    return let(F.filter(F.transform(lines, lambda line, i: F.when(F.trim(line) != "", i)), lambda i: i.isNotNull()), units)


def unit_text(lines: Column, unit: Column) -> Column:
    """The lines of a unit without the blank ones between."""
    first, last = F.get(lines, unit["start"]), F.get(lines, unit["start"] + unit["lines"] - 1)
    whole = F.array_join(F.filter(F.slice(lines, unit["start"] + 1, unit["lines"]), lambda line: F.trim(line) != ""), "\n")
    return F.when(unit["filled"] == 1, first).when(unit["filled"] == 2, F.concat_ws("\n", first, last)).otherwise(whole)


def not_covered(flags: Column) -> Column:
    """`flags` without pairs that lie in a repeated chunk and are no first occurrences. Where a chunk occurs again, so do
    its pairs, at the same lines. A cover of each line that such a chunk's pairs begin at is sorted before them."""
    blank = {"lines": "int", "filled": "int", "hash": "long", "salts": "int", "first": "boolean"}

    def marked(flag: Column) -> Column:
        return F.struct(flag["start"].alias("start"), F.lit(1).alias("kind"), *[flag[c].cast(t).alias(c) for c, t in blank.items()])

    def covers(flag: Column) -> Column:
        return F.transform(F.sequence(flag["start"], flag["start"] + flag["lines"] - 2), lambda i: F.struct(
            i.alias("start"), F.lit(0).alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in blank.items()]))

    def left(events: Column) -> Column:
        def covered(event: Column, k: Column) -> Column:
            before = [F.get(events, k - j) for j in range(1, UNITS_A_LINE + 1)]
            hits = [F.coalesce((b["start"] == event["start"]) & (b["kind"] == 0), F.lit(False)) for b in before]
            return hits[0] | hits[1] | hits[2]

        return F.filter(events, lambda e, k: (e["kind"] == 1) & (e["first"] | (e["filled"] > 2) | ~covered(e, k)))

    wholes = F.filter(flags, lambda f: (f["filled"] > 2) & ~f["first"])
    return let(F.array_sort(F.concat(F.flatten(F.transform(wholes, covers)), F.transform(flags, marked))), left)


def line_dedup(docs: DataFrame, one_in: int = 3, least_lines: int = 2, id_col: str = "doc_id", text_col: str = "text",
               hot_least: int = 256) -> DataFrame:
    """`docs` with repeated chunks taken out of the text, and `removed_chunks` and `removed_lines`.

    A chunk counts when it has at least `least_lines` lines that aren't blank; its occurrence in the smallest id stays
    (there the first), all others go. Null and empty texts stay as they are. Rows with the same id and text are one
    document and keep equal texts; a null id is the smallest. Two different chunks with the same 64-bit hash both stay.
    Other columns pass through; names that begin with `_ld_` are taken.
    """
    return _without_repeated(docs, lambda lines: F.filter(chunks_of(lines, one_in), lambda c: c["filled"] >= least_lines), chunk_text,
                             lambda gone, _: F.size(gone), id_col, text_col, hot_least)


def passage_dedup(docs: DataFrame, long_line: int = LONG_LINE, id_col: str = "doc_id", text_col: str = "text", hot_least: int = 256,
                  one_in: int = ONE_IN) -> DataFrame:
    """`docs` with repeated passages taken out of the text, and `removed_chunks` (stretches of lines) and `removed_lines`.

    A passage is a run of two lines and more that aren't blank, or one line of `long_line` words and more. Blank lines
    inside a run don't count and go with it. Of every chunk and of every two lines the occurrence in the smallest id stays
    (there the first), all others go, but for those that share a line with the first; so every line stays somewhere. The
    size of chunks (`one_in`) changes the work, not the result. The rest is as in `line_dedup`.
    """
    def stretches(_: Column, lines: Column) -> Column:
        return F.size(F.array_except(lines, F.transform(lines, lambda i: i + 1)))

    return _without_repeated(docs, lambda lines: units_of(lines, one_in, long_line), unit_text, stretches, id_col, text_col, hot_least)


def _without_repeated(docs: DataFrame, units_of: Callable[[Column], Column], body_of: Callable[[Column, Column], Column],
                      count_of: Callable[[Column, Column], Column], id_col: str, text_col: str, hot_least: int) -> DataFrame:
    """`docs` without the units of lines that occur at an earlier place; `count_of` (units, numbers of the lines) gone is `removed_chunks`."""
    keyed = docs.withColumns({"_ld_doc": F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), "_ld_mark": F.xxhash64(F.col(text_col))})
    text = F.col(text_col)
    found = keyed.where(text.isNotNull()).select("_ld_doc", "_ld_mark", F.explode(let(lines_of(text), units_of)).alias("unit"))
    seen = saved(found.select("_ld_doc", "_ld_mark", F.col("unit.start").alias("start"), F.col("unit.lines").alias("lines"),
                              F.col("unit.filled").alias("filled"), F.col("unit.hash").alias("hash")), "lines-seen")
    total = seen.count()
    place = F.struct("_ld_doc", "_ld_mark", "start", "lines")
    repeated = saved(seen.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1"), "lines-repeated")
    limit = max(hot_least, total // HOT_SHARE)
    hot = hot_keys(repeated, total, hot_least).drop("salts")
    plain = seen.join(hot.select("hash"), "hash", "left_anti").join(repeated.where(F.col("n") <= limit), "hash")
    marked = plain.unionByName(seen.join(hot, "hash"))
    same_doc = (F.col("_ld_doc") == F.col("first._ld_doc")) & (F.col("_ld_mark") == F.col("first._ld_mark"))
    inside = same_doc & (F.col("start") > F.col("first.start")) & (F.col("start") < F.col("first.start") + F.col("first.lines"))
    salts = F.ceil(F.col("n") / limit).cast("int")
    flags = marked.where(~inside).select(
        "_ld_doc", "_ld_mark", F.struct("start", "lines", "filled", "hash", salts.alias("salts"), (place == F.col("first")).alias("first")).alias("flag"))
    flags = flags.groupBy("_ld_doc", "_ld_mark").agg(F.collect_set("flag").alias("_ld_flags"))  # as many as a document has units
    flags = flags.withColumn("_ld_flags", not_covered(F.col("_ld_flags")))
    joined = saved(keyed.join(flags, ["_ld_doc", "_ld_mark"], "left"), "lines-flagged")
    touched = joined.where(F.col("_ld_flags").isNotNull())

    def with_text(lines: Column) -> Column:
        return F.transform(F.col("_ld_flags"), lambda f: F.struct(
            f["start"].alias("start"), f["lines"].alias("lines"), f["hash"].alias("hash"), f["salts"].alias("salts"), f["first"].alias("first"),
            body_of(lines, f).alias("body")))

    texts = touched.select("_ld_doc", "_ld_mark", F.inline(let(lines_of(text), with_text)))
    firsts = (texts.where("first").select("hash", "salts", F.col("body").alias("first_body")).dropDuplicates(["hash"])
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts"))
    others = texts.where("NOT first").withColumn("salt", F.pmod(spread("_ld_doc", "start"), F.col("salts")).cast("int"))
    equal = others.join(firsts, ["hash", "salt"]).where(F.col("body") == F.col("first_body"))
    gone = equal.groupBy("_ld_doc", "_ld_mark").agg(F.collect_set(F.struct("start", "lines")).alias("_ld_gone"))
    numbers = F.array_distinct(F.flatten(F.transform("_ld_gone", lambda g: F.sequence(g["start"], g["start"] + g["lines"] - 1))))

    def rest(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_ld_lines"))
        return F.transform(kept, lambda i: F.get(lines, i))

    order = docs.columns
    changed = touched.join(gone, ["_ld_doc", "_ld_mark"], "left").withColumn("_ld_lines", numbers)
    changed = changed.withColumn("_ld_rest", F.when(F.col("_ld_gone").isNotNull(), let(lines_of(text), rest)))
    cleaned = changed.withColumns({
        text_col: F.when(F.col("_ld_gone").isNull(), text).otherwise(F.array_join("_ld_rest", "\n")),
        "removed_chunks": F.when(F.col("_ld_gone").isNull(), 0).otherwise(count_of(F.col("_ld_gone"), F.col("_ld_lines"))),
        "removed_lines": F.when(F.col("_ld_gone").isNull(), 0).otherwise(F.size("_ld_lines"))})
    same = joined.where(F.col("_ld_flags").isNull()).withColumns({"removed_chunks": F.lit(0), "removed_lines": F.lit(0)})
    columns = [*(c for c in order if c not in ("removed_chunks", "removed_lines")), "removed_chunks", "removed_lines"]
    return same.select(columns).unionByName(cleaned.select(columns))
