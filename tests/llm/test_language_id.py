"""Language identification: filters against plain sets of n-grams, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.llm import language_id
from tests.llm.helpers import frame, odd_documents

SF = "/root/testdata/sf0.01"


def grams_by_hand(text):
    padded = " " + " ".join(language_id.LETTERS.findall(text)).lower() + " "
    return [padded[i:i + n] for n in language_id.LENGTHS for i in range(len(padded) - n + 1)] if padded.strip() else []


def filters_by_hand(sets, bits=16, hashes=4):
    table = np.zeros((-(-len(sets) // 64), 1 << bits), dtype=np.uint64)
    for n, held in enumerate(sets):
        for gram in held:
            letters = np.array([ord(c) for c in gram], dtype=np.uint32)
            for length, hashed, _ in language_id.grams(letters, np.ones(len(letters), dtype=bool)):
                if length == len(gram):
                    for at in language_id.positions(hashed[:1], bits, hashes):
                        table[n // 64, at[0]] |= np.uint64(1) << np.uint64(n % 64)
    return language_id.Filters([f"l{n}" for n in range(len(sets))], table, bits, hashes)


def test_filters_hold_sets():
    """Every n-gram that a language holds is found, and few others; more than 64 languages take further words."""
    texts = [f"{chr(97 + n % 26)}{chr(97 + n // 26)}lo wor{chr(97 + n % 26)}d" for n in range(70)]
    sets = [set(grams_by_hand(t)) for t in texts]
    filters = filters_by_hand(sets)
    for letters, starts, numbers, own in language_id.pieces(texts + ["", None, "12 34", "q"]):
        total, known = filters.counts(letters, starts, own)
    for n, text in enumerate(texts):
        mine = grams_by_hand(text)
        assert total[n] == len(mine)
        expected = np.array([sum(g in held for g in mine) for held in sets])
        assert (known[n] >= expected).all() and (known[n] - expected).sum() <= 2
    assert total[70:].tolist() == [0, 0, 0, len(grams_by_hand("q"))]


def test_correction():
    """Counts of n-grams that a crowded filter lets through by chance are taken off."""
    rng = np.random.default_rng(5)
    filters = language_id.Filters(["a", "b"], (rng.random((1, 1 << 12)) < 0.6).astype(np.uint64) * np.uint64(1), 12, 2)
    letters = rng.integers(97, 97 + 20000, 40000).astype(np.uint32)
    total, known = filters.counts(letters, np.array([0]), np.ones(len(letters), dtype=bool))
    assert known[0, 0] / total[0] == pytest.approx(filters.by_chance[0], abs=0.02) and filters.by_chance[0] > 0.3
    assert filters.shares(total, known)[0, 0] < 0.02


def test_long_texts_in_pieces(monkeypatch):
    texts = ["one two three four five six seven " * 40, "short", "", None, "ab " * 333]
    filters = filters_by_hand([set(grams_by_hand(texts[0])), set(grams_by_hand(texts[4]))])
    whole = filters.predict(texts)

    def summed(most):
        total = np.zeros(len(texts), dtype=int)
        for letters, starts, numbers, own in language_id.pieces(texts, most):
            assert len(letters) <= most + 2 * len(texts) + 8
            np.add.at(total, numbers, filters.counts(letters, starts, own)[0])
        return total.tolist()

    assert summed(50) == summed(7) == summed(1 << 18) == [len(grams_by_hand(t or "")) for t in texts]
    assert whole[0] == ["l0", "l0", "und", "und", "l1"]


def test_query_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language_id.identify(docs, language_id.fit(language_id.learned_rows(docs)))
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = found.join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    for held_out in (True, False):
        some = [r for r in rows if r["held_out"] == held_out and r["lang"] and any(c.isalpha() for c in r["text"] or "")]
        assert sum(r["lang"] == r["lang_pred"] for r in some) >= 0.99 * len(some)


def test_filters_are_those_of_counted_grams(spark):
    """Against n-grams counted by hand: the share that a language must hold, over all rows when the sample takes all."""
    docs = spark.createDataFrame([(n, t, l) for n, (t, l) in enumerate([("the cat the dog", "en"), ("le chat le chien", "fr"), ("the end", "en"),
                                                                       (None, "en"), ("nothing", None)])], "doc_id long, text string, lang string")
    made = language_id.fit(docs, least_share=0.08, bits=14)
    assert made.languages == ["en", "fr"]
    sets = []
    for texts in (["the cat the dog", "the end"], ["le chat le chien"]):
        counted = [g for t in texts for g in grams_by_hand(t)]
        sets.append({g for g in counted if counted.count(g) >= 0.08 * sum(len(x) == len(g) for x in counted)})
    assert (made.table == filters_by_hand(sets, bits=14).table).all()


def test_odd_rows(spark):
    rows = odd_documents() + [(900, "12345 !?"), (901, "文字だけ"), (902, "😀".encode("utf-16", "surrogatepass").decode("utf-16"))]
    docs = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") < 150, "aa").when(F.col("doc_id") < 300, "bb"))
    found = language_id.identify(docs, language_id.fit(language_id.learned_rows(docs))).collect()
    assert len(found) == len(rows)
    und = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found if r["lang_pred"] == "und"}
    assert {3, 4, 5, 900, 902} <= set(und) and all(score == 0 for _, score in und.values())
    assert {r["lang_pred"] for r in found} <= {"aa", "bb", "und"} and [r["lang_pred"] for r in found if r["doc_id"] == 901] != ["und"]
    assert not any(r["held_out"] for r in found if r["doc_id"] is None)


def test_nothing_learned(spark):
    docs = frame(spark, odd_documents()).withColumn("lang", F.lit(None).cast("string"))
    found = language_id.identify(docs, language_id.fit(docs)).collect()
    assert {(r["lang_pred"], r["score"]) for r in found} == {("und", 0.0)} and len(found) == docs.count()
    assert language_id.identify(docs.limit(0), language_id.fit(docs.limit(0))).count() == 0
