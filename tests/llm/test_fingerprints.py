"""Sketches and followers against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from tarnbrook.llm import fingerprints

COLUMNS = "doc_id long, text string, range string, guest string, fingerprint string"


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    runs = {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    hashes = sorted(hashlib.md5(r.encode()).hexdigest()[:16] for r in runs)
    return [h for h in hashes if int(h, 16) < 2**64 // 8] or hashes[:1]


def alike(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        own, other, follower = brute_print(text), brute_print(edited), brute_print(after)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(own), "".join(other), alike(own, other), alike(own, follower)))
    return sorted(out, key=str)


def compare(spark, rows, size):
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], COLUMNS)
    out = fingerprints.compare_followers(docs, size).collect()
    assert sorted((tuple(r)[:7] for r in out), key=str) == brute(rows)


def texts(count, seed=1):
    pick = random.Random(seed)
    vocabulary = ["alpha", "Beta", "GAMMA", "δέλτα", "日本", "epsilon", "zeta-9", "eta"]
    return [" ".join(pick.choices(vocabulary, k=pick.choice((0, 1, 3, 5, 40, 300)))) for _ in range(count)]


@pytest.mark.parametrize("size", [1, 7, 4096])
def test_reports_equal_brute_force(spark, size):
    """Ids without order or gaps of one size, over one range and over many."""
    ids = random.Random(3).sample(range(-(2**40), 2**40), 60)
    compare(spark, list(zip(ids, texts(60), strict=True)), size)


@pytest.mark.parametrize("size", [2, 4096])
def test_odd_rows(spark, size):
    rows = [(None, "nobody's text here"), (None, None), (3, "b"), (3, "a"), (3, "a"), (4, None), (5, ""), (6, " \n"), (7, "x" * 100_000), (8, "word " * 30_000), (9, "É ß ſK " * 9)]
    compare(spark, rows, size)


@pytest.mark.parametrize("rows", [[], [(1, "only one text is here to be seen")], [(None, "a b c")], [(1, "A b"), (2, "a B")]])
def test_tiny_tables(spark, rows):
    compare(spark, rows, 4096)


def test_driver_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    compare(spark, rows, 50)


def test_sketches_merge():
    """The sketch of a union is the merge of the sketches, whichever of them keep only their least hash."""
    pick = random.Random(5)
    for _ in range(300):
        a, b = (" ".join(pick.choices("abcdefgh", k=pick.randrange(0, 12))) for _ in range(2))
        both = fingerprints._scaled(fingerprints.shingle_hashes(a) | fingerprints.shingle_hashes(b))
        assert fingerprints.merge(fingerprints.sketch(a), fingerprints.sketch(b)) == both


def test_estimates_of_unequal_texts():
    pick = random.Random(7)
    words = [str(pick.random()) for _ in range(40_000)]
    part = fingerprints.sketch(" ".join(words[1000:3000]))
    whole = fingerprints.sketch(" ".join(words))
    half = fingerprints.sketch(" ".join(words[2000:4000]))
    assert fingerprints.containment(part, whole) == 1.0
    assert abs(fingerprints.resemblance(part, whole) - 0.05) < 0.01
    assert abs(fingerprints.containment(part, half) - 0.5) < 0.1


def test_expressions_and_groups(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g h i j"), (3, None), (4, "q")]
    docs = spark.createDataFrame([(i, t, "", "", "") for i, t in rows], COLUMNS)
    prints = fingerprints.fingerprints(docs)
    found = {r["doc_id"]: r for r in prints.collect()}
    assert [found[i]["n_shingles"] for i in (1, 2, 3, 4)] == [3, 6, 0, 1]
    pairs = prints.alias("a").crossJoin(prints.alias("b"))
    from pyspark.sql import functions as F

    for r in pairs.select("a.doc_id", F.col("b.doc_id").alias("other"), fingerprints.contained(F.col("a.fingerprint"), F.col("b.fingerprint")).alias("c")).collect():
        a, b = (fingerprints.sketch(dict(rows)[i] or "") for i in (r["doc_id"], r["other"]))
        assert r["c"] == fingerprints.containment(a, b)
    merged = fingerprints.merged_hashes(prints.withColumn("g", F.lit("all")), "g")
    assert {bytes.fromhex(r["hash"]) for r in merged.collect()} == fingerprints.merge(*(fingerprints.sketch(t or "") for _, t in rows))
