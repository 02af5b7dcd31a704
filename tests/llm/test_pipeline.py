"""The pipeline's stages against brute-force versions, each on what the one before kept."""

from __future__ import annotations

import hashlib
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline
from test_joins import brute_similar
from test_text_operators import VOCABULARY, brute_contamination, brute_words
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def lines_left(rows):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANKS))
    held = {}
    for r in rows.values():
        for k in {key(x) for x in r["text"].split("\n")}:
            held.setdefault(k, set()).add(r["doc_id"])
    gone = lambda k, d: len(k) >= 20 and len(held[k]) >= 3 and max(held[k]) != d
    return {d: "\n".join(x for x in r["text"].split("\n") if not gone(key(x), d)) for d, r in rows.items()}


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    foreign = [(10**6, "123 456", "en", "s", 7), (10**6 + 1, None, "en", "s", None), (10**6 + 2, "ничего не понятно в этом тексте совсем ничего", "en", "s", 45), (10**6 + 3, "It.", "en", "s", 3)]
    docs = docs.unionByName(spark.createDataFrame(foreign, docs.schema))
    columns, reached = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = rows_of(docs)
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = rows_of(docs)
        assert len(after) == docs.count()
        reached.append(name)
        if name != "bpe":
            assert docs.columns == columns
        if name == "language_id":
            assert set(before) - set(after) == {10**6, 10**6 + 1, 10**6 + 2}
        elif name == "line_dedup":
            want = lines_left(before)
            assert {d: r["text"] for d, r in after.items()} == want
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        elif name == "jaccard_join":
            ids = sorted(before)
            found = brute_similar([before[d]["text"] for d in ids])
            assert set(after) == {ids[root] for _, root in found.values()}
        elif name == "decontamination":
            items = {r["item_id"]: brute_words(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
            dirty = {d for d, r in before.items() for n, hit, _ in [brute_contamination(r["text"], items)] if hit > 0 and 20 * hit >= n}
            assert dirty and set(before) - set(after) == dirty
        else:
            library = Tokenizer.from_file(VOCABULARY)
            for d, r in before.items():
                ids = library.encode(r["text"], add_special_tokens=False).ids
                assert after[d]["ids"] == ids and after[d]["n_tokens"] == len(ids)
                assert after[d]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
    assert reached == ["language_id", "line_dedup", "jaccard_join", "decontamination", "bpe"]


def test_run_is_the_stages_in_order(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
    want = corpus_pipeline.encode(spark, docs, FOLDER)
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in out.collect()) == sorted((r["doc_id"], r["ids_sha256"]) for r in want.collect())


def test_stages_of_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0
