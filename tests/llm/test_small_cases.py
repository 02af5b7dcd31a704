"""Single small cases that a plausible implementation gets wrong."""

from __future__ import annotations

import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tarnbrook.llm import jaccard, language, lines, passages, scoring, secret_scan
from tarnbrook.llm.arrays import SPACED, SPACED_LOWER, text_bytes, words


def thue_morse(first: str, second: str, length: int = 1024) -> str:
    return "".join((first, second)[bin(i).count("1") % 2] for i in range(length))


A, B = thue_morse("a", "b"), thue_morse("b", "a")


def hashes(texts, table=SPACED):
    return words(*text_bytes(pa.array(texts)), table).hashes


def test_word_hashes_tell_words_apart():
    rng = np.random.default_rng(1)
    made = {A, B, "a", "A", "aa", "a\x00", "\x00", "\x00\x00", "ab" * 4, "ab" * 4 + "\x00", "ba" * 4, "é", "e"}
    for size in (1, 7, 8, 9, 15, 16, 17, 40):
        made |= {"".join(rng.choice(list("ab"), size)) for _ in range(500)}
    blocks = ["".join(rng.choice(list("xyz"), 8)) for _ in range(4)]
    made |= {"".join(blocks[i] for i in order) for order in ((0, 1, 2, 3), (1, 0, 2, 3), (0, 0, 1, 1), (1, 1, 0, 0), (0, 1, 0, 1))}
    listed = sorted(made)
    found = hashes(listed)
    assert len(found) == len(listed) == len(set(found.tolist()))
    again = hashes([" ".join(listed), "x " + listed[0]])
    assert again[: len(listed)].tolist() == found.tolist() and again[-1] == found[0]
    assert hashes(["ABC dé"], SPACED_LOWER).tolist() == hashes(["abc dé"], SPACED).tolist() != hashes(["ABC dé"], SPACED).tolist()


def test_long_words_of_two_letters(spark):
    shared = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"{A} {shared}"), (2, f"{B} {shared}")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in passages.passage_report(docs).collect()} == {1: 0, 2: 0}
    single = spark.createDataFrame([(1, A), (2, B)], "doc_id long, text string")
    assert sorted(r["component_id"] for r in jaccard.similar_sets(single).collect()) == [1, 2]
    scored = spark.createDataFrame([(i, A) for i in range(8)] + [(100 + i, B) for i in range(60)], "doc_id long, text string")
    held = [i for i in range(60) if zlib.crc32(str(100 + i).encode()) % scoring.FOLDS == scoring.HELD_FOLD][0] + 100
    rows = scored.where(f"doc_id < 8 or doc_id = {held}")
    assert {r["doc_id"]: r["n_known"] for r in scoring.score_documents(rows).collect()}[held] == 1


CLASHES = ["_gone", "_gone_id", "_left", "_kept", "_lines", "_dropped", "others", "h1", "k", "lang_pred", "lang_score", "_line_dedup"]


def test_stages_keep_the_callers_columns(spark):
    repeated = "a line that is long enough to count"
    rows = [(i, f"own line {i} of this document\n{repeated}", "en", *[f"{c}-{i}" for c in CLASHES]) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASHES))
    out = lines.without_repeated_lines(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        assert [r[c] for c in CLASHES] == [f"{c}-{r['doc_id']}" for c in CLASHES]
        assert (repeated in r["text"]) == (r["doc_id"] == 3)
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    assert all([r[c] for c in CLASHES] == [f"{c}-{r['doc_id']}" for c in CLASHES] for r in kept.collect())
    assert lines.without_repeated_lines(docs.select("doc_id", "text")).columns == ["doc_id", "text"]


def test_letters_are_unicode_letters(spark):
    docs = spark.createDataFrame([(1, "² ½ ३ _ 12", "en"), (2, "plain words here", "en"), (3, "plain words there", "en"), (4, "日", "en")], "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["lang_pred"] for r in language.language_report(docs).collect()}
    assert found[1] == "und" and found[4] == "en"


def seconds(text):
    began = time.perf_counter()
    found = secret_scan.lexed_spans(text, secret_scan.base_spans(text))
    return time.perf_counter() - began, found


@pytest.mark.parametrize(
    "make",
    [
        lambda n: 'key = "abcdefgh12"\na = key\n' + "a = a + a\n" * n + "password = a\n",
        lambda n: 's = "x"\n' + 's = s + "yZ3"\n' * n + "secret = s\n",
        lambda n: 'password="Abc12345x"\n' * n,
        lambda n: "key " + "a=b&" * n,
        lambda n: "key " + "a=" * n,
    ],
)
def test_secret_scans_take_time_in_proportion(make):
    small, _ = seconds(make(2000))
    large, _ = seconds(make(16000))
    assert large < 24 * small + 0.2


def test_joined_constants_count_as_one_literal():
    text = 'a = "q8Xz1"\nb = a + "7LmPp"\n' + "b = b + a\n" * 30 + "db_password = b\n"
    found = seconds(text)[1]
    assert sorted(text[s:e] for _, s, e in found) == ["7LmPp", "q8Xz1"]
    assert seconds('db_password = "XxXxXxXxXxXxXxXxXxXxXxXx"\n')[1] == []
    assert seconds('db_password = "<put your own password in here>"\n')[1] == []
