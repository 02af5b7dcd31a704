"""Merkle manifest against a plain recomputation of the trees."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from tarnbrook.llm import manifest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, h string, path string, r string"


def H(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text) -> str:
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))


def paths(nodes):
    """(root, path of every node) of one tree."""
    found, held = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        following, owners = [], []
        for at in range(0, len(nodes), 16):
            run = nodes[at : at + 16]
            for k in range(len(run)):
                for i in held[at + k]:
                    found[i].append((k, run[:k] + run[k + 1 :]))
            following.append(H(run))
            owners.append([i for o in held[at : at + 16] for i in o])
        nodes, held = following, owners
    return nodes[0], found


def brute(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        groups.setdefault(source, []).append((doc_id, leaf(doc_id, source, lang, n_chars, text), text, lang, n_chars))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        groups[source].sort(key=lambda d: (d[0] is not None, d[0] or 0, d[1]))
        trees[source] = paths([d[1] for d in groups[source]])
    if not order:
        return []
    root, tops = paths([trees[s][0] for s in order])
    out = []
    for source, top in zip(order, tops, strict=True):
        subroot, found = trees[source]
        for (doc_id, own, text, lang, n_chars), path in zip(groups[source], found, strict=True):
            path = path + top
            claim = own
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
                claim = leaf(doc_id, source, lang, n_chars, text.translate(lower))
            for k, siblings in path:
                claim = H([*siblings[:k], claim, *siblings[k:]])
            out.append((doc_id, own, subroot, root, H(x for _, s in path for x in s), claim, claim == root))
    return sorted(out, key=str)


def compare(spark, rows):
    out = manifest.manifest_report(spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], COLUMNS))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 2, 16, 17, 256, 257], [300] + [1] * 17, [4097, 3]])
def test_trees_of_all_shapes(spark, sizes):
    rows, doc_id = [], 0
    for s, size in enumerate(sizes):
        for _ in range(size):
            rows.append((doc_id, f"Text {doc_id}" if doc_id % 3 else f"text {doc_id}", "en", f"s{s}", doc_id % 7))
            doc_id += 1
    compare(spark, rows)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None, None), (None, "A", "en", None, 1), (5, "", "en", "", 0), (5, "", "en", "", 0),  # repeated rows
        (5, "B", "en", "", 1), (-3, "Ä 日本" * 50_000, "de", "é", 3), (0, "A", None, "z", None), (9, "same", "en", "Z", 4), (10, "same", "en", "Z", 4),
    ]
    compare(spark, rows)


def test_empty_table(spark):
    compare(spark, [])


def test_hot_group_over_many_partitions(spark):
    """One group fills several sorted partitions; its ranks go on from one to the next."""
    rows = [(i, "x", "en", "hot" if i % 3 else f"s{i % 7}", 1) for i in range(3000)]
    compare(spark, rows)


def test_a_path_leads_to_the_root_only_from_its_leaf(spark):
    docs = spark.createDataFrame([(i, f"T{i}", "en", f"s{i % 3}", 2, "", "", "") for i in range(100)], COLUMNS)
    rows = manifest.manifest(docs).select("leaf", "root", manifest.folded("leaf", "path").alias("own"), manifest.folded("root", "path").alias("other")).collect()
    assert len(rows) == 100 and all(r["own"] == r["root"] != r["other"] for r in rows)
