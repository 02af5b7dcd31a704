"""Windows of a benchmark that takes several automata."""

from __future__ import annotations

from tarnbrook.llm import contamination


def tables(spark):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(40)] + [(50, "Short item"), (51, ""), (52, None), (None, "lost words")]
    passage = " ".join(f"W{7}x{k}" for k in range(3, 17))
    docs = [(1, f"Start, {passage}! end"), (2, "a short ITEM here"), (3, None), (4, ""), (None, "short item"), (5, "lost words"), (5, "lost words"), (6, "clean " * 5000)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")


def result(docs, benchmark):
    return sorted(map(str, contamination.find_contamination(docs, benchmark).collect()))


def test_several_automata_give_the_rows_of_one(spark, monkeypatch):
    docs, benchmark = tables(spark)
    one = result(docs, benchmark)
    assert len(contamination.broadcast_windows(benchmark)) == 1
    whole = {str(r["doc_id"]): (r["n_hit"], r["items"]) for r in contamination.find_contamination(docs, benchmark).collect()}
    assert whole == {"1": (14, [7]), "2": (2, [50]), "3": (0, []), "4": (0, []), "None": (2, [50]), "5": (0, []), "6": (0, [])}
    parts = contamination.broadcast_windows(benchmark, limit=2000)
    assert len(parts) > 3 and sum(len(p.value) for p in parts) == len(contamination.broadcast_windows(benchmark)[0].value)
    monkeypatch.setattr(contamination, "broadcast_windows", lambda *_: parts)
    for held in (1, 1 << 20):
        monkeypatch.setattr(contamination, "HELD_BYTES", held)
        assert result(docs, benchmark) == one


def test_empty_tables(spark):
    docs, benchmark = tables(spark)
    assert contamination.contamination_report(docs.limit(0), benchmark).count() == 0
    assert not contamination.contamination_report(docs, benchmark.limit(0)).where("contaminated or n_items > 0").count()
    assert contamination.keep_clean(docs, benchmark.limit(0)).count() == docs.count()


def test_each_automaton_is_built_once_for_the_texts_held(spark):
    docs, benchmark = tables(spark)
    parts = contamination.broadcast_windows(benchmark, limit=2000)
    batches = docs.toArrow().to_batches(max_chunksize=2)
    contamination._automaton.cache_clear()
    out = list(contamination._scanned(iter(batches), parts))
    assert [b.num_rows for b, _ in out] == [len(s) for _, s in out] and len(out) == len(batches) > 2
    assert contamination._automaton.cache_info().misses == len(parts)
