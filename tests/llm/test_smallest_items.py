"""Benchmark items of few words in many documents."""

from __future__ import annotations

from fareway.llm import decontaminate


def test_smallest_items_are_found_in_every_document(spark):
    items, rows = [], []
    for d in range(1500):
        item = " ".join(f"i{d}x{i}" for i in range(5 + d % 4))
        words = [f"w{d}x{i}" for i in range(40)]
        items.append((d, item))
        rows.append((d, " ".join([item, *words] if d % 3 else [*words[:17], item, *words[17:]])))
    docs, bench = (spark.createDataFrame(x, f"{name} long, text string") for x, name in ((rows, "doc_id"), (items, "item_id")))
    found = decontaminate.contained_items(docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(d, d) for d in range(1500)]
    assert decontaminate.contained_items(docs, bench.filter("item_id = 8")).count() == 1
    assert decontaminate.without_contaminated(docs, bench).count() == 0
