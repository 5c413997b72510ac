"""What Python workers, which stay for later stages, hold after a task."""

import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from martflow.llm import common, decontamination, language_id


def own_mb() -> float:
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_a_mapped_task_gives_its_memory_back():
    class Rows:
        def mapInArrow(self, work, schema):
            return work

    def split(batches):
        for batch in batches:
            for _ in range(4):
                words, sizes = decontamination.split_words(batch.column(0))
                yield pa.RecordBatch.from_arrays([pa.array([len(words)])], ["n"])

    texts = pa.array([" ".join(f"w{k}x{n}" for n in range(400)) for k in range(3000)])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    before = own_mb()
    found = [b.column(0)[0].as_py() for b in common.map_batches(Rows(), split, "n long")(iter([batch]))]
    assert found == [1_200_000] * 4
    assert own_mb() - before < 20


def test_rows_of_a_kmeans_are_made_one_by_one():
    texts = [f"text number {k}".encode() * 20 for k in range(1000)]
    tracemalloc.start()
    rows = language_id.unit_vectors(texts, np.ones(language_id.DIMENSIONS, np.float32))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows.dtype == np.float32 and np.allclose(np.linalg.norm(rows, axis=1), 1)
    assert peak < 2.5 * rows.nbytes


def test_items_need_no_workers_of_plain_rows(spark, monkeypatch):
    made = []
    create = type(spark).createDataFrame
    monkeypatch.setattr(
        type(spark), "createDataFrame", lambda self, data, *a, **b: made.append(type(data)) or create(self, data, *a, **b)
    )
    docs = create(spark, [(k, f"some words of document {k} " * 9) for k in range(20)], "doc_id long, text string")
    items = create(spark, [(1, "some words of document 7 " * 6)], "item_id long, text string")
    found = decontamination.find_leaks(docs, items).select("doc_id", F.round("shared", 3).alias("shared")).collect()
    assert (7, 1.0) in {tuple(r) for r in found}
    assert made and set(made) == {pa.Table}
