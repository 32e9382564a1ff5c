"""The pipeline, stage by stage, against brute force on each stage's own input."""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa

import corpus_pipeline
from corpus_pipeline import COLUMNS, STAGES, run
from tests.conftest import CHECK_FOLDER
from tests.llm.helpers import awkward
from tests.llm.test_line_dedup import brute as lines_of
from tests.llm.test_mixing import targets
from tests.llm.test_simhash import single as one_of_each
from tests.llm.test_tokens import packed
from tidewatch.llm.common import BATCH_BYTES, table
from tidewatch.llm.mixing import WORD
from tidewatch.llm.toxicity import train
import re


def stages(spark, docs, folder, tmp_path):
    out = [docs]
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, out[-1], folder).write.parquet(str(tmp_path / str(k)))
        out.append(spark.read.parquet(str(tmp_path / str(k))))
    return out


def size_of(batch):
    return pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages(spark, tmp_path):
    docs = table(spark, CHECK_FOLDER, "documents")
    start, clean, deduped, single, mixed, pieces = stages(spark, docs, CHECK_FOLDER, tmp_path)
    for df in (clean, deduped, single, mixed):
        assert df.columns == COLUMNS

    model = train(docs, table(spark, CHECK_FOLDER, "labels"))
    assert sorted(pairs(clean)) == sorted((i, t) for i, t in pairs(start) if model.score(t) < 0.7)
    toxic = {r["doc_id"] for r in table(spark, CHECK_FOLDER, "labels").where("toxic = 1").collect()}
    left = {i for i, _ in pairs(clean)}
    assert len(toxic - left) > 0.5 * len(toxic)  # learned from 34 toxic documents here
    assert start.count() - clean.count() < 0.2 * start.count()

    assert sorted(pairs(deduped)) == sorted((i, t) for i, _, _, t in lines_of(pairs(clean)))
    assert all(r["n_chars"] == len(r["text"]) for r in deduped.collect())

    assert sorted(i for i, _ in pairs(single)) == one_of_each(pairs(deduped))

    words = lambda t: len(re.findall(WORD, t or ""))
    before, after, taken = Counter(), Counter(), defaultdict(int)
    sizes = {r["doc_id"]: words(r["text"]) for r in single.collect()}
    for r in single.collect():
        before[r["source"]] += sizes[r["doc_id"]]
    for r in mixed.collect():
        after[r["source"]] += words(r["text"])
        taken[r["doc_id"]] += words(r["text"])
    assert all(n <= 2 * sizes[i] for i, n in taken.items())
    for source, target in targets(before).items():
        assert abs(after[source] - target) < 0.01 * float(target) + 32

    assert packed(pieces.collect(), pairs(mixed), 4096, 2) == 0
    again = run(spark, CHECK_FOLDER)
    assert sorted(map(tuple, again.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        map(tuple, pieces.select("doc_id", "start", "length", "ids_crc32").collect())
    )


def test_texts_reach_python_in_small_batches(spark):
    docs = spark.range(0, 6000, 1, 1).selectExpr(
        "id AS doc_id", "repeat(concat('w', id, ' '), 1000) AS text", "'en' AS lang", "'s' AS source", "6000L AS n_chars"
    )
    for stage in (corpus_pipeline.drop_near_copies, corpus_pipeline.pack):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage(spark, docs.limit(1), CHECK_FOLDER)
        sizes = docs.select("text").mapInArrow(lambda bs: (size_of(b) for b in bs), "size long").collect()
        assert len(sizes) > 1 and max(r["size"] for r in sizes) < 2 * BATCH_BYTES


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    stages(spark, docs, CHECK_FOLDER, tmp_path)
    single = corpus_pipeline.drop_near_copies(spark, docs, CHECK_FOLDER)
    assert sorted((r["doc_id"] or 0) for r in single.collect()) == [0, 1, 2, 4, 6]
    empty = docs.where("doc_id > 100")
    for _, stage in STAGES:
        assert stage(spark, empty, CHECK_FOLDER).collect() == []
