from __future__ import annotations

import random
import zlib

import pytest

from tests.llm.helpers import awkward, documents, empty
from tidewatch.llm.common import table
from tidewatch.llm.queries import LLM_QUERIES
from tidewatch.llm import toxicity
from tidewatch.llm.toxicity import Model, fit, score_toxicity, train, windows


def test_windows_hold_the_whole_text():
    rng = random.Random(1)
    for n in (0, 1, 5, 500):
        words = ["é" * rng.randint(1, 90) for _ in range(n)]
        assert b"".join(windows("\n ".join(words))) == b" " + " ".join(words).encode()
    assert windows(None) == windows("") == [b" "]


def auc(rows):
    good = [s for s, y in rows if y == 1]
    bad = [s for s, y in rows if y == 0]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.1"])
def test_held_out_labels(spark, folder):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, folder, "labels").collect()}
    rows = LLM_QUERIES["op6_toxicity"](spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert auc(held) > 0.9
    said = [y for s, y in held if s >= 0.7]
    assert sum(said) / len(said) > 0.9
    assert sum(said) > 0.75 * sum(y for _, y in held)


def test_held_out_labels_are_not_learned(spark):
    docs = documents(spark, [f"some text {i} " + ("vile scoundrel" if i % 4 == 0 else "fine day") for i in range(300)])
    labels = [(i, 1, int(i % 4 == 0)) for i in range(300)]
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    models = [train(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, turned)]
    assert models[0] == models[1]
    assert models[0].score("that vile scoundrel again") > 0.7 > models[0].score("some other text on a fine day")


def test_awkward_rows(spark):
    few = spark.createDataFrame([(1, 1, 0), (None, None, 1), (2, None, None), (1, 0, 1)], "doc_id long, quality int, toxic int")
    model = train(awkward(spark), few)
    rows = score_toxicity(awkward(spark), model)
    assert rows.columns == [*awkward(spark).columns, "score"]
    assert all(0 <= r["score"] <= 1 for r in rows.collect())
    assert score_toxicity(empty(spark), model).collect() == []
    assert train(empty(spark), few.limit(0)).score("x") == 0.25
    assert isinstance(fit([]), Model)


def test_a_sample_that_caps_one_class_keeps_the_shares(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = train(docs, labels, sample_rows=305)  # all of the toxic ones, an eighth of the others
    held = labels.where("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1").select("doc_id", "toxic")
    rows = score_toxicity(docs.join(held, "doc_id"), model).select("score", "toxic").collect()
    said = [r["toxic"] for r in rows if r["score"] >= 0.7]
    assert sum(said) > 0.6 * len(said)  # 0.4 if toxic and others count alike
    assert sum(said) > 0.6 * sum(r["toxic"] for r in rows)


def test_the_sample_of_a_class_is_bounded_in_characters(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda rows, totals: seen.append((rows, totals)))
    texts = {i: "word " * (1 + i % 40) for i in range(600)}
    docs = documents(spark, list(texts.values()))
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in texts], "doc_id long, quality int, toxic int")
    for total in (0, 2000, 10**9):
        train(docs, labels, sample_total=total)
    learnable = {kind: [i for i in texts if int(i % 3 == 0) == kind and zlib.crc32(str(i).encode()) % 3 != 1] for kind in (0, 1)}
    for (rows, totals), total in zip(seen, (0, 2000, 10**9)):
        assert totals == {kind: len(ids) for kind, ids in learnable.items()}
        for kind, ids in learnable.items():
            chars = sum(len(text) for _, text, toxic in rows if toxic == kind)
            assert chars <= total and chars >= min(total, sum(len(texts[i]) for i in ids)) - 200
