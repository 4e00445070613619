"""The stages over a small corpus with known content, and the entry's guard."""

import os
import random
import re
import subprocess
import sys
import tempfile
import zlib

import pytest

import corpus_pipeline
from tests.llm.helpers import documents, edit, prose
from tests.llm.test_minhash import brute
from tests.llm.test_pii import plain
from tests.llm.test_quality import junk
from tillflow.llm import graph, minhash, packing, pii, quality, rules, runtime


@pytest.fixture(scope="module")
def sf(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(300):
        good = k % 5 > 0
        text = prose(rng, rng.randint(80, 300)) if good else junk(rng, rng.randint(80, 300))
        if k % 7 == 0:
            text += f" write to name{k}@mail.example.org"
        rows.append((k, text, f"s{k % 3}"))
        labels.append((k, int(good), 0))
    for k in range(300, 330):
        rows.append((k, edit(rng, rows[(k - 300) * 5 + 1][1], 0.004), "s0"))
    rows += [(400, None, "s0"), (401, "", None), (402, "short", "s1")]
    folder = tempfile.mkdtemp(prefix="tillflow-corpus-")
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, dict((a, b) for a, b, _ in labels)


def test_stages(spark, sf):
    folder, rows, truth = sf
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "quality rules", "MinHash near-dedup", "PII", "best-fit packing"]
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        path = os.path.join(tempfile.mkdtemp(prefix="tillflow-stage-"), str(k))
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = before
        if k < 4:
            assert docs.columns == before.columns
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    after_quality = ids(kept["quality rules"])
    wrong = [k for k, good in truth.items() if (k in after_quality) != bool(good)]
    assert len(wrong) <= 6
    entering = [(r.doc_id, r.text) for r in kept["MinHash near-dedup"].collect()]
    classes = brute(entering, size=5)
    assert ids(kept["PII"]) == {c for _, c in classes.values()}
    before, after = kept["PII"], kept["best-fit packing"]
    assert ids(before) == ids(after)
    assert any(plain(r.text) for r in before.collect()) and not any(plain(r.text) for r in after.collect())
    assert ids(docs) == ids(after)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, whole.select("doc_id", "piece", "ids_crc32").collect())) == sorted(
        map(tuple, docs.select("doc_id", "piece", "ids_crc32").collect()))


def test_quality_stage_learns_from_every_labelled_row(spark, sf, monkeypatch):
    folder, _, truth = sf
    seen, slope = [], quality._slope
    monkeypatch.setattr(quality, "_slope", lambda pairs, *a: (seen.append(pairs.count()), slope(pairs, *a))[1])
    labels = quality.Ranking(sample_docs=2)
    model = quality.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"), quality.not_held_out(), labels)
    learnt = [good for k, good in truth.items() if zlib.crc32(str(k).encode()) % 4 != 2]
    assert set(seen) == {max(sum(learnt), len(learnt) - sum(learnt)) * labels.pairs_per_doc} and model.weight.any()
    seen.clear()
    corpus_pipeline.quality_stage(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert len(set(seen)) == 1


def test_near_dup_parameters():
    assert minhash.NearDup(words=5).least_agreement < 0.8 * 128


def test_entry_imports_without_the_package():
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('tillflow.llm'):\n"
            "            raise ModuleNotFoundError('gone', name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert not any(q.startswith('op') or q == 'pipeline' for q in e.queries()) and len(e.queries()) > 50\n")
    root = os.path.dirname(corpus_pipeline.__file__)
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def python_functions_per_stage(df):
    """The most Python functions that one stage of the plan runs one after the other: each holds a worker for each task."""
    above, most = [], 0
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        found = re.match(r"[ :]*(?:[+:]- )?(?:\*\(\d+\) )?(\w+)", line)
        if not found:
            continue
        depth, node = len(re.match(r"[ :]*(?:[+:]- )?", line)[0]), found[1]
        above = [x for x in above if x[0] < depth]
        held = 0 if node.endswith("Exchange") else (above[-1][1] if above else 0) + bool(re.search("Arrow|Pandas|Python", node))
        above.append((depth, held))
        most = max(most, held)
    return most


def test_no_stage_holds_two_python_workers_per_task(spark, sf, monkeypatch):
    folder, _, _ = sf
    written, write = [], runtime.scratch_table

    def noted(df, name):
        written.append((name, python_functions_per_stage(df)))
        return write(df, name)

    for module in (corpus_pipeline, graph, minhash, packing, pii, quality, rules):
        monkeypatch.setattr(module, "scratch_table", noted)
    last = corpus_pipeline.run(spark, folder)
    written.append(("result", python_functions_per_stage(last)))
    assert {"quality-rows", "quality-classifier", "quality-rules", "profile", "holders", "sketch", "entities", "PII", "pieces"} <= {n for n, _ in written}
    assert max(n for _, n in written) == 1, written
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    same = lambda batches: batches
    assert python_functions_per_stage(docs.mapInArrow(same, docs.schema).filter("n_chars > 1").mapInArrow(same, docs.schema)) == 2
