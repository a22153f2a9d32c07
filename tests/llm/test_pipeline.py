"""Every pipeline stage against brute force on what the stage before kept, and the entry's guard."""

import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from tests.llm.test_decontamination import brute as windows_hit
from tests.llm.test_set_join import brute as components_of
from tests.llm.test_spans import PERSONAL
from tests.llm.test_tokens import ids
from verdant.llm import packing, quality, queries

ROOT = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents that went into each stage, and what came out of the last."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(docs)
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*out, docs]


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def redacted(text):
    spans = sorted((m.start(), m.end(), k) for k, (p, ok) in PERSONAL.items() for m in re.finditer(p, text) if ok(m))
    out, at = "", 0
    runs = []
    for s, e, k in spans:
        if runs and s < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([s, e, k])
    for s, e, k in runs:
        out, at = f"{out}{text[at:s]}[{k}]", e
    return out + text[at:]


def test_columns_pass_through(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_quality_stage(spark, stages):
    scores = {r.doc_id: r.score for r in quality.score(stages[0], queries.quality_model(spark, SF)).collect()}
    assert set(texts(stages[1])) == {i for i, s in scores.items() if s >= quality.THRESHOLD}
    assert 0.5 < len(texts(stages[1])) / len(scores) < 1


def test_near_copies_stage(stages):
    found = components_of(texts(stages[1]).items(), n=5, percent=80)
    assert set(texts(stages[2])) == {i for i, (_, least) in found.items() if least == i}


def test_decontamination_stage(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = windows_hit(texts(stages[2]).items(), items)
    assert texts(stages[3]) == {i: t for i, t in texts(stages[2]).items() if not hit[i][4]}


def test_personal_data_stage(stages):
    before, after = texts(stages[3]), {r.doc_id: r for r in stages[4].collect()}
    assert set(after) == set(before)
    assert {i: r.text for i, r in after.items()} == {i: redacted(t) for i, t in before.items()}
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_packing_stage(stages):
    pieces = {}
    for r in stages[5].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, list(r.ids)))
    expected = {i: [*ids(t), packing.END_ID] for i, t in texts(stages[4]).items()}
    assert {i: sum((x for _, x in sorted(p)), []) for i, p in pieces.items()} == expected


def test_run_equals_the_stages(spark, stages):
    columns = ("doc_id", "start", "length")
    assert sorted(corpus_pipeline.run(spark, SF).select(*columns).collect()) == sorted(stages[5].select(*columns).collect())


def test_queries_without_the_subpackage(tmp_path):
    """The entry still imports, and keeps its other queries, where the subpackage and the pipeline are gone."""
    for name in ("verdant", "__spark_entry__.py"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'window_metrics' in q and not any(k.startswith('op') for k in q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert len(queries.queries()) == 14


def test_near_copies_between_the_thresholds(spark):
    """Appended words and scattered edits that leave 5-word shingles at 0.80 or more, but 4-word ones below 0.85."""
    words = [f"w{i}" for i in range(1000)]
    edited = [f"e{i}" if i % 46 == 23 else w for i, w in enumerate(words)]  # 22 of 1,000 words
    far = [f"e{i}" if i % 30 == 15 else w for i, w in enumerate(f"v{i}" for i in range(1000))]
    texts = [words, [*words, *(f"x{i}" for i in range(200))], edited, [f"v{i}" for i in range(1000)], far]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.keep_one_of_each_group(spark, docs, SF).collect()) == [0, 3, 4]
