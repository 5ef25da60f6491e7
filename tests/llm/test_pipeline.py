"""The corpus pipeline stage by stage, and the optional registration."""

import shutil
import subprocess
import sys
import tempfile
from collections import Counter
from pathlib import Path

import corpus_pipeline
from boreflow.llm import packing, toxicity
from boreflow.llm.common import store, table
from boreflow.llm.queries import QUERIES

from .helpers import empty, near_groups
from .test_dedup import norm

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_every_stage_on_its_own_input(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    seen = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == columns
            out = store(out, "test-stage")
        seen[name] = out.collect()
        docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]

    model = toxicity.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))
    clean = {r.doc_id for r in toxicity.score(table(spark, SF, "documents"), model).collect() if not r.predicted}
    assert {r.doc_id for r in seen["toxicity"]} == clean and len(seen["toxicity"]) == len(clean)

    least = {}
    for r in seen["toxicity"]:
        least[norm(r.text)] = min(r.doc_id, least.get(norm(r.text), r.doc_id))
    assert Counter(r.doc_id for r in seen["exact_dedup"]) == Counter(least.values())

    near = near_groups([(r.doc_id, r.text) for r in seen["exact_dedup"]])
    assert Counter(r.doc_id for r in seen["near_dedup"]) == Counter(i for i, _, c in near.elements() if i == c)

    read = Counter(r.doc_id for r in seen["mixing"])
    assert read.keys() == {r.doc_id for r in seen["near_dedup"]} and set(read.values()) <= {1, 2}

    whole, _ = packing.encoders(None, None)
    tokens = sum(len(whole.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in seen["mixing"])
    assert sum(r.length for r in seen["packing"]) == tokens
    places = Counter()
    for r in seen["packing"]:
        places[r.sequence_id] += r.length
    assert max(places.values()) <= packing.CAPACITY


def test_pipeline_on_an_empty_table(spark):
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_the_rest_imports_without_this_part():
    there = tempfile.mkdtemp(prefix="boreflow-rest-")
    rest = shutil.copytree(ROOT, f"{there}/repo", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'fact_production' in q and 'pipeline' not in q and not any(n.startswith('op1') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=rest, check=True, timeout=120)
