"""The pipeline, stage by stage, and the entry without this folder's operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline as pipeline
from airloom.llm import exact, languages, mixing, neardup, packing
from airloom.llm.common import Written

from .conftest import CLASHING, SF_DIR

ROOT = Path(__file__).resolve().parents[2]


def test_each_stage_decides_on_its_own_input(spark, documents):
    folder, docs = Written(spark, "test"), documents
    for name, stage in pipeline.STAGES:
        out = folder.keep(stage(spark, docs, SF_DIR))
        if name != "packing":
            assert out.columns == documents.columns
        before, after = ({r.doc_id for r in x.select("doc_id").collect()} for x in (docs, out))
        if name == "language ID":
            said = {r.doc_id for r in languages.predict(docs, languages.train(docs)).where("lang_pred != 'und'").collect()}
            assert after == said
        elif name == "exact dedup":
            assert after == {r.doc_id for r in exact.exact_groups(docs).where("kept").collect()}
        elif name == "near dedup":
            assert after == {r.doc_id for r in neardup.near_duplicates(docs, percent=80).where("kept").collect()}
            again = neardup.near_duplicates(out, percent=80)
            assert again.where("not kept").count() == 0
        elif name == "mixing":
            assert after == {r.doc_id for r in mixing.mix_report(docs).where("taken > 0").collect()}
        else:
            assert after == before
            lengths = packing.pieces(docs, pipeline.public_tokenizers.path(pipeline.TOKENIZER)).agg({"length": "sum"}).first()[0]
            assert out.agg({"length": "sum"}).first()[0] == lengths
        docs = out


def test_stages_on_awkward_and_empty_rows(spark, awkward, no_docs):
    for docs in (awkward, no_docs):
        folder = Written(spark, "test")
        for name, stage in pipeline.STAGES:
            out = folder.keep(stage(spark, docs, SF_DIR))
            if name != "packing":
                # Columns of any name pass through with their values, each its own name here.
                assert out.columns == docs.columns and out.schema == docs.schema
                assert out.select(*CLASHING).distinct().collect() in ([CLASHING], [])
                assert out.count() > 0 or docs.count() == 0
            docs = out


def test_rows_without_id_stay_once(spark, make_docs):
    """Clean texts without doc_id are not lost; of equal or near ones one stays."""
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(None, a, "en", "s"), (None, a + " ", "en", "s"), (None, a + " more", "en", "s"), (None, b, "en", None), (1, b + " more", "en", "s")]
    docs = make_docs(rows)
    unique = exact.keep_one_of_each(docs)
    assert sorted(r.text for r in unique.collect()) == sorted([a + " ", a + " more", b, b + " more"])
    near = [(r.doc_id, r.text) for r in neardup.keep_one_of_each(unique, percent=80).collect()]
    assert len(near) == 2 and (1, b + " more") in near
    mixed = mixing.mixed_documents(docs)
    taken = sum(len((r.text or "").split()) for r in mixed.collect())
    assert taken == sum(r.taken for r in mixing.mix_report(docs).collect())


def test_entry_without_this_folder(tmp_path):
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "corpus_pipeline.py")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True)
