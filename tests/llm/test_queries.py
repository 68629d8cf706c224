"""The registered queries: columns, SQL oracles, the pipeline."""

import os
import shutil
import subprocess
import sys

import pytest
from oracle_compare import compare

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COLUMNS = {
    "op1_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op2_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op3_mixing": "doc_id size source_size target taken", "op4_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op5_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op6_language_id": "doc_id held_out lang_pred score",
    "op7_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256", "op9_toxicity": "doc_id held_out score predicted",
    "op10_ngram_join": "doc_id n_shingles component_id",
    "op11_sentencepiece": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op13_fill_in_middle": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
}


def test_oracles_match(spark):
    from ledgerlens.llm import registry
    assert compare(spark, SF, sorted(registry.oracle_sql())) == []


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns_and_one_row_a_document(spark, name):
    from __spark_entry__ import queries
    df = queries()[name](spark, SF)
    assert df.columns[:len(COLUMNS[name].split())] == COLUMNS[name].split()
    assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_whitening_has_a_row_a_vector_and_component(spark):
    from __spark_entry__ import queries
    df = queries()["op12_whitening"](spark, SF)
    assert df.columns == "vec_id component n deviation whitened explained identity_error".split()
    assert df.count() == 16 * spark.read.parquet(f"{SF}/embeddings.parquet").count()


def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline
    import public_tokenizers
    from ledgerlens.llm import byte_bpe, toxicity
    from test_documents import jaccard_groups, normal

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = f"{spark.sparkContext.getCheckpointDir()}/stage-{name}-{os.getpid()}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    scores = {r.doc_id: r.predicted for r in toxicity.toxicity(
        spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    kept = {r.doc_id for r in seen["toxicity"].collect()}
    assert kept == {i for i in given if not scores[i]}
    best = {}
    for i in sorted(kept):
        h = normal(given[i])
        if h not in best or len(given[i]) > len(given[best[h]]):
            best[h] = i
    assert {r.doc_id for r in seen["exact_dedup"].collect()} == set(best.values())
    groups = jaccard_groups([(i, given[i]) for i in sorted(best.values())])
    leads = {int(i) for i, _, c in groups if i == c}
    assert {r.doc_id for r in seen["ngram_join"].collect()} == leads
    mixed = [r.doc_id for r in seen["source_mixing"].collect()]
    assert set(mixed) <= leads and max(map(mixed.count, mixed)) <= 2
    codec = byte_bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    tokens = seen["byte_bpe"].collect()
    assert sorted(r.doc_id for r in tokens) == sorted(mixed)
    assert all(b"".join(codec.vocabulary[i] for i in r.token_ids).decode() == given[r.doc_id] for r in tokens)


def test_run_gives_the_last_stage(spark):
    from __spark_entry__ import queries
    rows = queries()["pipeline"](spark, SF)
    assert rows.columns == ["doc_id", "source", "token_ids", "n_tokens", "ids_sha256", "decoded_sha256"] and rows.count() > 0


def test_entry_imports_without_the_subpackage(tmp_path):
    """A copy of the working tree without both llm folders and the pipeline
    still imports and has the other queries; a broken import raises."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: [
        n for n in names if n in (".git", "__pycache__", "llm", "corpus_pipeline.py", ".pytest_cache", ".hypothesis")])
    env = {**os.environ, "PYTHONPATH": str(copy)}
    code = "import __spark_entry__ as e; assert len(e.queries()) > 60 and not any(k.startswith('op') for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env=env)
    broken = copy / "ledgerlens" / "llm"
    broken.mkdir()
    (broken / "__init__.py").touch()
    (broken / "registry.py").write_text("import no_such_module\n")
    assert subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True).returncode != 0
