"""The pipeline's stages against plain Python, each on its own input."""
import os

import brute
import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark, tmp_path):
    import sentencepiece

    from trendspark.llm.piece_codec import default_model
    odd = [(10_000, None, "en", "s", 0), (10_001, "", "en", "s", 0), (10_002, "12 !!", None, None, None)]
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(
        spark.createDataFrame(odd, spark.read.parquet(f"{SF}/documents.parquet").schema))
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "n-gram Jaccard join", "suffix-array dedup", "benchmark decontamination", "SentencePiece encoding and decoding"]
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after = {r.doc_id: r for r in docs.collect()}
        pairs = [(d, r.text) for d, r in before.items()]
        if name == "language ID":
            assert set(before) - set(after) == {10_000, 10_001, 10_002}
        elif name == "n-gram Jaccard join":
            assert set(after) == {d for d, _, c in brute.jaccard_components(pairs, 5, 80, 100) if d == c}
            assert len(after) < len(before)
        elif name == "suffix-array dedup":
            for d, _, removed, _, kept in brute.remove_repeats(pairs):
                if d in after and not removed:
                    assert after[d].text == before[d].text
                elif d in after and "�" not in after[d].text:
                    assert brute.sha(after[d].text) == kept and after[d].n_chars == len(after[d].text)
                elif d not in after:
                    assert removed
        elif name == "benchmark decontamination":
            assert set(after) == {r[0] for r in brute.contamination(pairs, bench) if not r[-1]}
            assert len(after) < len(before)
        else:
            library = sentencepiece.SentencePieceProcessor(model_file=default_model())
            assert set(after) == set(before)
            for d, r in after.items():
                ids = library.encode(before[d].text, add_eos=True)
                assert (r.n_tokens, r.ids_sha256) == (len(ids), brute.sha(" ".join(map(str, ids))))
                assert r.decoded_sha256 == brute.sha(library.decode(ids))
        assert docs.columns[:len(columns)] == columns


def test_rest_works_without_the_llm_folders(tmp_path):
    """A copy without the llm folders and the pipeline still imports and lists its queries."""
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') and k[2].isdigit() for k in q), 'pipeline' in q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.stdout.split()[1:] == ["False", "False"], done.stderr
