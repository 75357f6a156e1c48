import corpus_pipeline
from stridewatch.llm import quality
from stridewatch.llm.queries import END_ID

from .test_dedup import brute_classes, squeezed
from .test_filters import plain_contamination
from .test_tokens import WORD, check_packing


def test_stages_equal_plain_python(spark):
    """Every stage on the smallest tables, each held against a plain version of its own input."""
    from tokenizers import Tokenizer

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before = [(r.doc_id, r.text) for r in docs.collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, sf_dir), "test-stage")
        if name == "packing":
            plain = Tokenizer.from_file(WORD)
            want = [(i, plain.encode(t or "", add_special_tokens=False).ids + [END_ID]) for i, t in before]
            check_packing(docs.collect(), want, 2048)
            break
        assert docs.columns == columns
        after = [(r.doc_id, r.text) for r in docs.collect()]
        assert set(after) <= set(before) and len(after) == len(set(after))
        if name == "quality":
            truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
            kept = {i for i, _ in after}
            known = [i for i, _ in before if i in truth]
            assert sum((i in kept) == bool(truth[i]) for i in known) >= 0.9 * len(known)
        elif name == "exact_dedup":
            best = {}
            for i, t in before:
                best[squeezed(t)] = min(best.get(squeezed(t), (0, i)), (-len(t or ""), i))
            assert {i for i, _ in after} == {i for _, i in best.values()}
        elif name == "near_dedup":
            from stridewatch.llm import near_dedup

            frame = spark.createDataFrame(before, "doc_id long, text string")
            idf = near_dedup.idf_table(*near_dedup.document_frequencies(frame, 5))
            classes = brute_classes(sorted(before), idf)
            assert {i for i, _ in after} == {i for i, c in classes.items() if i == c}
        elif name == "decontamination":
            clean = {r[0] for r in plain_contamination(before, items, 10) if not r[5]}
            assert {i for i, _ in after} == clean
        before = after
    assert quality.MOST_ROWS and len(before) > 50


def test_empty_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, "/root/testdata/sf0.001"), "test-empty")
    assert docs.count() == 0
