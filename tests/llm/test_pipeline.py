"""Each stage of the pipeline on what its predecessor kept, against a brute-force version."""

import corpus_pipeline
import public_tokenizers
from fleetlake.llm import toxicity
from fleetlake.llm.common import stored
from tests.llm import brute
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    model = toxicity.train(source, spark.read.parquet(f"{SF}/labels.parquet"))
    docs = source
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stored(stage(spark, docs, SF), "stage")
        rows = docs.collect()
        if name == "packing":
            brute.check_packing(rows, {i: r.text for i, r in before.items()}, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
            continue
        assert docs.columns == source.columns
        after = {r.doc_id: r for r in rows}
        assert len(after) == len(rows)
        texts = [(i, r.text) for i, r in before.items()]
        if name == "toxicity":
            scorer = model.scorer()
            scores = {i: toxicity.probability([scorer(w) for w in toxicity.sentence_words(t.encode())]) for i, t in texts}
            expected = {i: t for i, t in texts if scores[i] < 0.3}
        elif name == "line dedup":
            expected = {i: t for i, t in brute.without_repeats(texts).items() if t or not before[i].text}
        elif name == "near dedup":
            classes = brute.near_classes(texts, 80)
            expected = {i: t for i, t in texts if classes[i] == i}
        else:
            expected = {i: t for i, t in texts if not brute.contamination(t, items)[1]}
        assert {i: r.text for i, r in after.items()} == expected
        assert all(r.n_chars == len(r.text) for r in rows)
        assert all((r.lang, r.source) == (before[i].lang, before[i].source) for i, r in after.items())
