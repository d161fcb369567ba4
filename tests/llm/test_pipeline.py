"""The pipeline's stages, each against its own definition on its own input."""

from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm.common import stored
from ledgerline.llm.langid import language_id
from ledgerline.llm.queries import PIECE_BPE, tokenizer_path
from ledgerline.llm.secret_scan import redact
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_jaccard import brute as grouped

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import sentencepiece
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["language", "near_copies", "decontaminate", "secrets", "encode"]
    for name, stage in corpus_pipeline.STAGES:
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        out = stored(stage(spark, docs, SF), "test-stage")
        ids = sorted(r.doc_id for r in out.select("doc_id").collect())
        if stage.__name__ == "language":
            assert ids == sorted(r.doc_id for r in language_id(docs).where(~F.col("rejected")).collect())
        elif stage.__name__ == "near_copies":
            assert ids == sorted(i for i, (c, _) in grouped(rows).items() if i == c)
        elif stage.__name__ == "decontaminate":
            judged = contaminated(rows, items)
            assert ids == sorted(i for i, _ in rows if not judged[i][-1]) and len(ids) < len(rows)
        elif stage.__name__ == "secrets":
            assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {i: (redact(t), len(redact(t))) for i, t in rows}
        else:
            sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_BPE))
            assert {r.doc_id: r.n_tokens for r in out.collect()} == {i: len(sp.encode(t)) + 2 for i, t in rows}
            break
        assert out.columns == columns
        docs = out
