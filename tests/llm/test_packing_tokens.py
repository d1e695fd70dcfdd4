"""Operator 7 as registered, and the pipeline's stage: ids of the tokenizer file's plain call."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from wattline.llm.queries import op7_best_fit_packing

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|>  y\n<|endoftext|><|endoftext|>\n \n", "<|endoftext|", None,
         "<|endof<|endoftext|>text|>", "<|ENDOFTEXT|> don<|endoftext|>'t 12<|endoftext|>34", "é<|endoftext|>文 ", "",
         "word<|endoftext|>" * 900]


@pytest.mark.parametrize("of", ["query", "pipeline"])
def test_ids_of_the_plain_call(spark, tmp_path, of):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = (op7_best_fit_packing(spark, str(tmp_path)) if of == "query"
           else corpus_pipeline.packing_stage(spark, docs, str(tmp_path))).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokenizer.encode(TEXTS[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    want = []
    for doc, text in enumerate(TEXTS):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)]
        want += [(doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(tuple(r)[:5] for r in got) == want
