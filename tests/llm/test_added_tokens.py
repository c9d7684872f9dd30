"""Texts that hold the literal of the vocabulary's added token, against the tokenizers library."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from streamcurate.llm import packing, token_counts

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", "end \n <|endoftext|>\n\n it's", "<|endoftext|", "<<|endoftext|>>", "plain é 漢", None, "word <|endoftext|> " * 700]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)


def test_packing_ids(docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for doc, text in enumerate(TEXTS):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, packing.END]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want += [(doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted(tuple(r)[:5] for r in packing.pack(docs).collect()) == want


def test_token_counts_separator(docs):
    encode = packing.encoder(added=False)
    want = Counter((i, len(encode(t or ""))) for i, t in enumerate(TEXTS))
    assert Counter((r.doc_id, r.n_tokens) for r in token_counts.token_counts(docs).collect()) == want
