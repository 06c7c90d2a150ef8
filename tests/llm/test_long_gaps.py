"""Very long runs of one character through the packing encoder."""

from array import array

import pytest

from scholia.llm import packing


@pytest.mark.parametrize("gap", list(" \t\n\x0b\x0c\r"))
def test_long_white_space_codes_as_the_tokenizer_does(gap):
    encoder = packing.encoder_for(packing.tokenizer_path(), packing.tokenizer_path(packing.RANKS))
    for n in (4_999, 5_000, 1_200_000):
        text = f"a{gap * n}x"
        ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == array("I", ids).tobytes()


def test_three_million_spaces_pack(spark):
    docs = spark.createDataFrame([(1, " " * 3_000_000 + "x"), (2, "a b")], "doc_id long, text string")
    rows = packing.pack_documents(docs).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 3_000_001
