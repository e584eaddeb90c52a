"""Very long runs of one kind of character are encoded as the library does it."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loglens.llm import packing


@pytest.mark.parametrize("character", [" ", "\n", "　", "a", "7", "-", "é", "中"])
def test_long_run(character):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    encode = packing.load_encoder(path, False)
    n = 1_000_000 if character.isspace() else 50_000
    for text in (character * n, "x" + character * n + "<|endoftext|> y  z"):
        assert encode(text) == library.encode(text, add_special_tokens=False).ids
