"""op3: pieces get their numbers in the pass that looks them up."""

import random

import numpy as np

from labelkiln.llm import token_files
from labelkiln.llm.queries import _tokenizer


def test_pieces_are_looked_up_once(monkeypatch):
    """New pieces get their number in the pass that looks them up, also after pieces were given up."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "KNOWN", 40)
    tok, enc = Tokenizer.from_file(_tokenizer()), token_files.Encoder(_tokenizer())
    asked = []

    class Counting(type(enc.known)):
        def __getitem__(self, piece):
            asked.append(piece)
            return super().__getitem__(piece)

        def get(self, piece, other=None):
            asked.append(piece)
            return super().get(piece, other)

    enc.known = Counting([])
    text = "one two  three\nfour one two <|endoftext|> \t"
    assert np.frombuffer(enc([text])[0], "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
    assert len(asked) == len(token_files._PIECES.findall(text))
    rnd = random.Random(2)
    for _ in range(30):
        texts = [" ".join(f"w{rnd.randint(0, 60)}" for _ in range(12)) for _ in range(3)] + [""]
        for t, got in zip(texts, enc(texts), strict=True):
            assert np.frombuffer(got, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids
        assert len(enc.known) <= 40 + 36
