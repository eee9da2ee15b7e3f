"""The memo of token ids gives what the tokenizer gives, and a group's new runs are learnt in one call."""

import numpy as np

from tessera.llm import packing as P

TEXTS = ["Word word, WORD! Éa éA. (389) ...", "...", "word... a\u001cb ½ été, ÉTÉ;", None, "", " \n", "spddh.31@mail6.example.com word", "ß SS ß!"] * 3


def test_ids_are_the_tokenizers_in_any_generation():
    for hold in (0, 3, 400_000):
        enc = P.Encoder(P.default_tokenizer(), hold)
        for texts in (TEXTS, TEXTS[::-1]):
            want = [np.array([*enc.tok.encode(t or "", add_special_tokens=False).ids, P.END], "<u4").tobytes() for t in texts]
            assert [*enc(texts)] == want
