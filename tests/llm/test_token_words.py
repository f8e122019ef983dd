"""The word memo of op5: one entry a word, whatever closes it."""

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from quarry.llm import token_files


def test_forms_of_a_word_share_one_entry():
    path = P.path(token_files.VOCABULARY)
    own, tok = token_files.WordIds(path), Tokenizer.from_file(path)
    text = "Wordley, wordley!! WORDLEY*** Éoux&&& éoux. wordley's &&& <|endoftext|>, it's.'s don'T.. \x7f."
    assert np.frombuffer(own.encode([text])[0], np.uint16).tolist() == tok.encode(text, add_special_tokens=False).ids
    assert sorted(k for k in own if "ordl" in k.lower() or "oux" in k.lower()) == ["wordley", "wordley's", "éoux"]
    assert "&&&" in own and len(own) < 16


def test_texts_without_ids():
    own = token_files.WordIds(P.path(token_files.VOCABULARY))
    for texts in ([], [""], ["", " \n "]):
        assert own.encode(texts) == [b""] * len(texts)
