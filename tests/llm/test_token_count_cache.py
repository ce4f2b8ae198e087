"""Token counts when the words needed outgrow the cache."""

from __future__ import annotations

import pytest

from fareway.llm import token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_words_outlive_a_full_cache(monkeypatch):
    import sentencepiece

    monkeypatch.setattr(token_counts, "_REMEMBERED", 6)
    file = public_tokenizers.path("piece_bpe_32k.model")
    model, merger = sentencepiece.SentencePieceProcessor(model_file=file), token_counts.PieceMerger(file)
    for some in (["a b c"], ["a " + " ".join(f"w{i}" for i in range(10))], ["b w3", "c new", "a w1 w2 other words here"]):
        assert merger.count(some) == [len(x) for x in model.encode(some)]
