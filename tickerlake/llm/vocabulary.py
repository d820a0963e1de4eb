"""Where the installed public tokenizer files are."""

from __future__ import annotations


def piece_model(name: str = "piece_bpe_32k.model") -> str:
    """Path of the SentencePiece model; the file is read in place on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)
