"""Where the public tokenizers' files lie. The files stay where they are installed."""

from __future__ import annotations


def vocabulary(name: str) -> str:
    """Path of an installed vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
