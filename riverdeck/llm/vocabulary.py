"""Vocabulary files of public tokenizers: where they lie is a parameter, never part of this package."""

from __future__ import annotations

import os


def located(vocabulary: str) -> str:
    """A path as it is; a bare file name is looked up in the installed vocabulary package, on
    whichever machine this runs."""
    if os.path.sep in vocabulary:
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)
