"""Encoders over public vocabulary files; nothing is trained here."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import tiktoken

#: Rank file of a byte-level vocabulary: a base64 string and its rank in each line.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how this vocabulary's texts are cut before merging.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The cut backs up over a run of blanks, which fails in runs of about a million. Runs from this length on are
#: cut out beforehand. The blanks are those of Unicode's white space, as in the cut.
LONG_RUN = 100_000
_LONG_RUNS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


@lru_cache(maxsize=2)
def encoder(path: str = RANKS) -> tiktoken.Encoding:
    """The encoder of a rank file, one per Python worker. Special tokens' names are ordinary text."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})


def ids_of(text: str, path: str = RANKS) -> np.ndarray:
    """The ids of a text, runs of blanks of any length included.

    Of a run before a word the cut leaves the last blank to the word and takes the rest as one piece; a
    run that ends the text is one piece. The same is done here, so the ids are the same.
    """
    encode = encoder(path).encode_to_numpy
    if len(text) < LONG_RUN:
        return encode(text, disallowed_special=())
    found, at = [], 0
    for run in _LONG_RUNS.finditer(text):
        end = run.end() - (run.end() < len(text))
        found.append(encode(text[at : run.start()], disallowed_special=()))
        found.append(np.array(encoder(path)._encode_single_piece(text[run.start() : end]), found[0].dtype))
        at = end
    return np.concatenate([*found, encode(text[at:], disallowed_special=())])
