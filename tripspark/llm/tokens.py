"""Byte-level BPE encoding with a public vocabulary file, on the executors.

The file's path is a parameter; every executor must be able to open it (it is
installed software, not data). Encoders are kept per worker process.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import tiktoken

#: Ranks of a byte-level BPE with 50,256 ids; id 50256 is free and ends a document.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_ID = 50256
#: Fixed value: how that vocabulary cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs of white space from which the look-ahead would nest too deeply.
_LONG_RUN = 5_000
_RUNS = re.compile("[\t-\r \x85\xa0  -     　]{%d,}" % _LONG_RUN)


@lru_cache(maxsize=4)
def _encoders(path: str) -> tuple[tiktoken.Encoding, tiktoken.Encoding]:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return (tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}),
            tiktoken.Encoding(path + " whole", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}))


def encode(text: str | None, path: str = VOCABULARY) -> np.ndarray:
    """Token ids of the whole text (none for NULL or empty).

    A very long run of white space is encoded by itself, at the cuts that the
    pattern makes too: before the run, and before its last character if text follows."""
    plain, whole = _encoders(path)
    if not text:
        return np.empty(0, np.int64)
    if len(text) < _LONG_RUN or not _RUNS.search(text):
        return np.array(plain.encode_ordinary(text), np.int64)
    ids, at = [], 0
    for run in _RUNS.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        if at < run.start():
            ids += plain.encode_ordinary(text[at:run.start()])
        ids += whole.encode_ordinary(text[run.start():stop])
        at = stop
    return np.array(ids + plain.encode_ordinary(text[at:]), np.int64)


def decode(ids, path: str = VOCABULARY) -> str:
    return _encoders(path)[0].decode([int(i) for i in ids])
