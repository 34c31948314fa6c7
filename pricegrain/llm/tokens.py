"""Operator 9: token counts by heap-and-linked-list byte-pair merging."""

from __future__ import annotations

import heapq
import json

import regex
from pyspark.sql import DataFrame

from pricegrain.llm.common import map_batches, texts

#: Fixed: the split of byte-level vocabularies before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces up to this long are remembered, and so many of them in each Python worker.
MEMO_CHARS, MEMO_PIECES = 48, 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Merge ranks and special strings of one tokenizer file; a few MB, fixed by the file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)


def merged_length(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left after merging: repeatedly join the adjacent pair of lowest rank, leftmost first."""
    n = len(symbols)
    sym: list[str | None] = list(symbols)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[p], i, *p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = nxt[i]
        if sym[i] != a or j >= n or sym[j] != b:
            continue  # one of the two has been merged since
        sym[i], sym[j] = a + b, None
        nxt[i] = after = nxt[j]
        left -= 1
        if after < n:
            prv[after] = i
            if (r := ranks.get((a + b, sym[after]))) is not None:
                heapq.heappush(heap, (r, i, a + b, sym[after]))
        if (before := prv[i]) >= 0 and (r := ranks.get((sym[before], a + b))) is not None:
            heapq.heappush(heap, (r, before, sym[before], a + b))
    return left


class PieceCounts(dict):
    """Tokens of each piece, remembered up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.ranks, self.symbols = vocabulary.ranks, byte_symbols()

    def __missing__(self, piece: str) -> int:
        n = merged_length([self.symbols[b] for b in piece.encode()], self.ranks)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = n
        return n


def token_counts(docs: DataFrame, vocabulary_path: str, limit: int = 512) -> DataFrame:
    """Tokens of each whole text under a byte-level BPE file, special strings counting as one token.

    Returns doc_id, n_bytes, n_tokens, over_limit, one row per input row. A null text counts as empty
    (0 bytes, 0 tokens); repeated rows and null ids stay as they are. The count is the number of initial
    symbols minus the merges; no ids are made. The file is read once on the driver and sent as ranks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))

    def count(batches):
        vocabulary = shared.value
        pieces = PieceCounts(vocabulary)
        split = regex.compile(SPLIT).findall
        special = regex.compile("|".join(map(regex.escape, vocabulary.special))) if vocabulary.special else None
        for batch in batches:
            n_tokens, n_bytes = [], []
            for text in batch["text"]:
                text = text or ""
                parts = special.split(text) if special else [text]
                n_tokens.append(len(parts) - 1 + sum(sum(map(pieces.__getitem__, split(p))) for p in parts))
                n_bytes.append(len(text.encode()))
            yield {"doc_id": batch["doc_id"], "n_bytes": n_bytes, "n_tokens": n_tokens, "over_limit": [n > limit for n in n_tokens]}

    return map_batches(texts(docs), "doc_id long, n_bytes long, n_tokens long, over_limit boolean", count)
