"""Token counts by byte-pair merging, without making any token id.

Method: the bytes of a word are a doubly linked list of symbols. A heap holds
every adjacent pair that has a merge rank; the lowest rank (the leftmost among
equals) is popped, checked against the list as it is now, and merged, which
offers two new pairs. The count is the initial symbols minus the merges.
"""

from __future__ import annotations

import json
import re
from heapq import heapify, heappop, heappush

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from tidemark.llm.common import Memo, kept, per_text, vocabulary

VOCABULARY = "byte_bpe_50k.json"
# Words kept with their counts in a Python worker, so that memory stays bounded.
CACHED = 200_000

# Fixed value: the pattern of the public vocabulary that splits text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space as the pattern means it; words end there, but for one leading space.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUNS = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Counter:
    """Counts tokens of texts for one vocabulary file of kind byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        merges = content["model"]["merges"]
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges)
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.symbols = byte_symbols()
        self.special = [t["content"] for t in content["added_tokens"]]
        self.between = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.words = regex.compile(WORDS)
        self.of_word = Memo(self.merged, CACHED)
        self.of_run = Memo(self._run, CACHED)

    def merged(self, word: str) -> int:
        """Symbols left of ``word`` when no pair can be merged any more."""
        symbols = [self.symbols[b] for b in word.encode()]
        count = len(symbols)
        ranks = self.ranks
        heap = [
            (rank, left)
            for left, pair in enumerate(zip(symbols, symbols[1:]))
            if (rank := ranks.get(pair)) is not None
        ]
        heapify(heap)
        after = [*range(1, count), -1]
        before = [*range(-1, count - 1)]
        while heap:
            rank, left = heappop(heap)
            right = after[left]
            if right < 0 or ranks.get((symbols[left], symbols[right])) != rank:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            count -= 1
            following = after[left] = after[right]
            after[right] = -1
            if following >= 0:
                before[following] = left
                offered = ranks.get((symbols[left], symbols[following]))
                if offered is not None:
                    heappush(heap, (offered, left))
            if (previous := before[left]) >= 0:
                offered = ranks.get((symbols[previous], symbols[left]))
                if offered is not None:
                    heappush(heap, (offered, previous))
        return count

    def _run(self, run: str) -> int:
        return sum(map(self.of_word.__getitem__, self.words.findall(run)))

    def _plain(self, text: str) -> int:
        return sum(map(self.of_run.__getitem__, RUNS.findall(text)))

    def count(self, text: str) -> int:
        """Tokens of a whole text; each special string inside is one token."""
        if self.between is None:
            return self._plain(text)
        parts = self.between.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1


@kept
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(
    df: DataFrame,
    *,
    path: str | None = None,
    limit: int = 512,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Columns id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of each text.

    ``path`` is a vocabulary file that every worker can read. A null or empty
    text has 0 bytes and tokens; a text of any length is counted whole. Each
    row of ``df`` gives one row, repeated rows too; ids may be null. Other
    columns are not read, so their names cannot clash. No shuffle.
    """
    path = path or vocabulary(VOCABULARY)
    counted = per_text(
        df,
        lambda texts: [list(map(counter(path).count, texts))],
        [StructField("n_tokens", LongType())],
        id_column,
        text_column,
        (F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long").alias("n_bytes"),),
    )
    return counted.select(
        id_column, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
