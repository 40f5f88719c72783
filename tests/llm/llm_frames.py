"""Rows of every kind, for all operators."""

import os

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LONG = "of the ring a long tale " * 20_000 + "x" * 70_000
# Null id and text, empty and blank texts, a very long one, ties, repeated rows, odd characters.
ROWS = [
    (None, None),
    (None, "a row without id, one two three four five six seven"),
    (1, None),
    (2, ""),
    (3, " \n\t\n "),
    (4, LONG),
    (5, "one two three four five six seven eight nine ten eleven"),
    (5, "one two three four five six seven eight nine ten eleven"),
    (6, "one two three four five six seven eight nine ten eleven"),
    (7, "12 34 !! ??"),
    (8, "Ünïcode ▁ 日本語 \U0001f600 é <|endoftext|> it's <s>\r\n\x00end"),
    (9, "x"),
]
NAMES = (
    "n_tokens tm_row tm_id id term segment place key component_id kept line removed part "
    "start curve shard slot size fingerprint score lang_pred predicted held_out n u v range extra"
).split()


def texts_of(frame):
    return [r["text"] or "" for r in frame.select("text").collect()]
