"""Token counts, sentence pieces and token files against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import sentence_pieces, token_count, token_files
from tidemark.llm.common import vocabulary
from tidemark.session import new_scratch_path

ALPHABET = [" ", "  ", "\n", "\t", "a", "B", "the", "ing", "é", "É", "ß", "İ", "Σ", "▁", "'s", "12"]
ALPHABET += ["!", "...", ",", "&", "日本", "\U0001f600", "\x00", "aaaa", "    ", "=====", "\x85", "."]
ALPHABET += ["<|endoftext|>", "<|ENDOFTEXT|>", "<s>", "</s>", "<0x41>", "é", "क़", "\x1f"]


@pytest.fixture(scope="module")
def library():
    return {n: Tokenizer.from_file(vocabulary(n)) for n in (token_count.VOCABULARY, token_files.VOCABULARY)}


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary(sentence_pieces.VOCABULARY))


@pytest.fixture(scope="module")
def strange():
    r = random.Random(5)
    made = ["".join(r.choices(ALPHABET, k=r.randrange(30))) for _ in range(3000)]
    points = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    return made + [f"a {c}1 {c}{c}  b" for c in points] + [" " * 300 + "x", "ab" * 3000]


def test_counts_are_those_of_the_library(library, strange):
    own = token_count.Counter(vocabulary(token_count.VOCABULARY))
    tokenizer = library[token_count.VOCABULARY]
    expected = [len(e.ids) for e in tokenizer.encode_batch(strange, add_special_tokens=False)]
    assert [own.count(t) for t in strange] == expected


def test_heap_merges_without_ids():
    own = token_count.Counter(vocabulary(token_count.VOCABULARY))
    assert own.merged("the") == 1 and own.merged(" the") == 1 and own.merged("") == 0


def test_pieces_are_those_of_the_library(pieces, strange):
    own = sentence_pieces.Pieces(vocabulary(sentence_pieces.VOCABULARY))
    for text, ids in zip(strange, pieces.encode(strange)):
        assert own.encode(text) == ids
        back = pieces.decode([*ids, 2])
        assert own.decode([*ids, 2]) == back
        assert own.digest(text) == (len(ids) + 1, " ".join(map(str, [*ids, 2])), back)


def test_file_ids_are_those_of_the_library(library, strange):
    own = token_files.Encoder(vocabulary(token_files.VOCABULARY))
    tokenizer = library[token_files.VOCABULARY]
    for text, found in zip(strange, tokenizer.encode_batch(strange, add_special_tokens=False)):
        assert np.frombuffer(own.encode(text), "<i4").tolist() == found.ids


def test_count_tokens_rows(odd, empty, library):
    rows = token_count.count_tokens(odd, limit=5).collect()
    assert rows[0].asDict().keys() == {"doc_id", "n_bytes", "n_tokens", "over_limit"}
    tokenizer = library[token_count.VOCABULARY]
    expected = []
    for r in odd.collect():
        text = r["text"] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        expected.append((r["doc_id"], len(text.encode()), n, n > 5))
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
    assert token_count.count_tokens(empty).count() == 0


def test_piece_digests_rows(odd, empty, pieces):
    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    expected = []
    for r in odd.collect():
        ids = [*pieces.encode(r["text"] or ""), 2]
        shown = " ".join(map(str, ids))
        expected.append((r["doc_id"], len(ids), sha(shown), sha(pieces.decode(ids))))
    rows = sentence_pieces.piece_digests(odd).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
    whole = sentence_pieces.encode_pieces(odd.filter("doc_id = 8")).first()
    assert whole["ids"] == [*pieces.encode(odd.filter("doc_id = 8").first()["text"]), 2]
    assert sentence_pieces.piece_digests(empty).count() == 0


def test_token_files_round_trip(ready, docs, odd, empty, library):
    tokenizer = library[token_files.VOCABULARY]
    for frame in (docs, odd):
        target = token_files.write_token_files(frame, new_scratch_path(ready, "tokens"))
        stored = token_files.read_token_files(ready, target)
        rows = token_files.token_digests(stored).collect()
        texts = sorted(
            ((r["doc_id"], r["text"] or "") for r in frame.collect()),
            key=lambda r: -1 if r[0] is None else r[0],
        )
        expected, start = [], 0
        for own, text in texts:
            ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
            expected.append((own, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        assert sorted([(r[0], r[2], r[3]) for r in rows], key=str) == sorted(expected, key=str)
        for row in sorted(rows, key=lambda r: r["start"]):
            assert row["start"] == start
            start += row["n_tokens"]
        order = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
        assert order == [own for own, _ in texts]
    target = token_files.write_token_files(empty, new_scratch_path(ready, "tokens"))
    assert token_files.token_digests(token_files.read_token_files(ready, target)).count() == 0


def test_token_files_are_encoded_and_pruned(ready, docs):
    import pyarrow.parquet as pq

    target = token_files.write_token_files(docs, new_scratch_path(ready, "tokens"))
    files = token_files.read_token_files(ready, target).inputFiles()
    meta = pq.ParquetFile(files[0].removeprefix("file://")).metadata.row_group(0)
    kinds = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert "RLE_DICTIONARY" in kinds["ids.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in kinds["doc_id"].encodings
    assert kinds["doc_id"].has_offset_index and kinds["ids.list.element"].has_offset_index
    some = token_files.read_token_files(ready, target).filter("doc_id between 3 and 9").select("n_tokens")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:int>" in plan and "PushedFilters: [IsNotNull(doc_id)" in plan
    assert token_files.token_offsets(token_files.read_token_files(ready, target)).agg(F.min("base")).first()[0] == 0
