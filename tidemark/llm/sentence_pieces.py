"""SentencePiece encoding and decoding of merge-type models, exact, by backtracking.

Method: an Aho-Corasick automaton of the pieces gives the longest piece that
starts at each position. Pieces are taken greedily; a piece may follow another
only if merging the text of both from scratch gives just these two. If not,
the next shorter piece that starts there is tried, and when none is left, the
position is marked as failed in a bitfield and the piece before is taken back.

Pieces never span a character pair that occurs in no piece, so a text is cut
there first, and what was encoded is remembered by its characters.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from tidemark.llm.common import Memo, kept, per_text, vocabulary

VOCABULARY = "piece_bpe_32k.model"
# Pairs of pieces, parts of words, and words kept in a Python worker, so that memory stays bounded.
CACHED = 150_000
CACHED_WORDS = 250_000
SPACE = "▁"
LETTER = re.compile(r"[^\W\d_]")


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end = model.eos_id()
        self.text_of: list[str] = []
        self.id_of: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.byte_of[i] = int(piece[1:-1], 16)
                piece = ""
            elif model.is_control(i):
                piece = ""
            elif not (model.is_unknown(i) or model.is_unused(i)):
                self.id_of[piece] = i
                self.score[piece] = model.get_score(i)
            self.text_of.append(piece)
        self.fits_memo: dict[tuple[str, str], bool] = {}
        self.shown = {piece: str(i) for piece, i in self.id_of.items()}
        self.of_chunk = Memo(self.chunk_digest, CACHED)
        self.of_word = Memo(lambda word: self._word_digest(f" {word}"), CACHED_WORDS)
        self.of_first = Memo(self._word_digest, CACHED)
        # What merging the text of a piece does not give back is never a result.
        reached = [p for p in self.id_of if len(p) == 1 or self.merge(p) == [p]]
        self.longest = ahocorasick.Automaton()
        for piece in reached:
            self.longest.add_word(piece, (len(piece) - 1, piece))
        self.longest.make_automaton()
        known = set(reached)
        self.shorter = {
            p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in known), "") for p in reached
        }
        # A text is cut where no piece goes on: before spaces, around a line end,
        # and between a letter and a sign that follows a letter in no piece.
        if any(re.search(f"[^{SPACE}]{SPACE}|{SPACE}{SPACE}[^{SPACE}]", p) for p in self.id_of):
            raise ValueError("pieces across words are not supported")
        if any("\n" in p and len(p) > 1 for p in self.id_of):
            raise ValueError("pieces across lines are not supported")
        joined = {p[i] for p in self.id_of for i in range(1, len(p)) if LETTER.match(p[i - 1])}
        signs = {p for p in self.id_of if len(p) == 1 and not re.match(r"\w|\s", p)} - joined
        apart = f" *{LETTER.pattern}+(?=[{re.escape(''.join(sorted(signs - {SPACE})))}])|"
        self.cuts = re.compile((apart if signs - {SPACE} else "") + " *[^ \n]+|\n| +")
        # Runs of spaces share one score. Beyond a few, the same leading piece recurs.
        self.lead = len(self.merge(SPACE * 96)[0])
        self.even_runs = all(
            self.merge(SPACE * n) == [SPACE * self.lead, *self.merge(SPACE * (n - self.lead))]
            for n in range(48, 96)
        )

    def merge(self, text: str) -> list[str]:
        """Merge from single characters: the best score first, the leftmost among equals."""
        parts = list(text)
        score = self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = score.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether merging the text of two pieces gives these two pieces."""
        pair = (left, right)
        found = self.fits_memo.get(pair)
        if found is None:
            if len(self.fits_memo) >= CACHED:
                self.fits_memo.clear()
            found = self.fits_memo[pair] = self.merge(left + right) == [left, right]
        return found

    def split(self, text: str) -> list[str]:
        """The pieces of a text whose spaces are replaced, by backtracking."""
        size = len(text)
        starts: list[str] = [""] * size
        for last, (back, piece) in self.longest.iter(text):
            starts[last - back] = piece  # a later end is a longer piece
        failed = bytearray(size // 8 + 1)  # one bit for each position
        taken: list[str] = []
        known = self.fits_memo.get
        at = 0
        piece = starts[0] or text[0]
        while at < size:
            end = at + len(piece)
            if (
                piece
                and not failed[end >> 3] >> (end & 7) & 1
                and (
                    not taken
                    or known(pair := (taken[-1], piece))
                    or (known(pair) is None and self.fits(*pair))
                )
            ):
                taken.append(piece)
                at = end
                piece = (starts[at] or text[at]) if at < size else ""
            elif not (piece := self.shorter.get(piece, "")):
                failed[at >> 3] |= 1 << (at & 7)
                before = taken.pop()
                at -= len(before)
                piece = self.shorter.get(before, "")
        return taken

    def spaces(self, count: int) -> list[str]:
        """The pieces of a run of spaces."""
        full = max(0, count - 48) // self.lead if self.even_runs else 0
        return [SPACE * self.lead] * full + self.merge(SPACE * (count - full * self.lead))

    def chunk(self, text: str) -> list[str]:
        """The pieces of spaces and what follows; only the last space can join that."""
        word = text.lstrip(" ")
        count = len(text) - len(word)
        if not word:
            return self.spaces(count)
        taken = self.split(SPACE * bool(count) + word)
        if count < 2:
            return taken
        if taken[0] == SPACE:
            return [*self.spaces(count), *taken[1:]]
        return [*self.spaces(count - 1), *taken]

    def ids(self, pieces: list[str]) -> list[int]:
        """The id of each piece, or those of its bytes."""
        found: list[int] = []
        for piece in pieces:
            i = self.id_of.get(piece)
            if i is None:
                found.extend(self.byte_ids[b] for b in piece.encode())
            else:
                found.append(i)
        return found

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text, without begin and end."""
        if not text:
            return []
        found: list[int] = []
        for chunk in self._chunks(text):
            found.extend(self.ids(self.chunk(chunk)))
        return found

    def _chunks(self, text: str) -> list[str]:
        text = " " + text.replace(SPACE, " ")
        return self.cuts.findall(text)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes joined to characters, the first space taken off."""
        return self._joined(ids).removeprefix(" ")

    def _joined(self, ids: list[int]) -> str:
        parts: list[str] = []
        pending = bytearray()
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            if pending:
                parts.append(pending.decode(errors="replace"))
                pending.clear()
            parts.append(self.text_of[i])
        if pending:
            parts.append(pending.decode(errors="replace"))
        return "".join(parts).replace(SPACE, " ")

    def chunk_digest(self, chunk: str) -> str | tuple[str, str]:
        """The ids as text; with what they decode to, where that is not the chunk."""
        taken = self.chunk(chunk)
        try:
            return " ".join([self.shown[piece] for piece in taken])
        except KeyError:  # bytes stand for a piece
            ids = self.ids(taken)
            return self._entry(chunk, " ".join(map(str, ids)), self._joined(ids))

    @staticmethod
    def _entry(given: str, shown: str, decoded: str) -> str | tuple[str, str]:
        return shown if decoded == given else (shown, decoded)

    def _word_digest(self, word: str) -> str | tuple[str, str]:
        """The same of what stands between two spaces, cut into its chunks."""
        chunks = self.cuts.findall(word)
        if len(chunks) == 1:
            return self.chunk_digest(chunks[0])
        return self._entry(word, *self._together(chunks, [self.of_chunk[c] for c in chunks]))

    @staticmethod
    def _together(given: Iterable[str], entries: list) -> tuple[str, str]:
        apart = [e if type(e) is tuple else (e, g) for e, g in zip(entries, given)]
        return " ".join([e[0] for e in apart]), "".join([e[1] for e in apart])

    def _line_entries(self, line: str) -> Iterator[str | tuple[str, str]]:
        """Words are looked up whole; a line with spaces side by side is cut."""
        first, *words = line.split(" ")
        if "" in words:
            return map(self.of_chunk.__getitem__, self.cuts.findall(line))
        found = map(self.of_word.__getitem__, words)
        return chain([self.of_first[first]], found) if first else found

    def _line_parts(self, line: str) -> Iterator[str]:
        """What the entries of the line stand for."""
        first, *words = line.split(" ")
        if "" in words:
            return iter(self.cuts.findall(line))
        found = (f" {word}" for word in words)
        return chain([first], found) if first else found

    def digest(self, text: str) -> tuple[int, str, str]:
        """Ids with the end id, counted and joined by a space; and the decoded text."""
        if not text:
            return 1, str(self.end), ""
        decoded = " " + text.replace(SPACE, " ")
        first, *lines = decoded.split("\n")
        entries = [*self._line_entries(first)]
        for line in lines:
            entries.append(self.of_chunk["\n"])
            entries.extend(self._line_entries(line))
        if tuple in set(map(type, entries)):
            parts = chain(
                self._line_parts(first),
                chain.from_iterable(chain(["\n"], self._line_parts(line)) for line in lines),
            )
            shown, decoded = self._together(parts, entries)
        else:
            shown = " ".join(entries)
        return shown.count(" ") + 2, f"{shown} {self.end}", decoded[1:]


@kept
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def encode_pieces(
    df: DataFrame, *, path: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Columns id, ids (with the end id), decoded of each text.

    A null or empty text has the end id alone and decodes to an empty text.
    Texts of any length are encoded whole. One row for each row, repeated rows
    too; ids may be null; other columns are not read. No shuffle.
    """
    path = path or vocabulary(VOCABULARY)

    def work(texts: list[str]) -> list[list]:
        own = pieces_of(path)
        ids = [[*own.encode(t), own.end] for t in texts]
        return [ids, [own.decode(i[:-1]) for i in ids]]

    fields = [
        StructField("ids", ArrayType(IntegerType())),
        StructField("decoded", StringType()),
    ]
    return per_text(df, work, fields, id_column, text_column)


def piece_digests(
    df: DataFrame, *, path: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Columns id, n_tokens, ids_sha256, decoded_sha256 of what ``encode_pieces`` gives.

    The same work without handing the ids to the JVM: n_tokens counts the end
    id, ids_sha256 is that of the decimal ids joined by one space. Nulls, empty
    and long texts, ties and repeated rows as there.
    """
    path = path or vocabulary(VOCABULARY)

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def work(texts: list[str]) -> list[list]:
        counts, ids, decoded = [], [], []
        for text in texts:
            count, shown, back = pieces_of(path).digest(text)
            counts.append(count)
            ids.append(sha(shown))
            decoded.append(sha(back))
        return [counts, ids, decoded]

    fields = [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
    return per_text(df, work, fields, id_column, text_column)
