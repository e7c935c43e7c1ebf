"""Texts over a token limit cut into pieces at natural boundaries, with overlap.

A text's tokens give prefix sums of bytes, and these of characters. Every token end is classed by the characters around
it, in any script: end of a paragraph, of a line, of a sentence (its marks, closing quotes and brackets included), or of a
word, which is any text before white space; each class is a sorted array of token positions. A piece that begins at token s
ends at the last boundary at or under s + limit, found by binary search, of the strongest class that fills at least
``fill`` of the limit; word ends need no such fill. Where there is none, the cut is hard, at the last token end that
doesn't split a character. The next piece begins ``overlap`` tokens before that end, or at the first natural boundary
after that point. Each piece is encoded again by itself; if that gives more tokens than the limit, its end steps back.

Defined results: null, empty and blank texts, and all of at most ``limit`` tokens, give no piece (or one, with
``all_texts``; null gives none); pieces in order cover the text without gap; line ends and odd characters stay as they
are; one long word is cut hard, but nothing is cut between two neighbouring token ends that split no character, even if
a limit of a few tokens is less than that; repeated rows give repeated pieces. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilake.llm.encode import BYTE_BPE, SLICE, Encoder, char_positions, encoder, ship

def _code_points(*parts: str | range) -> np.ndarray:
    return np.unique(np.array([ord(x) if isinstance(x, str) else x for p in parts for x in p], np.uint32))


END = 0x110000  # stands after the last character
WHITE = _code_points(range(9, 14), " \x85\xa0\u1680", range(0x2000, 0x200B), "\u2028\u2029\u202f\u205f\u3000", [END])
MAYBE_WHITE = _code_points(WHITE.tolist(), range(0x1C, 0x20), "\u180e\u200b\ufeff")  # white in some version of Unicode
LINE_ENDS, PARAGRAPH_ENDS = _code_points("\n\x85\u2028\u2029"), _code_points("\u2029")
STOPS = _code_points(".!?\u2026\u203c\u2047\u2048\u2049\u061f\u06d4\u0964\u0965\u1362\u1367\u104b\u17d4\u0589")  # before white space
WIDE_STOPS = _code_points("\u3002\uff01\uff1f\uff61\uff0e")  # end a sentence whatever follows
CLOSERS = _code_points("\"')]}\xbb\u2019\u201d\u203a\u300d\u300f\u3011\uff09")
IS_WHITE, IS_MAYBE, IS_LINE, IS_PARAGRAPH, IS_STOP, IS_WIDE, IS_CLOSER = (1 << i for i in range(7))
_CLASSES = np.zeros(END + 1, np.uint8)  # of every character
for _bit, _points in zip((IS_WHITE, IS_MAYBE, IS_LINE, IS_PARAGRAPH, IS_STOP, IS_WIDE, IS_CLOSER), (WHITE, MAYBE_WHITE, LINE_ENDS, PARAGRAPH_ENDS, STOPS, WIDE_STOPS, CLOSERS)):
    _CLASSES[_points] |= _bit


def boundaries(data: bytes, ends: np.ndarray, chars: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Token counts after which a paragraph, line, sentence or word ends, strongest first; after which any does; that split
    no character; and, by token count, whether a pre-token surely ends there. All by characters, in any script: a word ends at any
    other character before white space. ``chars``: the characters' positions by byte, unless they are the same."""
    if chars is None:
        index, at, text = np.arange(1, len(ends) + 1), ends, np.frombuffer(data, np.uint8)
    else:
        b = np.frombuffer(data + b"\0", np.uint8)
        index = np.flatnonzero((b[ends] & 0xC0) != 0x80) + 1
        at, text = chars[ends][index - 1], np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
    kind = np.zeros(len(text) + 4, np.uint8)
    kind[3:-1], kind[-1] = _CLASSES[text], _CLASSES[END]
    last, before, third, after = kind[at + 2], kind[at + 1], kind[at], kind[at + 3]
    white = after & IS_WHITE > 0
    line_end = (last & IS_LINE > 0) & (after & IS_MAYBE == 0)  # begins a pre-token, as does white space after a word
    paragraph, i = np.zeros(len(at), bool), np.flatnonzero(line_end)
    if len(i):
        returned = text[np.maximum(at[i] - 2, 0)] == 13
        paragraph[i] = (before[i] & IS_LINE > 0) | (returned & (third[i] & IS_LINE > 0)) | (last[i] & IS_PARAGRAPH > 0)
    mark = np.where(last & IS_CLOSER > 0, before, last)
    sentence = (mark & IS_STOP > 0) & white
    word = (white & (last & IS_MAYBE == 0)) | line_end
    sure = word
    if chars is not None:
        wide = (mark & IS_WIDE > 0) & (after & (IS_CLOSER | IS_WIDE) == 0) & (at < len(text))
        sentence, letter = sentence | wide, np.zeros(len(at), bool)
        for i in np.flatnonzero(wide & ~white):
            letter[i] = chr(text[at[i]]).isalnum()
        sure = word | letter
    surely = np.zeros(len(ends) + 1, bool)
    surely[index] = sure
    return [index[x] for x in (paragraph, line_end, sentence, word)], index[sentence | word], index, surely


def _last(sorted_positions: np.ndarray, most: int) -> int:
    """The last position at or under ``most``; 0 if there is none."""
    i = np.searchsorted(sorted_positions, most, "right")
    return int(sorted_positions[i - 1]) if i else 0


def pieces(e: Encoder, text: str, ids: np.ndarray, limit: int, overlap: int, fill: float) -> list[tuple[int, int, int, int]]:
    """(first character, character after the last, tokens, tokens shared with the piece before) of each piece."""
    data = text.encode("utf-8", "replace")
    ends, n = e.byte_ends(ids), len(ids)
    chars = char_positions(data)
    levels, natural, whole, sure = boundaries(data, ends, chars)
    byte = np.concatenate([[0], ends])
    char = byte if chars is None else chars[byte]

    def tokens(start: int, cut: int) -> int:
        """Tokens of the piece encoded by itself."""
        piece = text[char[start] : char[cut]]
        body = piece.rstrip()
        run = piece[len(body) :]
        if body and (start == 0 or sure[start]) and (cut == n or sure[cut]):
            if not run:
                return cut - start
            # Between sure boundaries the pre-tokens are those of the whole text, but for the white space at the end.
            head = int(np.searchsorted(ends, byte[cut] - len(run.encode()))) + 1
            if byte[head] == byte[cut] - len(run.encode()):
                return head - start + e.count_of(run)
        return len(e.encode([piece])[0])

    out, start, done = [], 0, 0  # done: end of the piece before
    while done < n:
        most = start + limit
        while True:
            if most >= n:
                cut = n
            else:
                cut = next((x for x in (_last(p, most) for p in levels[:-1]) if x > done and x - start >= fill * limit), 0)
                cut = cut or _last(levels[-1], most)
                if cut <= done:
                    cut = _last(whole, most)
            if cut <= done:
                if start < done:  # nothing new fits beside the overlap: do without it
                    start, most = done, done + limit
                    continue
                cut = int(whole[np.searchsorted(whole, done, "right")])  # more tokens to the next character than the limit
                own = tokens(start, cut)
                break
            own = tokens(start, cut)
            if own <= limit:
                break
            most = cut - 1
        out.append((int(char[start]), int(char[cut]), own, done - start if out else 0))
        done = cut
        if done < n:
            back = max(done - overlap, start + 1)
            i = np.searchsorted(natural, back)
            start = int(natural[i]) if i < len(natural) and natural[i] < done else int(whole[np.searchsorted(whole, back)])
            start = min(start, done)
    return out


SCHEMA = [
    T.StructField("piece", T.IntegerType()),
    T.StructField("first_char", T.IntegerType()),
    T.StructField("end_char", T.IntegerType()),
    T.StructField("n_tokens", T.IntegerType()),
    T.StructField("n_overlap", T.IntegerType()),
    T.StructField("text", T.StringType()),
]


def split(df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 512, overlap: int = 64, fill: float = 0.5, path: str = BYTE_BPE, all_texts: bool = False, with_text: bool = True) -> DataFrame:
    """(key, piece, first_char, end_char, n_tokens, n_overlap, text): the pieces of each text over the limit."""
    schema, path = T.StructType([df.schema[key], *SCHEMA]), ship(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = part.column(1).to_pylist()
                ids, cuts = e.encode(texts)
                rows, owner = [], []
                for i, t in enumerate(texts):
                    n = int(cuts[i + 1] - cuts[i])
                    if n > limit:
                        found = pieces(e, t, ids[cuts[i] : cuts[i + 1]], limit, overlap, fill)
                    elif all_texts and t is not None:
                        found = [(0, len(t), n, 0)]
                    else:
                        continue
                    owner += [i] * len(found)
                    rows += [(k, *x, t[x[0] : x[1]] if with_text else None) for k, x in enumerate(found)]
                if rows:
                    columns = [pa.array(c, f) for c, f in zip(zip(*rows), [pa.int32()] * 5 + [pa.string()])]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), *columns], names=schema.names)

    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, schema)
