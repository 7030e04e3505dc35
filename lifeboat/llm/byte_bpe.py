"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Every whole text is encoded as the library would encode it: each match of the
pattern on its own, no special tokens. Long texts are cut first, at places where
a match of the pattern must end: between a character that is no white space and
one that is, as white space only ever begins a match or fills one. So the
pieces' ids, one after the other, are the whole text's ids, and the library's
regex engine never sees more than about ``PIECE_CHARS`` characters plus one
word. A run of white space too long for that engine's stack is one match
of the pattern by itself (less its last character, which goes with what follows) and is
encoded by a second encoding whose pattern is white space only.

Decoding joins the bytes of the ids; they need not be valid UTF-8 on their own.

The driver reads the rank file once; its bytes (checked against
``MOST_RANK_BYTES``) travel with the job, so executors need no file. One narrow
pass over the rows each, no shuffle.

Defined results: null and empty texts have no ids and no bytes; bytes of a text
that are not UTF-8 are read as U+FFFD; null ids decode to no bytes, an id outside the
rank file raises; repeated rows are encoded one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeboat.llm.common import map_columns

#: Characters from which a text is cut, and white space from which a run is taken out of it.
PIECE_CHARS = 1 << 16
LONG_BLANK = 1 << 14
#: Bytes of text whose ids are held at once.
SLICE_BYTES = 4_000_000
MOST_RANK_BYTES = 64_000_000

# The characters that the library's \s matches (Python's own \s has four more).
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CUT = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")
_BLANK = re.compile(f"[{WHITE}]{{{LONG_BLANK},}}")


def rank_bytes(path: str) -> bytes:
    """The rank file, read on the driver."""
    with open(path, "rb") as f:
        data = f.read(MOST_RANK_BYTES + 1)
    if len(data) > MOST_RANK_BYTES:
        raise ValueError(f"{path} has over {MOST_RANK_BYTES} bytes: too much to send with a job")
    return data


class Codec:
    """The library's encoding over one rank file; what a task holds."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line)}
        make = lambda name, pat: tiktoken.Encoding(name, pat_str=pat, mergeable_ranks=table, special_tokens={})
        self.texts, self.blanks = make("ranks", pattern), make("ranks-blank", r"\s+")

    def encode(self, text: str) -> list[int]:
        if len(text) <= PIECE_CHARS:
            return self.texts.encode_ordinary(text)
        out: list[int] = []
        for piece, blank in pieces(text):
            out += (self.blanks if blank else self.texts).encode_ordinary(piece)
        return out

    def decode(self, ids: list[int]) -> bytes:
        return self.texts.decode_bytes(ids)


def pieces(text: str) -> Iterator[tuple[str, bool]]:
    """(piece, is it a long run of white space) of a text, in order; matches of the pattern never cross a piece's end."""
    at = 0
    for run in _BLANK.finditer(text):
        yield from _plain(text, at, run.start())
        at = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start():at], True
    yield from _plain(text, at, len(text))


def _plain(text: str, at: int, end: int) -> Iterator[tuple[str, bool]]:
    while at < end:
        cut = _CUT.search(text, at + PIECE_CHARS, end) if end - at > PIECE_CHARS else None
        stop = cut.start() if cut else end
        yield text[at:stop], False
        at = stop


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(sizes):
        end, size = at + 1, sizes[at]
        while end < len(sizes) and size + sizes[end] <= SLICE_BYTES:
            size += sizes[end]
            end += 1
        yield at, end
        at = end


def encode(docs: DataFrame, rank_path: str, pattern: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, ids (array of the token ids of the whole text) of every row."""
    kind, ranks = docs.schema[id_col].dataType.simpleString(), rank_bytes(rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks, pattern)
        for b in batches:
            raw = b.column(1)
            for at, end in _slices([len(x.as_buffer() or b"") for x in raw]):
                ids = [codec.encode(x.as_py().decode("utf-8", "replace")) for x in raw.slice(at, end - at)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, end - at), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    text = F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b""))
    return map_columns(docs, [F.col(id_col).alias("id"), text.alias("text")], f"id {kind}, ids array<int>", run)


def decode(tokens: DataFrame, rank_path: str, pattern: str, ids_col: str = "ids", id_col: str = "id") -> DataFrame:
    """id, ids, bytes (those of all ids, joined) of every row."""
    kind, ranks = tokens.schema[id_col].dataType.simpleString(), rank_bytes(rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks, pattern)
        for b in batches:
            lists = b.column(1)
            for at, end in _slices([4 * (len(x) if x.is_valid else 0) for x in lists]):
                part = lists.slice(at, end - at)
                raw = [codec.decode(x.values.to_pylist()) if x.is_valid else b"" for x in part]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, end - at), part, pa.array(raw, pa.binary())], ["id", "ids", "bytes"])

    ids = F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>"))
    return map_columns(tokens, [F.col(id_col).alias("id"), ids.alias("ids")], f"id {kind}, ids array<int>, bytes binary", run)
