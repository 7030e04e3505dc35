"""Token counts of whole texts by a public tokenizer, in Arrow batches.

Texts are cut at safe boundaries: a single space with no white space on
either side always starts a pre-token of the byte-level tokenizer, so pieces
cut before such spaces encode to the same tokens as the whole text. The
pieces of a batch that have not been counted yet go to the tokenizer's batch
encoder in lists of about equal bytes; only lengths are kept. A bounded
cache of piece lengths lives in each Python worker.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows
are counted one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeboat.llm.common import map_columns, text_or_empty

#: Bytes of pieces in one call of the batch encoder, and piece lengths a worker keeps.
BATCH_BYTES = 1 << 18
CACHE_PIECES = 400_000

# White space beside a space, or at either end: cut such texts with the slow pattern.
_CLOSE = re.compile(r"\s | \s|\A\s|\s\Z")
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def pieces(text: str) -> list[str]:
    """The text cut before every safe space; the space of a later piece is left off."""
    return (_SAFE.split(text) if _CLOSE.search(text) else text.split(" ")) if text else []


def byte_batches(items: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Lists of about ``limit`` bytes each; a longer item is a list of its own."""
    batch, size = [], 0
    for x in items:
        n = len(x) * (1 if x.isascii() else 2)
        if batch and size + n > limit:
            yield batch
            batch, size = [], 0
        batch.append(x)
        size += n
    if batch:
        yield batch


class Counter:
    """Counts tokens with ``encode``, a function from a list of texts to their lengths."""

    def __init__(self, encode):
        self.encode, self.first, self.later = encode, {}, {}

    def _learn(self, known: dict[str, int], asked: set[str], lead: str) -> None:
        new = sorted(asked.difference(known))
        for batch in byte_batches(new):
            known.update(zip(batch, self.encode([lead + x for x in batch]), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        if len(self.first) + len(self.later) > CACHE_PIECES:
            self.first.clear()
            self.later.clear()
        cut = [pieces(t) for t in texts]
        self._learn(self.first, {p[0] for p in cut if p}, "")
        self._learn(self.later, set().union(*(p[1:] for p in cut)), " ")
        get = self.later.__getitem__
        return [self.first[p[0]] + sum(map(get, p[1:])) if p else 0 for p in cut]


def json_encoder(path: str):
    """Lengths by the tokenizers library: its defaults, no special tokens added."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return lambda texts: [len(e) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]


def count_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text", id_col: str = "doc_id",
                 limit: int = 1024) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit for every row; no shuffle.

    ``tokenizer_path`` is a byte-level BPE file that every executor has.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(json_encoder(tokenizer_path))
        for b in batches:
            texts, sizes, counts = b.column(1), b.column(2).to_pylist(), []
            at = 0
            while at < len(sizes):            # so many rows as make a few MB of text
                end, size = at + 1, sizes[at]
                while end < len(sizes) and size + sizes[end] <= 4_000_000:
                    size += sizes[end]
                    end += 1
                counts += counter.count(texts.slice(at, end - at).to_pylist())
                at = end
            tokens = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), tokens], ["id", "n_bytes", "n_tokens"])

    out = map_columns(docs, [F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"),
                             F.octet_length(text_or_empty(text_col)).cast("long").alias("n_bytes")],
                      f"id {kind}, n_bytes long, n_tokens long", run)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
