"""Token counts of whole texts, huge ones by overlapping chunks that are spliced where they agree.

The vocabulary is a BPE whose pieces never hold a space mark after another character (checked when
it is loaded). No merge can then cross the place before a space that follows a non-space: there, the
pieces to the right don't depend on what is to the left. A text longer than ``chunk`` characters is
encoded in chunks that overlap; two neighbours are spliced at such a place in their overlap at
which both have a piece boundary. If the overlap has none, it is widened to the right, in the end to
the rest of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
SPLICE = re.compile("(?<=[^ ▁])(?=[ ▁])")
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


@lru_cache(maxsize=4)
def load_model(path: str) -> sentencepiece.SentencePieceProcessor:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    crossing = re.compile(f"[^{MARK}]{MARK}")
    if any(crossing.search(model.id_to_piece(i)) for i in range(model.get_piece_size())):
        raise ValueError("a piece of this vocabulary crosses a word boundary: splices aren't stable")
    return model


def _boundaries(model, text: str, start: int, stop: int) -> list[int]:
    """Where the pieces of ``text[start:stop]`` end, as places of the whole text."""
    mapping = model.encode(text[start:stop], return_type="offset_mapping")
    return [start + end for _, end in mapping["offsets"]]


def count_tokens(model, text: str, chunk: int = 16_384, overlap: int = 256) -> int:
    """Number of pieces the library gives for the whole text."""
    if len(text) <= chunk:
        return len(model.encode(text, return_type="numpy"))
    if overlap >= chunk:
        raise ValueError("the overlap must be shorter than a chunk")
    total, start, stop = 0, 0, chunk
    ends = _boundaries(model, text, start, stop)
    splice = None  # pieces of the present chunk count from here on
    while stop < len(text):
        width = overlap
        left = max(start, stop - overlap)
        while True:
            right = min(len(text), left + width)
            if right > stop:  # the overlap grows to the right: the present chunk is encoded further
                stop = right
                ends = _boundaries(model, text, start, stop)
            if stop == len(text):
                return total + _pieces(ends, splice, None)
            following = _boundaries(model, text, left, min(len(text), stop + chunk - overlap))
            known, theirs = set(ends), set(following)
            least = left if splice is None else max(left, splice)
            common = [m.start() for m in SPLICE.finditer(text, least + 1, stop)]
            common = [p for p in common if p in known and p in theirs]
            if common:
                break
            width *= 2
        total += _pieces(ends, splice, common[-1])
        ends, start, splice = following, left, common[-1]
        stop = min(len(text), stop + chunk - overlap)
    return total + _pieces(ends, splice, None)


def _pieces(ends: list[int], after: int | None, upto: int | None) -> int:
    """Pieces that end after one place and not after another; None: no such limit."""
    return sum(1 for e in ends if (after is None or e > after) and (upto is None or e <= upto))


def token_counts(docs: DataFrame, path: str, limit: int = 4096, chunk: int = 16_384, overlap: int = 256) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row; a null text counts as empty.

    Rows stay rows: repeated ones are counted each, an empty table gives none.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("text").to_pylist()
                short = iter(model.encode([t for t in texts if len(t) <= chunk], return_type="numpy", num_threads=1))
                counts = [len(next(short)) if len(t) <= chunk else count_tokens(model, t, chunk, overlap) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("n_bytes"),
                        pa.array(counts, pa.int64()),
                        pa.array([c > limit for c in counts], pa.bool_()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(count, SCHEMA)
