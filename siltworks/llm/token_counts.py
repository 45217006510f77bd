"""Token counts by byte-pair merging with a heap and a linked list, without making the tokens.

A text's symbols are its characters. The pair of neighbours whose joined string has the lowest rank in the
vocabulary is merged first, the leftmost of equals, until no pair is in the vocabulary. The count is the number of
symbols minus the number of merges; a character that is no piece and was not merged counts as its UTF-8 bytes. No
token is looked up or emitted.

Two characters that are neighbours in no piece can never be merged, so a text is cut between such characters
without changing any merge, and what a segment counts is remembered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from siltworks.llm.tables import arrow_map, arrow_type
from siltworks.llm.words import chunks

SPACE = "▁"  # what stands for a space in pieces
LIMIT = 4096
REMEMBERED = 400_000  # segments a task keeps at a time; what is forgotten is counted again
LONGEST_REMEMBERED = 48
# What a model must count as its library does: normalisation, space runs, bytes, special strings.
_PROBES = ("", " ", "  a   b ", "The quick\tbrown\n\nfox.", "Ａﬁ é", "<s></s><unk><0x41>", "\U0001f9ff͸", SPACE * 3 + "x")


@dataclass(frozen=True)
class Pieces:
    """A piece vocabulary: the order in which pieces are made, and the characters that are pieces themselves."""

    ranks: dict[str, int]
    segments: str  # pattern of the segments that no merge leaves

    @classmethod
    def load(cls, path: str) -> Pieces:
        """Read a ``.model`` of byte-pair merges with a fallback to bytes; any other kind is refused."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        own = [
            i for i in range(model.get_piece_size())
            if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
        ]
        order = {score: rank for rank, score in enumerate(sorted({model.get_score(i) for i in own}, reverse=True))}
        ranks = {model.id_to_piece(i): order[model.get_score(i)] for i in own}
        pieces = cls(ranks, _segments(ranks))
        for probe in _PROBES:
            if pieces.count(probe) != len(model.encode(probe)):
                raise ValueError(f"{path}: not a plain piece vocabulary of byte-pair merges")
        return pieces

    def count(self, text: str) -> int:
        return sum(self.merged(segment) for segment in re.findall(self.segments, marked(text)))

    def merged(self, segment: str) -> int:
        """Tokens of a segment: symbols minus merges, and the bytes of unknown characters that are left."""
        ranks, n = self.ranks, len(segment)
        ends = list(range(1, n + 1))  # of the symbol that begins here; 0 once it is part of the one before
        before = list(range(-1, n))  # where the symbol before this one begins
        heap = [(ranks[pair], i, i + 2) for i in range(n - 1) if (pair := segment[i : i + 2]) in ranks]
        heapify(heap)
        merges = 0
        while heap:
            _, left, end = heappop(heap)
            right = ends[left]
            if not left < right < end or ends[right] != end:
                continue  # one of the two has been merged meanwhile
            ends[left], ends[right] = end, 0
            before[end] = left
            merges += 1
            first = before[left]
            if first >= 0 and (pair := segment[first:end]) in ranks:
                heappush(heap, (ranks[pair], first, end))
            if end < n and (pair := segment[left : ends[end]]) in ranks:
                heappush(heap, (ranks[pair], left, ends[end]))
        unknown = [c for i, c in enumerate(segment) if c not in ranks and ends[i] == i + 1]
        return n - merges + sum(len(c.encode()) - 1 for c in unknown)


def _segments(ranks: dict[str, int]) -> str:
    """A pattern whose matches no piece crosses: cut off are characters that no longer piece has, and, if no piece
    has a space after another character, all that follows such a space."""
    joined = {c for piece in ranks if len(piece) > 1 for c in piece}
    if any(SPACE in piece.lstrip(SPACE) for piece in ranks):
        inside = f"[{re.escape(''.join(sorted(joined | {SPACE})))}]"
        return f"{inside}+|[^{inside[1:]}+"
    inside = re.escape("".join(sorted(joined - {SPACE})))
    return f"{SPACE}*[{inside}]+|{SPACE}+|[^{SPACE}{inside}]+"


def marked(text: str) -> str:
    """The text as pieces spell it: spaces marked, and one more before it."""
    return (SPACE + text).replace(" ", SPACE) if text else ""


class _Remembered(dict):
    """What segments count; a new one is counted when it is asked for."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, segment: str) -> int:
        count = self.pieces.merged(segment)
        if len(segment) <= LONGEST_REMEMBERED:
            self[segment] = count
        return count


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """Per row: ``doc_id, n_bytes`` (UTF-8), ``n_tokens, over_limit`` (more than ``limit`` tokens).

    ``vocabulary`` is the path of a ``.model`` on the driver; its pieces go to the tasks, whose size does not
    depend on the documents. Counts are those of the library without begin and end tokens; special strings inside
    a text are plain text. NULL and empty texts have no bytes and no tokens. Rows keep their ids, NULL and
    repeated ones too; other columns are not looked at; an empty table gives no rows. A text is counted whole
    however long it is; a stretch without a cut takes memory in proportion to its length.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Pieces.load(vocabulary))
    source = docs.select("doc_id", "text")
    out = pa.schema([("doc_id", arrow_type(docs, "doc_id")), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Remembered(shared.value)
        segments = re.compile(shared.value.segments).findall
        for batch in batches:
            for part in chunks(batch, 1):
                texts = part.column(1)
                counts = [sum(map(known.__getitem__, segments(marked(text)))) if text else 0 for text in texts.to_pylist()]
                sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
                n = pa.array(counts, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), sizes, n, pc.greater(n, limit)], schema=out)
                if len(known) > REMEMBERED:
                    known.clear()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(source, counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
