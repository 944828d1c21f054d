"""SentencePiece encoding and decoding with a table of distinct chunks.

With a vocabulary in which no piece continues past a white-space marker, merges
never cross the start of a marked word. A text is therefore a sequence of
chunks (markers and the word after them) that segment independently: every
distinct chunk of a task is segmented once, and the ids of a text are gathered
from the table by the position of its chunks.

The table lives in the task and starts anew once it holds ``TABLE_CHUNKS``
chunks or ``TABLE_CHARS`` characters, so memory is bounded and no shuffle is
needed; a restart changes no result. A null text counts as an empty one.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of a task's table. They say when it starts anew and do not change results.
TABLE_CHUNKS, TABLE_CHARS = 200_000, 16_000_000
_MARKER = "▁"
_CHUNK = re.compile(" +[^ ]*")


class Chunks(dict):
    """Distinct chunks, without their first marker, numbered in order of arrival; their ids side by side in ``pool``."""

    def __init__(self, model: str):
        import sentencepiece

        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.marker, self.end = self.model.piece_to_id(_MARKER), self.model.eos_id()
        self.restart()

    def restart(self) -> None:
        self.clear()
        self.waiting: list[str] = []
        self.chars = 0
        self.starts, self.sizes, self.pool, self.used = (np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.int32), 0)
        self.known = 0
        # A lone marker at the end of a text is its own piece; the end id closes every text.
        self[""], self[None] = 0, 1
        self._add([[self.marker], [self.end]])

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.waiting.append(chunk)
        self.chars += len(chunk)
        return number

    def _add(self, ids: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for some in ids for i in some), np.int32, int(sizes.sum()))
        self.pool, self.starts, self.sizes = (
            _room(self.pool, self.used + len(flat)), _room(self.starts, self.known + len(ids)), _room(self.sizes, self.known + len(ids)),
        )
        self.pool[self.used : self.used + len(flat)] = flat
        self.starts[self.known : self.known + len(ids)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[self.known : self.known + len(ids)] = sizes
        self.used += len(flat)
        self.known += len(ids)

    def numbers(self, text: str, end: bool) -> np.ndarray:
        """The chunk numbers of a text, in order."""
        if not text:
            return np.ones(int(end), np.int64)
        text = text.replace(_MARKER, " ")
        words = text.split(" ")
        if "" in words:  # runs of markers belong to the chunk they lead
            words = [chunk[1:] for chunk in _CHUNK.findall(" " + text)]
        if end:
            words.append(None)
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def encode(self, texts: list[str], end: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts side by side, and where each text's ids begin."""
        if len(self) > TABLE_CHUNKS or self.chars > TABLE_CHARS:
            self.restart()
        numbers = [self.numbers(text, end) for text in texts]
        if self.waiting:
            self._add(self.model.encode(self.waiting))
            self.waiting = []
        chunks = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        sizes = self.sizes[chunks]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(self.starts[chunks] - (ends - sizes), sizes) + np.arange(total)]
        upto = np.concatenate(([0], ends))
        return ids, upto[np.concatenate(([0], np.cumsum([len(n) for n in numbers], dtype=np.int64)))]


def _room(values: np.ndarray, wanted: int) -> np.ndarray:
    if wanted <= len(values):
        return values
    larger = np.zeros(max(wanted, 2 * len(values)), values.dtype)
    larger[: len(values)] = values
    return larger


@lru_cache(maxsize=4)
def _table(model: str) -> Chunks:
    return Chunks(model)


@lru_cache(maxsize=4)
def check(model: str) -> None:
    """Refuse a vocabulary for which chunks would not be independent."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    size = pieces.get_piece_size()
    if any(_MARKER in pieces.id_to_piece(i).lstrip(_MARKER) for i in range(size)):
        raise ValueError("a piece continues past a white-space marker, so chunks are not independent")
    if pieces.normalize("  ﬁ  x ") != f"{_MARKER * 3}ﬁ{_MARKER * 2}x{_MARKER}":
        raise ValueError("only vocabularies that leave text as it is and put a marker first are supported")


#: Characters handed to the table at a time, so that a batch of long texts stays small.
_PORTION = 2_000_000


def _portions(texts: list[str]):
    begin = chars = 0
    for i, text in enumerate(texts):
        chars += len(text)
        if chars > _PORTION:
            yield texts[begin : i + 1]
            begin, chars = i + 1, 0
    yield texts[begin:]


def encode(text: Column, model: str, end: bool = True) -> Column:
    """Ids of a text as the library gives them, ``array<int>``, with the end id last if asked for.

    Null and empty texts give the end id alone. White space of any kind, the
    marker itself, control characters and texts of any length are encoded whole.
    """
    check(model)

    @F.arrow_udf("array<int>")
    def ids(batch):
        import pyarrow as pa

        table, flat, bounds = _table(model), [], [np.zeros(1, np.int64)]
        for part in _portions(batch.fill_null("").to_pylist()):
            some, upto = table.encode(part, end)
            flat.append(some)
            bounds.append(upto[1:] + bounds[-1][-1])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(bounds).astype(np.int32)), pa.array(np.concatenate(flat)))

    return ids(text)


def decode(ids: Column, model: str) -> Column:
    """Text of an ``array<int>`` of ids, by the library; null and empty lists give an empty text."""

    @F.arrow_udf("string")
    def texts(batch):
        import pyarrow as pa

        decoder = _table(model).model
        bounds, values = batch.offsets.to_numpy(), batch.values.to_numpy()
        null = batch.is_null().to_numpy(zero_copy_only=False)
        return pa.array(
            ["" if null[i] else decoder.decode(values[bounds[i] : bounds[i + 1]].tolist()) for i in range(len(batch))],
            pa.string(),
        )

    return texts(ids)


def encoded(docs: DataFrame, model: str, text: str = "text", into: str = "ids", end: bool = True) -> DataFrame:
    """``docs`` with the ids of ``text`` in a column ``into``."""
    return docs.withColumn(into, encode(F.col(text), model, end))


def digests(docs: DataFrame, model: str) -> DataFrame:
    """Per document the number of ids and digests of the ids and of the text they decode to.

    Repeated rows give repeated rows; a null ``doc_id`` stays null; other columns are not read.
    """
    own = docs.select("doc_id", encode(F.col("text"), model).alias("ids"))
    return own.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), model), 256).alias("decoded_sha256"),
    )
