"""Removal of word windows that occur earlier in the corpus, by level-wise doubling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import discard, release, stored
from gridtide.llm.windows import beside, bucketed_texts, first_copies, joined_bytes, representatives, rolling

WINDOW = 20
FIRST = 5
LONG_WORD = 256  # bytes
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def levels(window: int = WINDOW, first: int = FIRST) -> list[int]:
    """``first``, twice that and so on, and the window itself."""
    out = [min(first, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


class WordHashes:
    """Hashes of all words of a chunk of texts, and the places where whole windows start."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, window: int):
        blank = _BLANK[raw]
        cut = np.zeros(len(raw) + 1, bool)
        cut[offsets] = True
        inside = ~blank
        before = np.concatenate([[False], inside[:-1]]) if len(raw) else inside
        self.starts = np.flatnonzero(inside & (~before | cut[:-1]))
        after = np.concatenate([inside[1:], [False]]) if len(raw) else inside
        self.ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        self.raw, self.window = raw, window
        self.bounds = np.searchsorted(self.starts, offsets)  # first word of every text
        text = np.searchsorted(self.bounds, np.arange(len(self.starts)), side="right") - 1
        last = np.arange(len(self.starts)) + window
        self.whole = np.flatnonzero(last <= self.bounds[text + 1]) if len(self.starts) else self.starts
        self.text = text

    def words(self, stream: int) -> np.ndarray:
        own = rolling(stream)
        out = own.runs(own.prefix(own.table[self.raw]), self.starts, self.ends)
        # A polynomial modulo 2**64 meets itself in patterns of 1,024 symbols and more, whatever its base.
        for place in np.flatnonzero(self.ends - self.starts > LONG_WORD):
            out[place] = xxhash.xxh64_intdigest(self.raw[self.starts[place] : self.ends[place]].tobytes(), stream)
        return out

    def chosen(self, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows of ``size`` words, and which of them stands for each whole window."""
        hashes = rolling(0).windows(words, size)
        if not len(self.whole):
            return hashes, self.whole
        return hashes, representatives(hashes, self.window - size + 1)[self.whole]


def _survivors(found: WordHashes, words: np.ndarray, size: int | None, alive: list[np.ndarray | None]) -> np.ndarray:
    """Whether each whole window is still a candidate: its window of ``size`` words is alive in its text."""
    if size is None:
        return np.ones(len(found.whole), bool)
    mask = np.zeros(len(found.starts) + 1, bool)
    for first, places in zip(found.bounds, alive):
        if places is not None:
            mask[first + places] = True
    return mask[found.chosen(words, size)[1]]


def _candidates(texts: DataFrame, notes: DataFrame, window: int, size: int, shorter: int | None) -> DataFrame:
    """``hash``, ``more``, ``row``, ``doc_id``, ``place`` of the windows of ``size`` words that stand for candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offsets in joined_bytes(batches):
            found = WordHashes(raw, offsets, window)
            words = found.words(0)
            alive = [item.values.to_numpy() for item in batch.column("alive")] if shorter else []
            held = _survivors(found, words, shorter, alive)
            hashes, places = found.chosen(words, size)
            places = np.unique(places[held]) if len(places) else places
            second = rolling(1).windows(found.words(1), size)[places] if size == window else hashes[places]
            text = found.text[places]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[places].view(np.int64)),
                    pa.array(second.view(np.int64)),
                    batch.column("row").take(pa.array(text)),
                    batch.column("doc_id").take(pa.array(text)),
                    pa.array((places - found.bounds[text]).astype(np.int32)),
                ],
                names=["hash", "more", "row", "doc_id", "place"],
            )

    columns = ["row", "doc_id", "text", *(["alive"] if shorter else [])]
    rows = beside(texts, notes).select(*columns)
    return rows.mapInArrow(run, "hash long, more long, row long, doc_id long, place int")


def repeated_windows(texts: DataFrame, firsts: DataFrame, window: int = WINDOW, first: int = FIRST) -> DataFrame:
    """``row``, ``places``: starts of windows whose words also start earlier, at a smaller (id, row, place).

    Level by level: at each length, every whole window still in question is stood for by the one of its
    shorter windows with the smallest hash.  Equal windows choose alike, so a window can only be
    repeated if its representative is.  Those that occur twice go on at twice the length; at the full
    length each window stands for itself, under 128 bits.
    """
    notes, shorter = firsts.where("first").select("row"), None
    for size in levels(window, first):
        found = stored(_candidates(texts, notes, window, size, shorter), "windows")
        counted = found.groupBy("hash", "more").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "row", "place")).alias("first"))
        # Stored first: a join of two plain shuffles lets Spark split a window that very many rows hold.
        twice = stored(counted.where("times > 1").select("hash", "more", "first.row", "first.place"), "twice")
        twice = twice.withColumnsRenamed({"row": "first_row", "place": "first_place"})
        again = found.join(twice, ["hash", "more"])
        if size == window:
            again = again.where("row <> first_row OR place <> first_place")
        # Bounded by the words of one text.
        grouped = stored(again.groupBy("row").agg(F.sort_array(F.collect_list("place")).alias("alive")), "alive")
        discard(found)
        discard(twice)
        del counted, again
        release(texts.sparkSession)
        notes, shorter = grouped, size
    return notes.withColumnRenamed("alive", "places")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, first: int = FIRST) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (the words that stay, joined by one space) of every row.

    A word goes if any window of ``window`` words that covers it starts earlier: in a row with a smaller id, or
    earlier in its own.  Copies of a whole text are settled by their digest and stand aside from the
    levels.

    A null text is empty.  Rows that repeat an id are documents of their own, in the order of the input; a null id
    comes before all others.  An empty table gives no rows; other columns are not read.
    """
    texts = bucketed_texts(docs, doc_id, text)
    firsts = stored(first_copies(texts), "copies")
    repeated = repeated_windows(texts, firsts, window, first)
    notes = firsts.select("row", "first").join(repeated, "row", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offsets in joined_bytes(batches):
            rows = []
            whole = batch.column("text").to_pylist()
            for value, is_first, places in zip(whole, batch.column("first").to_pylist(), batch.column("places")):
                words = value.encode().split()  # bytes split at exactly 0x20 and 0x09-0x0D
                n = len(words)
                gone = np.zeros(n + 1, np.int64)
                if not is_first and n >= window:
                    gone[:n] = 1
                elif places.is_valid:
                    starts = places.values.to_numpy()
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, starts + window, -1)
                    gone = np.cumsum(gone)
                kept = [word for word, flag in zip(words, gone.tolist()) if not flag]
                rows.append((n, n - len(kept), b" ".join(kept).decode()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([row[0] for row in rows], pa.int64()),
                    pa.array([row[1] for row in rows], pa.int64()),
                    pa.array([row[2] for row in rows], pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    rows = beside(texts, notes).select("doc_id", "text", "first", "places")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
