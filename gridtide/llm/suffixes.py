"""Removal of byte strings that occur twice, by suffix order built column by column.

Every place of a text that matters is reached from an anchor, a place chosen by its content.  Around
anchors that occur more than once, the texts are cut into strings that are aligned at the anchor; equal
200-byte strings then lie in the same columns.  Strings equal as a whole are settled by their digest, and one of
them goes on.  A collection of such strings is put in suffix order one column per round, from the right: one symbol per string is inserted in front of all suffixes, and order
and common prefixes follow from those of the round before.  An anchor with more strings than a
collection holds is made longer, level by level, and its strings fall into smaller classes.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import discard, release, stored
from gridtide.llm.windows import beside, bucketed_texts, first_copies, joined_bytes, representatives, rolling, runs_of

LENGTH = 200
ANCHOR = 50
MOST = 4_000  # strings in one class, and in one collection before its last class


class Anchors:
    """Anchor of every whole string of ``length`` bytes in a chunk of texts."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, length: int, anchor: int):
        self.hashes = rolling(0).windows(rolling(0).table[raw], anchor)
        place = np.arange(max(0, len(raw) - length + 1))
        text = np.searchsorted(offsets, place, side="right") - 1
        self.whole = place[place + length <= offsets[text + 1]]
        chosen = representatives(self.hashes, length - anchor + 1)
        self.chosen = chosen[self.whole] if len(self.whole) else self.whole


def _anchor_table(texts: DataFrame, notes: DataFrame, length: int, anchor: int) -> DataFrame:
    """``hash`` of every anchor and where its whole strings lie: ``row``, ``start``, ``lead``, ``size``.

    ``start`` is the place of their first byte in the text, ``lead`` the number of bytes before the anchor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offsets in joined_bytes(batches):
            found = Anchors(raw, offsets, length, anchor)
            # Strings of one anchor start at neighbouring places.
            first = np.flatnonzero(np.diff(found.chosen, prepend=-1))
            last = np.append(first, len(found.chosen))[1:] - 1
            places, starts = found.chosen[first], found.whole[first]
            text = np.searchsorted(offsets, places, side="right") - 1
            rows = batch.column("row").to_numpy()[text]
            columns = [found.hashes[places].view(np.int64), rows, starts - offsets[text]]
            columns += [(places - starts).astype(np.int32), (found.whole[last] - starts + length).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=["hash", "row", "start", "lead", "size"])

    return beside(texts, notes).select("row", "text").mapInArrow(run, "hash long, row long, start long, lead int, size int")


def _strings(texts: DataFrame, places: DataFrame, told: Callable[[memoryview], bytes], name: str) -> DataFrame:
    """``places`` of whole strings (``hash``, ``row``, ``start``, ``lead``, ``size``, ``times``) with what is ``told`` of their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offsets in joined_bytes(batches):
            lengths = pc.list_value_length(batch.column("places")).to_numpy()
            flat = batch.column("places").flatten()
            fields = [pc.struct_field(flat, field) for field in ("hash", "start", "lead", "size", "times")]
            begin = np.repeat(offsets[:-1], lengths) + fields[1].to_numpy()
            end = begin + fields[3].to_numpy()
            data = memoryview(raw)
            values = pa.array([told(data[low:high]) for low, high in zip(begin.tolist(), end.tolist())], pa.binary())
            rows = pa.array(np.repeat(batch.column("row").to_numpy(), lengths))
            yield pa.RecordBatch.from_arrays([rows, *fields, values], names=["row", "hash", "start", "lead", "size", "times", name])

    # Bounded by the bytes of one text.
    of_row = places.groupBy("row").agg(F.collect_list(F.struct("hash", "start", "lead", "size", "times")).alias("places"))
    rows = beside(texts, of_row).select("row", "text", "places")
    return rows.mapInArrow(run, f"row long, hash long, start long, lead int, size int, times long, {name} binary")


def _digest(data: memoryview) -> bytes:
    return sha256(data).digest()


def _least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of ``values[low:high]`` for every pair, from tables of minima over powers of two."""
    tables = [values]
    while 2 << (len(tables) - 1) <= len(values):
        step = 1 << (len(tables) - 1)
        tables.append(np.minimum(tables[-1][:-step], tables[-1][step:]))
    level = np.frexp((high - low).astype(float))[1] - 1
    out = np.empty(len(low), values.dtype)
    for number, table in enumerate(tables):
        picked = np.flatnonzero(level == number)
        out[picked] = np.minimum(table[low[picked]], table[high[picked] - (1 << number)])
    return out


def repeated_columns(strings: list[bytes], leads: np.ndarray, length: int) -> np.ndarray:
    """For every string, by column from its first byte, whether its ``length`` bytes occur in another one.

    The strings are aligned at their anchors.  Their columns are laid down in a file and read back one
    per round, last column first.  A round sorts all suffixes stably by the inserted symbol; neighbours
    with the same symbol share one byte more than the least common prefix between them a round ago.
    """
    count = len(strings)
    sizes = np.array([len(string) for string in strings])
    shift = int(leads.max()) - leads
    width = int((shift + sizes).max())
    table = np.zeros((count, width), np.uint16)  # 0: no byte here, else byte + 1
    column = np.arange(width)
    inside = (column >= shift[:, None]) & (column < (shift + sizes)[:, None])
    table[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
    found = np.zeros((count, width), bool)
    with tempfile.TemporaryFile() as file:
        np.ascontiguousarray(table.T[::-1]).tofile(file)
        file.seek(0)
        order = np.arange(count)
        shared = np.zeros(count, np.int16)  # common prefix with the suffix before it in the order
        for place in range(width - 1, -1, -1):
            symbols = np.fromfile(file, np.uint16, count)[order]
            moved = np.argsort(symbols, kind="stable")
            symbols = symbols[moved]
            alike = np.flatnonzero((symbols[1:] == symbols[:-1]) & (symbols[1:] > 0)) + 1
            after = np.zeros(count, np.int16)
            if len(alike):
                after[alike] = np.minimum(_least_between(shared, moved[alike - 1] + 1, moved[alike] + 1) + 1, length)
            order, shared = order[moved], after
            full = np.flatnonzero(shared >= length)
            found[order[full], place] = True
            found[order[full - 1], place] = True
    return found


def _collections(strings: DataFrame, length: int, most: int) -> DataFrame:
    """``row``, ``low``, ``high``: runs of starts whose strings occur elsewhere, for classes of at most ``most`` strings."""

    def settle(parts: list[tuple]) -> pa.RecordBatch:
        rows, starts, leads, data = zip(*parts)
        leads = np.array(leads)
        found = repeated_columns(list(data), leads, length)
        out = []
        shift = int(leads.max()) - leads
        for item in np.flatnonzero(found.any(axis=1)).tolist():
            base = starts[item] - int(shift[item])
            out += [(rows[item], base + low, base + high) for low, high in runs_of(np.flatnonzero(found[item]))]
        arrays = [pa.array([row[side] for row in out], pa.int64()) for side in range(3)]
        return pa.RecordBatch.from_arrays(arrays, names=["row", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("hash", "row", "start", "lead", "data")]
            for key, *values in zip(*columns):
                if len(held) >= most and key != last:
                    yield settle(held)
                    held = []
                held.append(tuple(values))
                last = key
        if held:
            yield settle(held)

    dealt = strings.repartition("hash").sortWithinPartitions("hash", "row", "start")
    return dealt.mapInArrow(run, "row long, low long, high long")


def _pieces(strings: DataFrame, length: int) -> DataFrame:
    """Strings of crowded anchors cut in two, each half under a longer anchor.

    A whole string with ``k`` bytes before its anchor also holds every longer anchor that reaches at most ``k`` bytes back and
    ``length - anchor - k`` on.  The range ``least`` to ``most`` of ``k`` is halved; the whole strings of a half have
    ``length - (most - least)`` bytes in common places, and those are its anchor.
    """
    middle = F.floor((F.col("least") + F.col("most")) / 2).cast("int")
    halves = F.array(
        F.struct("least", middle.alias("most")),
        F.struct((middle + 1).alias("least"), "most"),
    )
    size = F.octet_length("data")
    before = F.least("half.most", "lead")
    fewest = F.greatest("half.least", F.col("lead") - (size - length))
    cut = (
        strings.withColumn("half", F.explode(F.when(F.col("least") < F.col("most"), halves).otherwise(F.array())))
        .withColumns({"before": before, "fewest": fewest})
        .where("fewest <= before")
        .select(
            "row",
            (F.col("start") + F.col("lead") - F.col("before")).alias("start"),
            F.col("before").alias("lead"),
            F.substring("data", F.col("lead") - F.col("before") + 1, F.col("before") - F.col("fewest") + length).alias("data"),
            "half.least",
            "half.most",
        )
    )
    own = F.substring("data", F.col("lead") - F.col("least") + 1, F.lit(length) - (F.col("most") - F.col("least")))
    return cut.withColumn("hash", F.xxhash64(own, "least", "most"))


def _settled(texts: DataFrame, anchors: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """``strings`` that differ from others of their anchor, one of equal ones, and runs already known.

    Equal strings of an anchor occur elsewhere at every start, which settles all but one; a string then alone is dropped.
    Only places and digests move for that, and the bytes of a string are cut out once, however many texts hold it.
    """
    # Stored first: a join of two plain shuffles lets Spark split an anchor that very many rows hold.
    counted = stored(anchors.groupBy("hash").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "twice")
    # A digest, as strings of one anchor differ in few bytes or none.
    contexts = stored(_strings(texts, anchors.join(counted, "hash"), _digest, "same").drop("times"), "contexts")
    discard(anchors)
    del counted
    release(texts.sparkSession)
    keys = ["hash", "lead", "same"]
    first = F.min(F.struct("row", "start", "size")).alias("first")
    groups = stored(contexts.groupBy(keys).agg(F.count(F.lit(1)).alias("copies"), first), "groups")
    copied = contexts.join(groups.where("copies > 1").select(keys), keys)
    runs = stored(copied.selectExpr("row", "start AS low", f"start + size - {length} AS high"), "copied")
    discard(contexts)
    classes = stored(groups.groupBy("hash").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "classes")
    ones = groups.join(classes, "hash").select("hash", "first.row", "first.start", "lead", "first.size", "times")
    strings = stored(_strings(texts, ones, bytes, "data").drop("size"), "strings")
    return strings, runs


def _small_classes(strings: DataFrame, length: int, anchor: int, most: int) -> tuple[DataFrame | None, DataFrame]:
    """Classes of at most ``most`` strings for ``_collections``, from anchors with more, and runs already known.

    Level by level, the strings left of a class that is too large get longer anchors, and equal ones of a new class are
    settled like those of an anchor.  After the last level an anchor is a whole string, of which one is left.  A level makes
    at most two rows of each string that is left.
    """
    settled, runs = None, strings.selectExpr("row", "start AS low", "start AS high").limit(0)
    whole = strings.select("hash", "row", "start", "lead", "data", F.lit(0).alias("least"), F.lit(length - anchor).alias("most"))
    level = stored(_pieces(whole, length), "pieces")
    while not level.isEmpty():
        told = level.withColumn("same", F.unhex(F.sha2(F.concat(F.encode(F.concat("lead", F.lit(":")), "UTF-8"), "data"), 256)))
        groups = told.groupBy("hash", "same").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("row", "start")).alias("first"))
        told = told.join(stored(groups, "groups"), ["hash", "same"])
        high = F.col("start") + F.octet_length("data") - length
        runs = runs.unionByName(told.where("copies > 1").select("row", F.col("start").alias("low"), high.alias("high")))
        ones = stored(told.where(F.struct("row", "start") == F.col("first")).drop("same", "copies", "first"), "ones")
        counted = stored(ones.groupBy("hash").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "classes")
        classes = ones.join(counted, "hash")
        few = classes.where(F.col("times") <= most).select("hash", "row", "start", "lead", "data")
        settled = few if settled is None else settled.unionByName(few)
        level = stored(_pieces(classes.where(F.col("times") > most), length), "pieces")
    return settled, runs


def repeated_strings(texts: DataFrame, firsts: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, most: int = MOST) -> DataFrame:
    """``row``, ``runs`` (of starts, first and last) of strings of ``length`` bytes that start elsewhere too."""
    anchors = stored(_anchor_table(texts, firsts.where("first").select("row"), length, anchor), "anchors")
    strings, runs = _settled(texts, anchors, length)
    release(texts.sparkSession)
    classes = strings.where(F.col("times") <= most).select("hash", "row", "start", "lead", "data")
    small, more = _small_classes(strings.where(F.col("times") > most), length, anchor, most)
    found = _collections(classes if small is None else classes.unionByName(small), length, most).unionByName(runs).unionByName(more)
    # Bounded by the bytes of one text.
    return stored(found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("runs")), "runs")


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, most: int = MOST
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the bytes that stay) of every row.

    A byte of the UTF-8 text goes if a string of ``length`` bytes that covers it starts anywhere else, in the same
    row or another.  Copies of a whole text are settled by their digest, one of them stands for all.  Anchors with
    over ``most`` places are made longer until no class of strings has more, so no task holds more than that many of one.

    A null text is empty.  Rows that repeat an id, and rows without one, are documents like others.  An empty
    table gives no rows; other columns are not read.
    """
    texts = bucketed_texts(docs, doc_id, text)
    firsts = stored(first_copies(texts), "copies")
    repeated = repeated_strings(texts, firsts, length, min(anchor, length), most)
    # Rows that copy another take the runs of none: all of their bytes are repeated, if they are long enough.
    notes = firsts.select("row", "copies").join(repeated, "row", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offsets in joined_bytes(batches):
            out = []
            for low, high, copies, runs in zip(
                offsets[:-1].tolist(), offsets[1:].tolist(), batch.column("copies").to_pylist(), batch.column("runs").to_pylist()
            ):
                size = high - low
                spans: list[list[int]] = []
                found = [(0, size - length)] if copies > 1 and size >= length else [(r["low"], r["high"]) for r in runs or ()]
                for first, last in found:
                    if spans and first <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], last + length)
                    else:
                        spans.append([first, last + length])
                data, kept, end = raw[low:high].tobytes(), [], 0
                for first, last in spans:
                    kept.append(data[end:first])
                    end = last
                kept.append(data[end:])
                out.append((size, sum(last - first for first, last in spans), len(spans), b"".join(kept)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array([row[side] for row in out], kind) for side, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    rows = beside(texts, notes).select("doc_id", "text", "copies", "runs")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
