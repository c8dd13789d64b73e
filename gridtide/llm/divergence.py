"""Audit of how far the sources of a language differ from each other, and in which terms.

Every (lang, source) group has a smoothed share of each term that the language keeps.  Two kinds of rows come
out: how far each other source of the language lies from a group, and the terms by which a group stands out of its
language.  All numbers are whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm.common import share_code, stored
from gridtide.llm.windows import joined_bytes

MIN_DOCS = 10
TOP = 10
UNIT = 1_000_000_000
_HELD_ROWS = 400_000  # counts or terms that a worker keeps before it passes them on
_CELLS = 2_000_000
_BLOCK = 256  # terms held against each other at once

_BYTES = np.arange(256)
_CAPITAL = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_LETTER = _CAPITAL | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
_LOWER = np.where(_CAPITAL, _BYTES + 32, _BYTES).astype(np.uint8)


def _terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of a chunk of texts in order, and the text of each: runs of letters, ASCII ones in lower case."""
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    inside = _LETTER[raw]
    edge = np.concatenate([[False], inside, [False]])
    starts = np.flatnonzero(inside & (~edge[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside & (~edge[2:] | cut[1:])) + 1
    places = np.concatenate([[0], np.cumsum(ends - starts)])
    kind, width = (pa.string(), np.int32) if places[-1] < 1 << 31 else (pa.large_string(), np.int64)
    data = _LOWER[raw[inside]]
    terms = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(places.astype(width)), pa.py_buffer(data)])
    return terms.cast(pa.string()), np.searchsorted(offsets, starts, side="right") - 1


def _sums(table: pa.Table) -> pa.Table:
    keys = ["lang", "source", "term"]
    # In one thread: each thread would hold groups of its own, on top of those of the other tasks.
    added = table.group_by(keys, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return added.rename_columns([name.removesuffix("_sum") for name in added.column_names]).select([*keys, "n", "docs"])


def _chunk_counts(batch: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray) -> pa.Table:
    """Occurrences and documents of every (lang, source, term) of a chunk; a group itself has the empty term."""
    terms, text = _terms(raw, offsets)
    coded = terms.dictionary_encode()
    size = max(1, len(coded.dictionary))
    lang, source = (batch.column(name).dictionary_encode() for name in ("lang", "source"))
    group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    in_text, times = np.unique(text * size + coded.indices.to_numpy(), return_counts=True)
    keys, inverse = np.unique(group[in_text // size] * size + in_text % size, return_inverse=True)
    groups = np.unique(group)
    all_groups = np.concatenate([keys // size, groups])
    names = pa.concat_arrays([coded.dictionary.take(pa.array(keys % size)), pa.array([""] * len(groups), pa.string())])
    nothing = np.zeros(len(groups), np.int64)
    # Sums of doubles are exact here: a chunk has far fewer than 2**53 terms.
    n = np.bincount(inverse, weights=times, minlength=len(keys)).astype(np.int64)
    docs = np.bincount(inverse, minlength=len(keys)).astype(np.int64)
    return pa.table(
        {
            "lang": lang.dictionary.take(pa.array(all_groups // len(source.dictionary))),
            "source": source.dictionary.take(pa.array(all_groups % len(source.dictionary))),
            "term": names,
            "n": np.concatenate([n, nothing]),
            "docs": np.concatenate([docs, nothing]),
        }
    )


def counted_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of each chunk added up, passed on past ``_HELD_ROWS`` sums; at most twice as many rows and a chunk's are held."""
    held: list[pa.Table] = []
    for batch, raw, offsets in joined_bytes(batches):
        held.append(_chunk_counts(batch, raw, offsets))
        if sum(table.num_rows for table in held) > 2 * _HELD_ROWS:
            held = [_sums(pa.concat_tables(held))]
            if held[0].num_rows > _HELD_ROWS:
                yield from held.pop().to_batches(100_000)
    if held:
        yield from _sums(pa.concat_tables(held)).to_batches(100_000)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences), ``docs`` (rows with the term) of every group.

    Each group also has one row of the empty term.  A worker adds up what it reads before anything moves.
    """
    share_code(docs.sparkSession)
    named = docs.select(*[F.coalesce(F.col(old), F.lit("")).alias(new) for old, new in ((lang, "lang"), (source, "source"), (text, "text"))])
    rows = named.mapInArrow(counted_chunks, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column) -> Column:
    """``1 + floor(UNIT * (count + 2) / total)`` in decimals, which have room for any count."""
    part = (count + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", part, total.cast("decimal(20,0)")) + 1


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """``_share`` of arrays by long division in steps of three digits: exact below 2**53, as no share is over 1."""
    rest, out = counts + 2, 0
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, totals)
        out = out * 1000 + digits
    return out + 1


def pair_sums(counted: DataFrame) -> DataFrame:
    """``lang``, ``i``, ``j``, ``value`` for pairs of groups with i < j, summed over the terms of ``counted``.

    ``counted`` has a row per kept term: ``lang``, ``entries`` (group number and count, where there is one) and ``totals``,
    one for every group of the language.  Workers add up blocks of terms, so no row per term and pair is made.
    """
    schema = "lang string, i int, j int, value long"

    def told(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, table in sums.items():
            i, j = np.triu_indices(len(table), 1)
            arrays = [pa.array([lang] * len(i), pa.string()), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(table[i, j])]
            yield from pa.Table.from_arrays(arrays, names=["lang", "i", "j", "value"]).to_batches(100_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                rows = np.flatnonzero(langs.indices.to_numpy() == code)
                totals = np.array(batch.column("totals")[int(rows[0])].as_py(), np.int64)
                size = len(totals)
                table = sums.setdefault(lang, np.zeros((size, size), np.int64))
                step = max(1, _CELLS // size)
                for first in range(0, len(rows), step):
                    entries = batch.column("entries").take(pa.array(rows[first : first + step]))
                    at = np.repeat(np.arange(len(entries)), pc.list_value_length(entries).to_numpy())
                    flat = entries.flatten()
                    counts = np.zeros((len(entries), size), np.int64)
                    counts[at, flat.field("i").to_numpy()] = flat.field("n").to_numpy()
                    shares = _shares(counts, totals)
                    for i in range(size - 1):
                        p, q = shares[:, i : i + 1], shares[:, i + 1 :]
                        table[i, i + 1 :] += ((p - q) * (p - q) // (p + q)).sum(axis=0)
            if sum(table.size for table in sums.values()) > _CELLS:
                yield from told(sums)
                sums = {}
        yield from told(sums)

    return counted.mapInArrow(run, schema).groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def undominated(n: np.ndarray, total: np.ndarray, terms: list[bytes], k: int) -> np.ndarray:
    """Places of the terms that fewer than ``k`` others dominate: the k-skyband.

    A term dominates another if its group count is not lower, its total not higher, and its bytes come earlier.
    In the order by these three every dominator comes before; of the dominators of a term, the first k are
    in the skyband themselves, so it is enough to hold each term against the skyband so far and its own block.
    """
    rank = np.empty(len(terms), np.int64)
    rank[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
    order = np.lexsort((rank, total, -n))
    kept = np.zeros(0, np.int64)
    for first in range(0, len(order), _BLOCK):
        block = order[first : first + _BLOCK]
        before = (total[kept][:, None] <= total[block]) & (rank[kept][:, None] < rank[block])
        beside = (total[block][:, None] <= total[block]) & (rank[block][:, None] < rank[block])
        # The block is in order, so only places above the diagonal have a count that is not lower.
        count = before.sum(axis=0) + np.triu(beside, 1).sum(axis=0)
        kept = np.concatenate([kept, block[count < k]])
    return kept


def skybands(rows: DataFrame, k: int) -> DataFrame:
    """The rows of each (lang, source) that fewer than ``k`` others of the same task dominate.

    A worker holds one skyband for each group; past a bound it passes them on, which only leaves more to the merge.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], pa.Table] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            lang, source = (batch.column(name).dictionary_encode() for name in ("lang", "source"))
            code = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
                own = table.take(pa.array(part))
                key = (own["lang"][0].as_py(), own["source"][0].as_py())
                own = pa.concat_tables([held[key], own]) if key in held else own
                columns = [own[name].to_numpy() for name in ("n", "total")]
                kept = undominated(*columns, own["term"].cast(pa.binary()).to_pylist(), k)
                held[key] = own.take(pa.array(kept)).combine_chunks()
            if sum(part.num_rows for part in held.values()) > _HELD_ROWS:
                for part in held.values():
                    yield from part.to_batches()
                held = {}
        for part in held.values():
            yield from part.to_batches()

    return rows.mapInArrow(run, rows.schema)


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` of every group of rows with one lang and source.

    Part ``pair`` ranks the other sources of the lang by their distance over all terms in ``min_docs`` rows of the
    lang or more.  Part ``term`` has the ``top`` terms whose share in the group lies furthest above that in the lang:
    partitions keep their skybands by group count, lang count and UTF-8 order, in which a term's value can only
    grow; these are merged and the rest is ranked.

    A null text, lang or source is the empty string, and an empty one a name like others.  Repeated rows each count.
    A lang without kept terms gives pairs of distance 0, a lang of one source no pairs, an empty table no rows.
    Other columns are not read, whatever their names.
    """
    counts = stored(term_counts(docs, text, lang, source), "terms")
    by_term = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    kept = stored(by_term.where(F.col("docs") >= min_docs).select("lang", "term", "total"), "kept")
    rows = stored(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "counted")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_n"))
    sums = rows.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = counts.where("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["group_n", "terms", "lang_n"]).withColumns(
        {
            "i": number,
            "group_total": F.col("group_n") + 2 * F.col("terms"),
            "lang_total": F.col("lang_n") + 2 * F.col("terms"),
        }
    )
    groups = stored(groups.select("lang", "source", "i", "terms", "group_total", "lang_total"), "groups")
    return _pairs(rows, groups).unionByName(_standing_out(rows, groups, top))


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    # One entry for each source of a lang: the result has as many rows squared.
    of_lang = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "group_total")))["group_total"].alias("totals"))
    numbered = rows.join(groups.select("lang", "source", "i"), ["lang", "source"])
    by_term = numbered.groupBy("lang", "term").agg(F.collect_list(F.struct("i", "n")).alias("entries"))
    found = pair_sums(by_term.join(of_lang, "lang").select("lang", "entries", "totals"))
    both = found.unionByName(found.select("lang", F.col("j").alias("i"), F.col("i").alias("j"), "value"))
    size = F.count(F.lit(1)).over(Window.partitionBy("lang"))
    every = groups.withColumn("size", size).select("lang", "i", F.explode(F.sequence(F.lit(0), (F.col("size") - 1).cast("int"))).alias("j"))
    every = every.where("i <> j").withColumn("value", F.lit(0).cast("long"))
    pairs = both.unionByName(every).groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "i", "source")
    others = groups.select("lang", F.col("i").alias("j"), F.col("source").alias("item"))
    return _ranked(pairs.join(names, ["lang", "i"]).join(others, ["lang", "j"]), "pair")


def _standing_out(rows: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    shared = rows.join(groups, ["lang", "source"])
    p, q = _share(F.col("n"), F.col("group_total")), _share(F.col("total"), F.col("lang_total"))
    above = shared.withColumns({"p": p, "q": q}).where(F.col("p") > F.col("q"))
    valued = above.select("lang", "source", "term", "n", "total", _apart(F.col("p"), F.col("q")).alias("value"))
    merged = skybands(skybands(valued, top).repartition("lang", "source"), top)
    return _ranked(merged.withColumnRenamed("term", "item"), "term").where(F.col("rank") <= top)


def _ranked(items: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return items.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
