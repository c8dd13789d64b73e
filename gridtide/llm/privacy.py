"""Personal data in texts: four kinds by pattern, and words that reveal them by co-occurrence in whole texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import ROW_HASH, SPACE, row_hash, stored, whole_text
from gridtide.llm.components import components

KINDS = ("email", "ip", "card", "phone")

# The four patterns, written so that each character is tried a bounded number of times:
# runs are possessive, and a run is entered at its start or where the last match ended.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for its pattern to be worth a search.
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
_BYTE_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

_SPAN = "struct<start:bigint,end:bigint,value:string>"
MIN_TEXTS = 3
GENERALISE_AT = 0.7
REMOVE_AT = 0.9
LEAST_G = 24.0  # beyond chance at about one in a million
MOST_BITS = 22  # of a bitmap
SHINGLE = 5  # words
CELLS = 64  # of the sketch that tells whether two texts depend on each other
DEPENDENT = 0.4
_CHUNK = 1000  # characters that a replacement reads at once
_MASK = "\ua66e"  # a letter that texts do not hold
# Words of three letters or more, and of two that start with a capital or a letter without case, as names do.
TERM = r"\p{L}{3,}|(?<!\p{L})[\p{Lu}\p{Lt}\p{Lo}]\p{L}(?!\p{L})"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once, however often the body or a function in it asks for it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _doubling(values: Column, join: Callable[[Column, Column], Column], nothing: Column) -> Column:
    """For every place, ``join`` of all values up to it; each step takes in those that end 1, 2, 4, ... places before."""
    steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + 1)).cast("int")), lambda k: F.call_function("shiftleft", F.lit(1), k))

    def add(done: Column, step: Column) -> Column:
        return F.transform(done, lambda value, i: join(value, F.coalesce(F.get(done, i - step), nothing)))

    return F.aggregate(steps, values, add)


def _running(sizes: Column) -> Column:
    return _doubling(sizes, lambda total, before: total + before, F.lit(0).cast("long"))


def _placed(text: Column, pattern: str) -> Column:
    """Start, end and text of every match: lengths of matches and of the parts between them, summed up."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def sized(matches: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
        return F.zip_with(gaps, matches, lambda gap, match: (F.length(gap) + F.length(match)).cast("long"))

    def span(value: Column, end: Column) -> Column:
        return F.struct((end - F.length(value)).alias("start"), end.alias("end"), value.alias("value"))

    def spans(matches: Column) -> Column:
        return _let(sized(matches), lambda sizes: F.zip_with(matches, _running(sizes), span))

    return _let(found, lambda matches: F.when(F.size(matches) > 0, spans(matches)).otherwise(F.array().cast(f"array<{_SPAN}>")))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether every second digit from the right, doubled and cast out, makes a sum divisible by 10."""
    from_right = F.reverse(digits)

    def worth(place: Column) -> Column:
        digit = F.substr(from_right, place, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(place % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda total, n: total + n) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_BYTE_PART}(?:\.{_BYTE_PART}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _found(kind: str) -> Column:
    """Valid spans of one kind in ``_text``; leftmost, not overlapping, without retries."""
    there = F.col("_text").contains("@") if kind == "email" else F.col("_text").rlike(_HINTS[kind])
    spans = F.when(there, _placed(F.col("_text"), PATTERNS[kind])).otherwise(F.array().cast(f"array<{_SPAN}>"))
    return F.transform(
        F.filter(spans, lambda span: _holds(kind, span["value"])),
        lambda span: F.struct(
            span["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            span["end"].alias("end"),
            F.lit(kind).alias("kind"),
            span["value"].alias("value"),
        ),
    )


def _as_term(word: Column) -> Column:
    """Lower case; a word of two letters keeps its case, which is what makes it a term."""
    return F.when(F.length(word) < 3, word).otherwise(F.lower(word))


def _words() -> Column:
    """All words of ``_text`` that can be terms, in order."""
    return F.regexp_extract_all(F.col("_text"), F.lit(TERM), F.lit(0))


def _text_key(text: str) -> Column:
    """Stands for the text: half of its SHA-256."""
    return F.substr(F.unhex(F.sha2(text, 256)), F.lit(1), F.lit(16)).alias("text_key")


def with_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``ROW_HASH``, ``text_key`` and the base spans, per row."""
    source = docs.select(F.col(doc_id).alias("doc_id"), row_hash(text), whole_text(text).alias("_text"))
    spans = F.sort_array(F.concat(*[_found(kind) for kind in KINDS]))
    return source.select("doc_id", ROW_HASH, _text_key("_text"), spans.alias("base"))


def _bitmap(terms: DataFrame) -> list[int]:
    """Cells of 32 bits with the hash bits of ``terms`` set: eight bits or more for each term, up to ``MOST_BITS``.

    It only thins out what an exact join with the terms reads afterwards.
    """
    bits = min(MOST_BITS, max(12, (8 * terms.count()).bit_length()))
    bit = F.xxhash64("term").bitwiseAND(F.lit((1 << bits) - 1))
    cells = terms.select(F.shiftright(bit, 5).cast("int").alias("cell"), (bit % 32).cast("int").alias("bit")).distinct()
    # At most 2**MOST_BITS / 32 rows.
    set_bits = cells.groupBy("cell").agg(F.sum(F.expr("shiftleft(1L, bit)")).alias("mask")).collect()
    bitmap = [0] * (1 << (bits - 5))
    for row in set_bits:
        bitmap[row["cell"]] = row["mask"]
    return bitmap


def _passes(term: Column, bitmap: list[int]) -> Column:
    """Whether the hash bit of ``term`` is set."""
    cells = F.from_json(F.lit(str(bitmap)), "array<bigint>")
    bit = F.xxhash64(term).bitwiseAND(F.lit(32 * len(bitmap) - 1)).cast("int")
    cell = F.get(cells, F.shiftright(bit, 5))
    return F.call_function("shiftright", cell, bit.bitwiseAND(F.lit(31))).bitwiseAND(F.lit(1)) == 1


def _terms_of(words: Column) -> Column:
    return F.array_distinct(F.transform(words, _as_term))


def _sketch() -> Column:
    """Smallest hash of the text's shingles in each of ``CELLS`` parts of the hash range; null where there is none."""

    def hashes(words: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(words) - SHINGLE + 1, F.lit(1)))
        return F.transform(places, lambda place: F.xxhash64(F.slice(words, place, SHINGLE)))

    def least(found: Column) -> Column:
        parts = F.sequence(F.lit(0), F.lit(CELLS - 1))
        return F.transform(parts, lambda part: F.array_min(F.filter(found, lambda x: F.pmod(x, F.lit(CELLS)) == part)))

    words = F.regexp_extract_all(F.lower("_text"), F.lit(f"[^{SPACE}]+"), F.lit(0))
    return _let(words, lambda found: _let(hashes(found), least))


def _units(shared: DataFrame) -> DataFrame:
    """``text_key``, ``unit``: texts that took their words from each other are one observation, not several.

    Texts with an equal band of their sketches are held against the smallest of them, and linked if ``DEPENDENT`` of
    their sketches agree; linked texts are one unit.  A text that no band brings together with its like counts for itself.
    """
    nodes = shared.select(F.xxhash64("text_key").alias("node"), "sketch")
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(CELLS - 2), F.lit(2)),
        lambda i: F.when(F.get("sketch", i).isNotNull() | F.get("sketch", i + 1).isNotNull(), F.xxhash64(i, F.get("sketch", i), F.get("sketch", i + 1))),
    )
    banded = nodes.select("node", F.explode(F.array_compact(bands)).alias("band"))
    least = banded.groupBy("band").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("texts")).where("texts > 1")
    pairs = banded.join(least, "band").where("node <> least").select("node", "least").distinct()
    held = pairs.join(nodes, "node").join(nodes.select(F.col("node").alias("least"), F.col("sketch").alias("other")), "least")
    both = F.zip_with("sketch", "other", lambda x, y: F.when(x.isNotNull() | y.isNotNull(), F.coalesce(x == y, F.lit(False))))
    alike = F.size(F.filter(both, lambda same: same)) >= DEPENDENT * F.size(F.filter(both, lambda same: same.isNotNull()))
    roots = components(held.where(alike).select(F.col("node").alias("a"), F.col("least").alias("b")))
    unit = F.coalesce("root", F.xxhash64("text_key")).alias("unit")
    return shared.select("text_key").join(roots, F.xxhash64("text_key") == F.col("node"), "left").select("text_key", unit)


def _entities(base: str) -> Column:
    """The values of a text, and for an address also its domain."""
    values = F.transform(base, lambda span: F.concat_ws(":", span["kind"], F.lower(span["value"])))
    addresses = F.filter(base, lambda span: span["kind"] == "email")
    domains = F.transform(addresses, lambda span: F.concat(F.lit("domain:"), F.lower(F.substring_index(span["value"], "@", -1))))
    return F.array_distinct(F.concat(values, domains))


def _surprise(both: Column, one: Column, other: Column, total: Column) -> Column:
    """G statistic of the four counts of two events."""

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    rest = total - one - other + both
    return 2 * (
        part(both, one * other / total)
        + part(one - both, one * (total - other) / total)
        + part(other - both, other * (total - one) / total)
        + part(rest, (total - one) * (total - other) / total)
    )


def _document_counts(docs: DataFrame, terms: DataFrame, known: DataFrame, text: str) -> DataFrame:
    """``term``, ``df``: number of distinct texts other than ``known`` with each of ``terms``.

    A bitmap sized by the terms lets only likely words out of the scan, as one list per text.  Copies meet by the text's
    key; words are then counted in each task before they move, and the join leaves the exact terms.
    """
    bitmap = _bitmap(terms)
    likely = _terms_of(F.filter(_words(), lambda word: _passes(_as_term(word), bitmap)))
    lists = docs.select(whole_text(text).alias("_text")).select(_text_key("_text"), likely.alias("words"))
    # Without a filter on the lists, which would make Spark build them twice.
    texts = lists.dropDuplicates(["text_key"]).join(known, "text_key", "left_anti")
    counted = texts.select(F.explode("words").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counted.join(terms, "term")


def disclosing_terms(
    docs: DataFrame, marked: DataFrame, text: str = "text", min_texts: int = MIN_TEXTS, generalise_at: float = GENERALISE_AT
) -> DataFrame:
    """``entity``, ``term``, ``disclosure`` for words that reveal a protected value or the domain of an address.

    The disclosure is PMI(entity; term) / IC(entity), from counts of whole texts: 1 means that the term occurs only with
    the entity.  Equal texts count once, and texts with an entity that took their words from each other are one unit
    (see ``_units``), so a value and the rare words around it are not taken for related because they were copied
    together.  A pair in fewer than ``min_texts`` units, or whose G statistic is below ``LEAST_G``, gives no estimate.

    Words of the units that hold an entity of ``min_texts`` units or more are first held against a bound that needs no
    pairs; those that can still reach ``generalise_at`` are paired, counted in each task before they move, and held against
    it by their count in these units.  Only the terms of pairs that remain are counted in the whole corpus.
    """
    texts = marked.select("text_key").distinct().count()
    held = marked.where(F.size("base") > 0).select("text_key", F.explode(_entities("base")).alias("entity")).distinct()
    often = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_texts)
    held = stored(held.join(often.select("entity"), "entity"), "held")
    keys = stored(held.select("text_key").distinct(), "keys")
    source = docs.select(whole_text(text).alias("_text")).withColumn("text_key", _text_key("_text")).join(keys, "text_key", "left_semi")
    read = source.select("text_key", _terms_of(_words()).alias("words"), _sketch().alias("sketch"))
    shared = stored(read.dropDuplicates(["text_key"]), "shared")
    unit_of = stored(_units(shared), "units")
    known_texts, known_units = unit_of.agg(F.count(F.lit(1)), F.count_distinct("unit")).first()
    total = texts - known_texts + known_units
    count = F.lit(float(max(total, 1)))

    entities = held.join(unit_of, "text_key").select("unit", "entity").distinct()
    sizes = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("df_entity"))
    # An entity of all texts carries no information.
    sizes = sizes.where((F.col("df_entity") >= min_texts) & (F.col("df_entity") < total))
    known = entities.join(sizes, "entity").groupBy("unit").agg(F.collect_list(F.struct("entity", "df_entity")).alias("known"))
    known = known.withColumn("widest", F.array_max(F.transform("known", lambda item: item["df_entity"])))
    known = stored(known, "known")
    unit_terms = shared.join(unit_of, "text_key").select("unit", F.explode("words").alias("term")).distinct()
    unit_terms = stored(unit_terms, "unit_terms")

    def can_reach(df: str) -> Column:
        """The most a term of ``df`` texts can have: with the most frequent entity around it, ``widest``."""
        least = generalise_at * F.log(count / F.col("widest")) - 1e-9
        return (F.col(df) <= F.col("widest")) | (F.log(count / F.col(df)) >= least)

    near = unit_terms.join(known.select("unit", "widest"), "unit")
    around = near.groupBy("term").agg(F.count(F.lit(1)).alias("df_near"), F.max("widest").alias("widest"))
    possible = around.where((F.col("df_near") >= min_texts) & can_reach("df_near")).select("term", "df_near")
    pairs = unit_terms.join(possible, "term").join(known, "unit").select("term", "df_near", F.explode("known").alias("item"))
    pairs = pairs.select("term", "df_near", "item.*").groupBy("entity", "df_entity", "term", "df_near").agg(F.count(F.lit(1)).alias("df_both"))

    def disclosure(df: str) -> Column:
        return F.log(count * F.col("df_both") / (F.col("df_entity") * F.col(df))) / F.log(count / F.col("df_entity"))

    # No term is in fewer texts than near the entities, so a pair that fails with that count fails with the whole one.
    pairs = pairs.where((F.col("df_both") >= min_texts) & (disclosure("df_near") >= generalise_at - 1e-9))
    pairs = stored(pairs, "pairs")
    wanted = stored(pairs.select("term").distinct(), "wanted")
    inside = unit_terms.join(wanted, "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    outside = _document_counts(docs, wanted, keys, text).select("term", "df")
    counts = inside.unionByName(outside).groupBy("term").agg(F.sum("df").alias("df"))
    scored = pairs.join(counts, "term").withColumn("disclosure", disclosure("df"))
    meant = _surprise(F.col("df_both"), F.col("df_entity"), F.col("df"), count) >= LEAST_G
    return scored.where(meant & (F.col("disclosure") >= generalise_at)).select("entity", "term", "disclosure")


def _chunked(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))


def _between(chunks: Column, start: Column, end: Column) -> Column:
    """The characters from ``start`` to ``end`` of a text cut by ``_chunked``; only the chunks around them are read."""
    first = F.floor(start / _CHUNK).cast("int")
    last = F.floor((end - 1) / _CHUNK).cast("int")
    near = F.array_join(F.slice(chunks, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
    return F.when(end > start, F.substr(near, (start - first * _CHUNK + 1).cast("int"), (end - start).cast("int"))).otherwise("")


def _replaced(text: Column, spans: str, shown: Callable[[Column], Column]) -> Column:
    """``text`` with each span replaced; of overlapping spans the first gives the replacement and all are taken out."""

    def cut(chunks: Column, reached: Column) -> Column:
        def piece(span: Column, i: Column) -> Column:
            before = F.coalesce(F.get(reached, i - 1), F.lit(0).cast("long"))
            return F.when(span["start"] >= before, F.concat(_between(chunks, before, span["start"]), shown(span))).otherwise("")

        rest = _between(chunks, F.element_at(reached, -1), F.length(text).cast("long"))
        return F.concat(F.array_join(F.transform(spans, piece), ""), rest)

    ends = F.transform(spans, lambda span: span["end"])
    reached = _let(ends, lambda found: _doubling(found, F.greatest, F.lit(0).cast("long")))
    whole = _let(_chunked(text), lambda chunks: _let(reached, lambda upto: cut(chunks, upto)))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def _term_spans(docs: DataFrame, marked: DataFrame, scores: DataFrame, remove_at: float, doc_id: str, text: str) -> DataFrame:
    """``_id``, ``_hash``, ``added``: where the terms of ``scores`` stand outside base spans, for rows that have any.

    Rows first meet the exact terms by their distinct words.  Only rows with a term have their words placed, each
    in its own row, so no more comes out than the spans themselves.
    """
    bitmap = _bitmap(scores)
    likely = _terms_of(F.filter(_words(), lambda word: _passes(_as_term(word), bitmap)))
    source = docs.select(F.col(doc_id).alias("_id"), row_hash(text).alias("_hash"), whole_text(text).alias("_text"))
    words = source.select("_id", "_hash", F.explode(likely).alias("term")).distinct()
    kind = F.when(F.col("disclosure") >= remove_at, "remove").otherwise("term").alias("kind")
    hits = words.join(scores, "term").groupBy("_id", "_hash").agg(F.collect_list(F.struct("term", kind)).alias("hits"))
    base = marked.select(F.col("doc_id").alias("_id"), F.col(ROW_HASH).alias("_hash"), "base").dropDuplicates(["_id", "_hash"])
    hits = stored(base.join(hits, _same_row(base, hits)).select(base["_id"].alias("hit_id"), base["_hash"].alias("hit_hash"), "base", "hits"), "hits")
    same = F.col("_id").eqNullSafe(F.col("hit_id")) & (F.col("_hash") == F.col("hit_hash"))
    rows = source.join(hits.hint("shuffle_hash"), same).dropDuplicates(["_id", "_hash"])
    # A base span becomes letters of no word, so that words keep their places and none is found inside one.
    masked = _replaced(F.col("_text"), "base", lambda span: F.repeat(F.lit(_MASK), (span["end"] - span["start"]).cast("int")))
    rows = rows.withColumn("_text", F.when(F.size("base") > 0, masked).otherwise(F.col("_text")))

    def found_in(terms: Column, kinds: Column) -> Column:
        def span(place: Column) -> Column:
            at = F.array_position(terms, _as_term(place["value"])).cast("int")
            kind = F.when(at > 0, F.get(kinds, at - 1)).alias("kind")
            value = _as_term(place["value"]).alias("value")
            return F.struct(place["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), place["end"].alias("end"), kind, value)

        likely_places = F.filter(_placed(F.col("_text"), TERM), lambda place: _passes(_as_term(place["value"]), bitmap))
        return F.filter(F.transform(likely_places, span), lambda span: span["kind"].isNotNull())

    terms, kinds = F.transform("hits", lambda hit: hit["term"]), F.transform("hits", lambda hit: hit["kind"])
    spans = _let(terms, lambda known: _let(kinds, lambda shown: found_in(known, shown)))
    return rows.select("_id", "_hash", spans.alias("added")).where(F.size("added") > 0)


def _same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["_id"].eqNullSafe(right["_id"]) & (left["_hash"] == right["_hash"])


def personal_spans(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_texts: int = MIN_TEXTS,
    generalise_at: float = GENERALISE_AT,
    remove_at: float = REMOVE_AT,
) -> DataFrame:
    """Base spans and disclosing words of every row: ``doc_id``, ``ROW_HASH``, ``base``, ``spans``.

    ``spans`` holds the base spans and, as kind ``term`` or ``remove``, the words whose disclosure of a protected
    value reaches ``generalise_at`` or ``remove_at``, wherever in the corpus they stand outside base spans.  Positions are code points, ends exclusive.

    A null or empty text has no spans.  Rows that repeat id and text get equal spans and count as one text in
    the corpus; a null id keeps its row; an empty table gives no rows; other columns are not read.
    """
    marked = stored(with_spans(docs, doc_id, text), "marked")
    terms = disclosing_terms(docs, marked, text, min_texts, generalise_at)
    scores = stored(terms.groupBy("term").agg(F.max("disclosure").alias("disclosure")), "scores")
    added = _term_spans(docs, marked, scores, remove_at, doc_id, text)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col(ROW_HASH) == F.col("_hash"))
    spans = F.sort_array(F.concat("base", F.coalesce("added", F.array().cast(marked.schema["base"].dataType))))
    return marked.join(added, same, "left").select("doc_id", ROW_HASH, "base", spans.alias("spans"))


def listed(spans: str) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"])), ",")


def sanitised(text: Column, spans: str = "spans") -> Column:
    """``text`` with base spans and revealing words replaced by their kind, and fully revealing words removed.

    Of overlapping spans the first gives the replacement and all are taken out.
    """
    return _replaced(text, spans, lambda span: F.when(span["kind"] == "remove", "").otherwise(F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))))


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data taken out of the texts; ``length``, if there, follows the new text.

    Only rows with spans are stored for the join; the texts move once, by the same plan at every size.
    """
    found = personal_spans(docs, doc_id, text).where(F.size("spans") > 0)
    own = {name: f"_{name}_{uuid.uuid4().hex}" for name in ("id", "hash", "spans")}
    changes = found.select(F.col("doc_id").alias(own["id"]), F.col(ROW_HASH).alias(own["hash"]), F.col("spans").alias(own["spans"]))
    changes = stored(changes.distinct(), "spans")
    same = F.col(doc_id).eqNullSafe(F.col(own["id"])) & (F.xxhash64(whole_text(text)) == F.col(own["hash"]))
    joined = docs.join(changes.hint("shuffle_hash"), same, "left")
    changed = F.col(own["spans"]).isNotNull()
    out = joined.withColumn(text, F.when(changed, sanitised(F.col(text), own["spans"])).otherwise(F.col(text)))
    if length in docs.columns:
        out = out.withColumn(length, F.when(changed, F.length(text).cast(docs.schema[length].dataType)).otherwise(F.col(length)))
    return out.select(*docs.columns)
