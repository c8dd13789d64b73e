"""Byte-pair encoding and decoding of whole texts with a public vocabulary file."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

# Fixed values of the vocabulary's text rules: Unicode white space, and the split into words.
_WHITE = "\t\n\v\f\r \x85\xa0  -     　"
_PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_WHITE}\p{{L}}\p{{N}}]+"
# Texts with a character outside these ranges, or with "<|", take the library's tables for their word
# rules.  Inside them, letters are in their composed form, lower case is letter by letter, and ASCII white space is all.
_RARE = (
    r"<\||[^\x00-\x1b\x20-\x{84}\x{86}-\x{9f}\x{a1}-\x{12f}\x{131}-\x{2ff}\x{370}-\x{373}\x{375}-\x{37d}\x{37f}-\x{386}"
    r"\x{388}-\x{557}\x{2010}-\x{2027}\x{2030}-\x{205e}\x{20a0}-\x{20bf}\x{3041}-\x{3096}\x{30a1}-\x{30fa}\x{4e00}-\x{9fa5}\x{ac00}-\x{d7a3}]"
)
_NEVER = np.int64(1 << 62)  # above merges * width for every width
_REMEMBERED = 300_000  # words kept between batches
_FOREST_CELLS = 1 << 16
_CHUNK_CHARS = 4_000_000


def _byte_letters() -> list[str]:
    """The visible letter that stands for each byte: its own where it has one, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(byte if byte in shown else next(hidden)) for byte in range(256)]


class MergeForest:
    """One segment tree per word over the ranks of its neighbouring symbols, all words at once.

    A leaf holds ``rank * width + place`` (64 bits, for words of any length) of the pair that starts at its place, so a root is the
    leftmost pair of the lowest rank in its word.  Each round merges at every root that holds a pair:
    three leaves change per word, and only their log(width) ancestors are renewed.
    """

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, pairs: np.ndarray, made: np.ndarray, ranks: np.ndarray):
        count, self.width = symbols.shape
        self.pairs, self.made, self.ranks = pairs, made, ranks
        place = np.arange(self.width, dtype=np.int32)
        after = np.where(place + 1 < lengths[:, None], place + 1, -1).astype(np.int32)
        right = np.where(after >= 0, np.roll(symbols, -1, axis=1), -1)
        tree = np.empty((count, 2 * self.width), np.int64)
        tree[:, self.width :] = self._keys(symbols, right, place)
        level = self.width
        while level > 1:
            level >>= 1
            below = tree[:, 2 * level : 4 * level]
            tree[:, level : 2 * level] = np.minimum(below[:, ::2], below[:, 1::2])
        # Flat: cell `row * width + place`, tree node `row * 2 * width + node`.
        self.symbols, self.after, self.tree = symbols.ravel(), after.ravel(), tree.ravel()
        self.before = np.tile(place - 1, count)

    def _keys(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        wanted = (left.astype(np.int64) << 20) | right  # -1 on either side makes a negative number
        found = np.searchsorted(self.pairs, wanted)
        found[found == len(self.pairs)] = 0
        return np.where(self.pairs[found] == wanted, self.ranks[found] * np.int64(self.width) + place, _NEVER)

    def run(self) -> np.ndarray:
        """Merge until no root holds a pair; the remaining symbols, -1 at places merged away."""
        tree, symbols, after, before, width = self.tree, self.symbols, self.after, self.before, self.width
        rows = np.flatnonzero(tree[1 :: 2 * width] < _NEVER)
        while len(rows):
            cell, node = rows * width, rows * (2 * width)
            rank, place = np.divmod(tree[node + 1], np.int64(width))
            here = cell + place
            gone = after[here]
            beyond = after[cell + gone]
            linked = beyond >= 0
            merged = self.made[rank]
            symbols[here] = merged
            symbols[cell + gone] = -1
            after[here] = beyond
            before[(cell + beyond)[linked]] = place[linked]
            ahead = before[here]
            first = ahead >= 0
            right = np.where(linked, symbols[cell + beyond], -1)
            left = np.where(first, symbols[cell + ahead], -1)
            leaf = node + width
            tree[leaf + gone] = _NEVER
            tree[leaf + place] = self._keys(merged, right, place)
            tree[(leaf + ahead)[first]] = self._keys(left, merged, ahead)[first]
            changed = [width + gone, width + place, width + np.where(first, ahead, place)]
            for _ in range(width.bit_length() - 1):
                for i, child in enumerate(changed):
                    changed[i] = child >> 1
                    below = node + (child & -2)
                    tree[node + changed[i]] = np.minimum(tree[below], tree[below + 1])
            rows = rows[tree[node + 1] < _NEVER]
        return symbols.reshape(-1, width)


class WordBpe:
    """Encoder and decoder for a vocabulary file of the kind "BPE with word ends"."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab: dict[str, int] = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"]
        letters = _byte_letters()
        self.inner = np.array([vocab[letter] for letter in letters], np.int32)
        self.last = np.array([vocab[letter + end] for letter in letters], np.int32)
        merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in spec["model"]["merges"]]
        pairs = np.array([vocab[left] << 20 | vocab[right] for left, right in merges], np.int64)
        self.made = np.array([vocab[left + right] for left, right in merges], np.int32)
        self.ranks = np.argsort(pairs).astype(np.int32)
        self.pairs = pairs[self.ranks]
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        names = {number: text for text, number in [*vocab.items(), *self.special.items()]}
        self.names = pa.array([names.get(number) for number in range(max(names) + 1)])
        self.find = regex.compile(_PIECES).findall
        self.cut = regex.compile("|".join(regex.escape(text) for text in sorted(self.special, key=len, reverse=True)))
        self.rules = Tokenizer.from_file(path)
        self.bytes_of = {letter: byte for byte, letter in enumerate(letters)}
        self.known: dict[str, bytes] = {}

    def _merge(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        out: list[bytes] = [b""] * len(words)
        order = np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable").tolist()
        start = 0
        while start < len(order):
            width = 1 << max(1, (len(words[order[start]]) - 1).bit_length())
            room = max(1, _FOREST_CELLS // width)
            stop = start
            while stop < len(order) and stop - start < room and len(words[order[stop]]) <= width:
                stop += 1
            chosen = order[start:stop]
            data = b"".join([words[place].ljust(width, b"\0") for place in chosen])
            raw = np.frombuffer(data, np.uint8).reshape(-1, width)
            lengths = np.array([len(words[place]) for place in chosen])
            symbols = np.where(np.arange(width) < lengths[:, None], self.inner[raw], np.int32(-1))
            rows = np.arange(len(chosen))
            symbols[rows, lengths - 1] = self.last[raw[rows, lengths - 1]]
            symbols = MergeForest(symbols, lengths, self.pairs, self.made, self.ranks).run()
            ids = symbols[symbols >= 0].astype("<u4").tobytes()
            ends = (4 * np.cumsum((symbols >= 0).sum(axis=1))).tolist()
            begin = 0
            for place, finish in zip(chosen, ends):
                out[place] = ids[begin:finish]
                begin = finish
            start = stop
        return out

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end and the number of ids of each; unknown words are merged together."""
        known = self.known
        found = list(map(known.get, words))
        fresh = [place for place, ids in enumerate(found) if ids is None]
        pieces: list[str] = []
        parts: list[int] = []
        for place in fresh:
            word = words[place]
            cut = [word] if word.isalpha() else self.find(word)
            pieces += cut
            parts.append(len(cut))
        merged = self._merge([piece.encode() for piece in pieces])
        start = 0
        for place, count in zip(fresh, parts):
            found[place] = known[words[place]] = merged[start] if count == 1 else b"".join(merged[start : start + count])
            start += count
        if len(known) > _REMEMBERED:
            self.known = dict(islice(known.items(), len(known) // 2, None))
        return np.frombuffer(b"".join(found), "<i4"), np.fromiter(map(len, found), np.int64, len(found)) // 4

    def _encode_common(self, texts: pa.StringArray) -> pa.ListArray:
        """Texts of common letters: Arrow splits them at white space and numbers the distinct words."""
        words = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        numbered = words.flatten().dictionary_encode()
        ids, sizes = self._ids_of(numbered.dictionary.to_pylist())
        codes = numbered.indices.to_numpy()
        starts, counts = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
        ends = np.concatenate([[0], np.cumsum(counts)])
        places = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], counts)
        first = words.offsets[0].as_py()
        offsets = ends[words.offsets.to_numpy() - first].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[places]))

    def _encode_rare(self, text: str) -> list[int]:
        """Any text: special tokens are cut out first, and the library's own tables give the words."""
        out: list[int] = []
        end = 0
        for match in [*self.cut.finditer(text), None]:
            plain = self.rules.normalizer.normalize_str(text[end : match.start() if match else len(text)])
            words = [bytes(map(self.bytes_of.__getitem__, word)) for word, _ in self.rules.pre_tokenizer.pre_tokenize_str(plain)]
            out += [number for word in self._merge(words) for number in np.frombuffer(word, "<i4").tolist()]
            if match:
                out.append(self.special[match[0]])
                end = match.end()
        return out

    def encode_array(self, texts: pa.StringArray) -> pa.ListArray:
        """Ids of each text; a null text has none."""
        texts = pc.fill_null(texts, "")
        rare = pc.match_substring_regex(texts, _RARE)
        if not pc.any(rare).as_py():
            return self._encode_common(texts)
        odd = [self._encode_rare(text) for text in texts.filter(rare).to_pylist()]
        common = self._encode_common(texts.filter(pc.invert(rare)))
        order = np.argsort(np.argsort(rare.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
        return pa.concat_arrays([common, pa.array(odd, common.type)]).take(pa.array(order))

    def encode(self, text: str) -> list[int]:
        return self.encode_array(pa.array([text], pa.string()))[0].as_py()

    def decode_batch(self, ids: pa.ListArray) -> pa.Array:
        """The tokens of each list with one space between; the file names no decoder."""
        tokens = self.names.take(ids.values)
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, tokens), " ")


@cache
def encoder(path: str) -> WordBpe:
    """One encoder per Python worker and vocabulary."""
    return WordBpe(path)


def chunks(batches: Iterable[pa.RecordBatch], column: str, most: int = _CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` characters or list items in ``column``, a row at least."""
    for batch in batches:
        values = batch.column(column)
        sized = pc.binary_length if pa.types.is_string(values.type) else pc.list_value_length
        ends = np.cumsum(pc.fill_null(sized(values), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(first, stop - first)
            first = stop


def encode_texts(docs: DataFrame, vocab_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of every whole text in a new column ``ids``; a null text has none.

    A column of that name is replaced; other columns stay.  Rows are worked on in chunks by number of
    characters, so memory follows the longest text, not the table.
    """
    names = [name for name in docs.columns if name != ids]
    schema = T.StructType([*docs.select(*names).schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocab_path)
        for batch in chunks(batches, text):
            lists = bpe.encode_array(batch.column(text))
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in names], lists], names=[*names, ids])

    return docs.mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, vocab_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its token ids in a new column ``text``; null ids give an empty text."""
    names = [name for name in encoded.columns if name != text]
    schema = T.StructType([*encoded.select(*names).schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocab_path)
        for batch in chunks(batches, ids):
            lists = batch.column(ids)
            offsets = np.cumsum([0, *pc.fill_null(pc.list_value_length(lists), 0).to_pylist()], dtype=np.int32)
            texts = bpe.decode_batch(pa.ListArray.from_arrays(pa.array(offsets), lists.flatten()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in names], texts.cast(pa.string())], names=[*names, text]
            )

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocab_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` of every whole text.

    Both directions run in one Python worker per task; the decoded text is made from the ids alone.
    A null or empty text has no ids and decodes to an empty text; repeated rows are encoded alike; an
    empty table gives no rows; other columns are not read.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocab_path)
        for batch in chunks(batches, "text"):
            lists = bpe.encode_array(batch.column("text"))
            texts = bpe.decode_batch(lists).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, texts], names=["doc_id", "ids", "decoded"])

    kind = dict(source.dtypes)["doc_id"]
    return source.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
