import random

import brute
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gridtide.llm import packing, tokens
from gridtide.llm.queries import vocabulary


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def own():
    return tokens.WordBpe(vocabulary())


def _ids(own, texts):
    return own.encode_array(pa.array(texts, pa.string())).to_pylist()


def test_every_letter_block(own, library):
    points = [*range(0x3200), *range(0x3200, 0x110000, 97)]
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}A1" for c in points if not 0xD800 <= c < 0xE000]
    assert _ids(own, texts) == [library.encode(text, add_special_tokens=False).ids for text in texts]


def test_mixtures(own, library):
    rng = random.Random(3)
    parts = ["<|endoftext|>", "<|startoftext|>", "'S", "'re", "ΣΑΣ", "İ", "é", "é", " ", "\n", "12", "a" * 300,
             "!!", "<|", "|>", "ﬁ", "한글", "한", " ", "ab", "\x1c", "　"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    assert _ids(own, texts) == [library.encode(text, add_special_tokens=False).ids for text in texts]


def test_very_long_words(own, library):
    rng = random.Random(11)
    kinds = {"abcdefghijklmnopqrstuvwxyz": 1, "".join(map(chr, range(0x4E00, 0x9FA6))): 3, "!#$%&()*+,-./:;=?@[]^_{}~": 1}
    texts = ["".join(rng.choices(kind, k=size // width)) for kind, width in kinds.items() for size in (20_000, 40_000)]
    for text in texts:
        assert _ids(own, [text]) == [library.encode(text, add_special_tokens=False).ids]


def test_round_trip_query(docs_of, odd_texts, small_texts, library):
    texts = dict(enumerate(odd_texts)) | {100 + i: text for i, text in small_texts.items()}
    rows = {row.doc_id: row for row in tokens.round_trip(docs_of(texts.items()), vocabulary()).collect()}
    assert set(rows) == set(texts)
    for i, text in texts.items():
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert list(rows[i].ids) == expected
        assert rows[i].decoded == library.decode(expected, skip_special_tokens=False)


def test_columns_are_kept_and_replaced(docs_of):
    encoded = tokens.encode_texts(docs_of(["a b"]), vocabulary())
    assert sorted(encoded.columns) == sorted(docs_of(["a b"]).columns)
    assert list(encoded.first().ids) == list(tokens.encoder(vocabulary()).encode("a b"))
    assert tokens.round_trip(docs_of([]), vocabulary()).collect() == []


def _sequences(rows):
    out = {}
    for row in rows:
        out.setdefault(row.sequence_id, []).append((row.offset, row.length))
    return out


def test_pieces_and_sequences(docs_of, odd_texts, small_texts, library):
    import zlib
    from array import array

    texts = dict(enumerate(odd_texts)) | {100 + i: text for i, text in small_texts.items()}
    rows = packing.pack_documents(docs_of(texts.items()), vocabulary()).collect()
    expected = set()
    for i, text in texts.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = array("I", ids[start : start + 2048])
            expected.add((i, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == expected and len(rows) == len(expected)
    for places in _sequences(rows).values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(_sequences(rows)) <= 1.06 * sum(r.length for r in rows) / 2048 + 4


def test_bins_against_plain_search():
    rng = random.Random(8)
    for most in (1, 3, 50):
        bins, own_open, next_bin = packing.BestFit(100, most), {}, 0
        for _ in range(600):
            length = rng.randint(1, 100)
            number, offset = bins.place(length)
            fitting = [free for free in own_open.values() if free >= length]
            if fitting:
                assert own_open[number] == min(fitting) and offset == 100 - min(fitting)
                own_open[number] -= length
                if not own_open[number]:
                    del own_open[number]
            else:
                assert (number, offset) == (next_bin, 0)
                next_bin += 1
                if length < 100:
                    if len(own_open) == most:
                        fullest = min(own_open.values())
                        gone = [n for n, free in own_open.items() if free == fullest]
                        taken = [n for n in gone if n not in {x for held in bins.bins for x in held}]
                        del own_open[taken[0]]
                    own_open[number] = 100 - length


def test_repeated_rows_null_ids_and_empty_table(docs_of):
    rows = packing.pack_documents(docs_of([(1, "a b"), (1, "a b"), (None, "a b"), (2, None)]), vocabulary()).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 3), (1, 3), (1, 3), (2, 1)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 4
    assert packing.pack_documents(docs_of([]), vocabulary()).collect() == []
