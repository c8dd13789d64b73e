import brute

from gridtide.llm import simhash
from gridtide.llm.components import components


def _found(docs):
    rows = simhash.near_duplicates(docs).collect()
    return [(row.doc_id, row.fingerprint & (2**64 - 1), row.component_id) for row in rows]


def test_prints_and_classes_equal_brute_force(spark, docs_of, odd_texts, small_texts):
    texts = dict(enumerate(odd_texts)) | {100 + i: text for i, text in small_texts.items()}
    base = small_texts[0].split()
    for change in range(12):  # near copies: one word changed
        texts[900 + change] = " ".join([*base[:change], "changed", *base[change + 1 :]])
    prints = {i: brute.fingerprint(text) for i, text in texts.items()}
    expected = brute.classes(prints)
    assert sorted(_found(docs_of(texts.items()))) == sorted((i, prints[i], expected[i]) for i in texts)


def test_links_lose_no_pair(spark):
    import random

    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(40)]
    prints = set(centres)
    for centre in centres:
        for _ in range(12):
            near = centre
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                near ^= 1 << bit
            prints.add(near)
    signed = sorted(p - 2**64 if p >= 2**63 else p for p in prints)
    nodes = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    for most in (1, 2, 3, 5):
        expected = {
            (a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= most
        }
        assert {tuple(row) for row in simhash.links(nodes, most).collect()} == expected


def test_long_chain_is_one_component(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 502), (502, 500)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(201)} | {500: 500, 501: 500, 502: 500}


def test_repeated_rows_null_ids_and_empty_table(docs_of):
    rows = _found(docs_of([(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (1, None), (2, "")]))
    assert sorted((r[0] is None, r[0] or 0, r[2]) for r in rows) == [
        (False, 1, 1), (False, 2, 1), (False, 3, 3), (False, 3, 3), (True, 0, 3)
    ]
    assert _found(docs_of([])) == []
