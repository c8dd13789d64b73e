import re

import brute
import corpus_pipeline
import pytest

from gridtide.llm import quality_rules


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, small_texts):
    """The 0.001 documents with planted copies, near copies and odd rows."""
    folder = tmp_path_factory.mktemp("corpus")
    texts = dict(small_texts)
    long = max(texts.values(), key=len)
    clean = next(text for _, text in sorted(texts.items()) if len(text.split()) > 300 and not brute.rules(text)["base_failed"])
    texts |= {1000: clean, 1001: clean.replace("\n", " \t "), 1002: clean + " tail", 1003: long, 1004: None, 1005: ""}
    texts |= {1006: clean.replace(" ", " mail me@here.example ", 1)}
    rows = [(i, text, "en", "s", None if text is None else len(text)) for i, text in texts.items()]
    rows.append((None, clean + " other words here", "en", "s", 1))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def _rows(df):
    return {row.doc_id: row.text for row in df.collect()}


def test_each_stage_against_plain_python(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, trusted = docs.columns, spark.read.parquet(f"{tables}/labels.parquet").where("quality = 1").select("doc_id")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        steps.append(stage(spark, steps[-1], tables))
        assert steps[-1].columns == columns
    start, good, single, apart, hidden = map(_rows, steps)
    ratio = {row.doc_id: row.log_ratio for row in quality_rules.quality_rules(docs, trusted).collect()}
    assert good == {i: text for i, text in start.items() if not brute.rules(text)["base_failed"] and ratio[i] >= -0.25}
    first = {}
    for i in sorted(good, key=lambda i: (i is None, i)):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", good[i]), i)
    assert single == {i: good[i] for i in first.values()}
    # A row without an id comes after all others.
    number = {i: 10**9 if i is None else i for i in single}
    classes = brute.classes({number[i]: brute.fingerprint(text) for i, text in single.items()})
    assert apart == {i: text for i, text in single.items() if classes[number[i]] == number[i]}
    assert set(hidden) == set(apart)
    for i, text in hidden.items():
        spans = brute.personal(apart[i])
        assert not any(apart[i][start:end] in text for start, _, end, kind in spans if kind == "email")
        assert spans or text == apart[i]
    packed = corpus_pipeline.pack(spark, steps[-1], tables).collect()
    assert {row.doc_id for row in packed} == set(hidden)


def test_run_equals_its_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def pieces(df):
        return sorted(str(tuple(row)) for row in df.select(*names).collect())

    assert pieces(corpus_pipeline.run(spark, tables)) == pieces(docs)


def test_empty_table(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
        assert docs.collect() == []


def test_repeated_rows_and_odd_columns(spark, tables):
    """A table loaded twice gives what it gives once, whatever its other columns are called."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string, _id string, fingerprint string, kept string"
    rows = [(1, "a b c"), (1, "a b c"), (1, "a  b c"), (2, "a b c"), (None, "n o"), (None, "n  o"), (None, "n o"), (3, None), (4, "")]
    rows += [(5, "mail me@here.example now"), (5, "mail me@here.example now"), (6, "other words of its own")]
    docs = spark.createDataFrame([(i, text, "en", "s", 1, "x", "y", "z", "k") for i, text in rows], schema)
    single = corpus_pipeline.drop_copies(spark, docs, tables)
    assert single.columns == docs.columns
    kept = sorted((str(row.doc_id), row.text) for row in single.select("doc_id", "text").fillna("").collect())
    assert [i for i, _ in kept] == ["1", "3", "5", "6", "None"] and kept[0][1] in ("a b c", "a  b c")
    near = corpus_pipeline.drop_near_copies(spark, docs, tables)
    assert near.columns == docs.columns and near.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").count() == 0
    hidden = corpus_pipeline.hide_personal_data(spark, docs, tables)
    assert hidden.columns == docs.columns and hidden.where("text LIKE '%[EMAIL]%' AND spans = 'x'").count() == 2
