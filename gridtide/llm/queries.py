"""Named queries over the document tables, one per operator, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import divergence, exact_dedup, packing, prefix_trie, privacy, quality_model, quality_rules, simhash, substrings
from gridtide.llm import suffixes, tokens, topk, toxicity
from gridtide.llm.common import ROW_HASH, read_table
from gridtide.llm.labelled import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def vocabulary() -> str:
    """The word vocabulary's file, as installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


@query
def op1_bpe(spark, sf_dir):
    done = tokens.round_trip(_documents(spark, sf_dir), vocabulary())
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_simhash(spark, sf_dir):
    found = simhash.near_duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def _decided(scores: DataFrame, held_out) -> DataFrame:
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scores.select("doc_id", held_out.alias("held_out"), "score", predicted)


@query
def op3_quality_model(spark, sf_dir):
    held_out = fold(F.col("doc_id"), 5) == 0
    scores = quality_model.quality_scores(_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"), ~held_out)
    return _decided(scores, held_out)


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


@query
def op4_pii(spark, sf_dir):
    found = privacy.personal_spans(_documents(spark, sf_dir))
    counts = [
        F.size(F.filter("base", _of_kind(kind))).cast("long").alias(f"n_{kind}")
        for kind in privacy.KINDS
    ]
    listed = privacy.listed("spans").alias("spans")
    return found.select("doc_id", *counts, F.sha2(privacy.listed("base"), 256).alias("base_sha256"), listed)


@query
def op5_substrings(spark, sf_dir):
    done = substrings.without_repeats(_documents(spark, sf_dir))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op5_substrings"] = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), placed AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM texts
), windows AS (
    SELECT doc_id, i, word, count(*) OVER ahead AS size, string_agg(word, ' ') OVER ahead AS words
    FROM placed
    WINDOW ahead AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), judged AS (
    SELECT doc_id, i, word, size = 20 AND row_number() OVER (PARTITION BY size, words ORDER BY doc_id, i) > 1 AS again
    FROM windows
), covered AS (
    SELECT doc_id, i, word,
        bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
    FROM judged
), kept AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS words
    FROM covered GROUP BY doc_id
)
SELECT doc_id, len(texts.words) AS n_words, coalesce(n_removed, 0) AS n_removed,
    sha256(coalesce(kept.words, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


@query
def op6_toxicity(spark, sf_dir):
    held_out = fold(F.col("doc_id"), 4) == 2
    scores = toxicity.toxicity_scores(_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"), ~held_out)
    return _decided(scores, held_out)


@query
def op7_suffix_strings(spark, sf_dir):
    done = suffixes.without_repeats(_documents(spark, sf_dir))
    return done.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query
def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(_documents(spark, sf_dir)).drop(ROW_HASH)


SQL["op8_exact_dedup"] = r"""
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
      FROM documents)
WINDOW same AS (PARTITION BY text_sha256)
"""


@query
def op9_packing(spark, sf_dir):
    return packing.pack_documents(_documents(spark, sf_dir), vocabulary())


@query
def op10_quality_rules(spark, sf_dir):
    trusted = read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_rules.quality_rules(_documents(spark, sf_dir), trusted).drop(ROW_HASH)


@query
def op11_source_divergence(spark, sf_dir):
    return divergence.source_divergence(_documents(spark, sf_dir))


SQL["op11_source_divergence"] = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), found AS (
    SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts
), kept AS (
    SELECT lang, term, count(*)::HUGEINT AS n FROM found GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), langs AS (
    SELECT lang, sum(n)::HUGEINT AS n, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), counted AS (
    SELECT lang, source, term, count(*)::HUGEINT AS c FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
    SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS n
    FROM (SELECT DISTINCT lang, source FROM texts) LEFT JOIN counted USING (lang, source) GROUP BY ALL
), shares AS (
    SELECT lang, source, term, coalesce(c, 0) AS c, 1 + (1000000000 * (coalesce(c, 0) + 2)) // (groups.n + 2 * v) AS p,
        1 + (1000000000 * (kept.n + 2)) // (langs.n + 2 * v) AS q
    FROM groups JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), items AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE c > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM items
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


SQL["op12_prefix_trie"] = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
    ) AS i
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY i) AS turns,
        -- crc32 of the decimal id, bit by bit
        xor(list_reduce(
            list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
            lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))
        ), 4294967295) % 9 AS h
    FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT own.conv_id, list_concat(list_slice(base.turns, 1, own.h), list_slice(own.turns, own.h + 1, len(own.turns))) AS turns
    FROM own LEFT JOIN own base ON base.conv_id = own.conv_id - own.conv_id % 5
), paths AS (
    SELECT conv_id, depth, len(turns) AS length, sha256(list_slice(turns, 1, depth)::JSON::VARCHAR) AS node,
        CASE WHEN depth > 0 THEN strlen(turns[depth].text) ELSE 0 END AS bytes
    FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM rebuilt)
), nodes AS (
    SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
        coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (length = depth), '') AS ends
    FROM paths GROUP BY depth, node
), linked AS (
    SELECT nodes.*, parents.conv_id AS parent_conv_id, parents.node AS parent
    FROM nodes
    LEFT JOIN paths above ON above.conv_id = nodes.conv_id AND above.depth = nodes.depth - 1
    LEFT JOIN nodes parents ON parents.depth = above.depth AND parents.node = above.node
), children AS (
    SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL
), below AS (
    SELECT above.depth, above.node, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * nodes.bytes) AS saved
    FROM nodes LEFT JOIN children USING (depth, node)
    JOIN paths above ON above.conv_id = nodes.conv_id AND above.depth <= nodes.depth
    GROUP BY above.depth, above.node
)
SELECT conv_id, depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
    saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM linked JOIN below USING (depth, node) LEFT JOIN children USING (depth, node)
"""


@query
def op13_topk(spark, sf_dir):
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


SQL["op13_topk"] = """
WITH vectors AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.r <> c.r WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST))::INTEGER AS rank, vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
