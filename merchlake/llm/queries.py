"""The operators as registered queries, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm import (
    chat,
    decontaminate,
    exact_dedup,
    lexical,
    line_dedup,
    minhash,
    nn_descent,
    packing,
    prefix_trie,
    sharding,
    suffix_dedup,
    superkmer,
    toxicity,
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), shards=8)


def op2_bucket_pointer_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_patience_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.remove_aligned(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_removed", "n_partners", F.sha2("kept", 256).alias("kept_sha256"))


def op4_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), size=4, percent=80)


def op5_greedy_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one in another layout whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    other = spark.range(1).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.to_json(F.struct(F.lit(said).alias("prompt"), F.lit(said).alias("completion"))).alias(chat.RECORD),
    )
    return chat.digests(read(spark, sf_dir, "conversations"), other)


def op7_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op9_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = superkmer.remove_later(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op11_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(read(spark, sf_dir, "embeddings"))


def op12_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


def op13_shared_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_slot_sharding": op1_slot_sharding,
    "op2_bucket_pointer_refinement": op2_bucket_pointer_refinement,
    "op3_patience_lines": op3_patience_lines,
    "op4_bbit_minhash": op4_bbit_minhash,
    "op5_greedy_tiling": op5_greedy_tiling,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_ftrl_toxicity": op7_ftrl_toxicity,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_super_kmers": op9_super_kmers,
    "op10_best_two_fit": op10_best_two_fit,
    "op11_nn_descent": op11_nn_descent,
    "op12_burst_trie": op12_burst_trie,
    "op13_shared_terms": op13_shared_terms,
}

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TERMS = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
# The checksum bit by bit, as DuckDB has no function for it.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

ORACLE: dict[str, str] = {
    "op12_burst_trie": f"""
        WITH turns AS (
            SELECT conv_id AS c, turn,
                   sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id,
                   len({_WORDS.format(text="coalesce(text, '')")}) AS words
            FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
            SELECT c, list({{'id': id, 'words': words}} ORDER BY turn NULLS FIRST, id) AS t, {_CRC32.format(text="CAST(c AS VARCHAR)")} % 4 AS h
            FROM turns GROUP BY c
        ), rebuilt AS (
            SELECT own.c, list_concat(coalesce(lent.t, [])[1:own.h], own.t[own.h + 1:]) AS t
            FROM own LEFT JOIN own lent ON lent.c = own.c - own.c % 20
        ), paths AS (
            SELECT c, len(t) AS size, d, sha256(array_to_string(list_transform(t[1:d], lambda x: x.id), '')) AS path,
                   CASE WHEN d = 0 THEN 0 ELSE t[d].words END AS words
            FROM rebuilt, unnest(range(0, len(t) + 1)) AS u(d)
        ), nodes AS (
            SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                   sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (size = d), '')) AS ends
            FROM paths GROUP BY path, d
        ), parents AS (
            SELECT n.path, p.path AS up FROM nodes n JOIN paths p ON p.c = n.conv_id AND p.d = n.d - 1
        ), children AS (SELECT up AS path, count(*) AS n FROM parents GROUP BY up),
        below AS (
            SELECT a.path, sum((n.n_convs - 1) * n.words) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
            FROM nodes n LEFT JOIN children k ON k.path = n.path JOIN paths a ON a.c = n.conv_id AND a.d <= n.d
            GROUP BY a.path
        )
        SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
               leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
        FROM nodes n JOIN below USING (path) LEFT JOIN children k ON k.path = n.path
             LEFT JOIN parents p ON p.path = n.path LEFT JOIN nodes up ON up.path = p.up""",
    "op13_shared_terms": f"""
        WITH asked AS (
            SELECT DISTINCT item_id, unnest({_TERMS.format(text=_LOWER)}) AS term FROM benchmark
        ), split AS (
            SELECT doc_id, {_TERMS.format(text=_LOWER)} AS words FROM documents
        ), sized AS (
            SELECT doc_id, words, len(words) AS n, count(*) OVER () AS all_docs, CAST(sum(len(words)) OVER () AS BIGINT) AS all_terms
            FROM split WHERE len(words) > 0
        ), held AS (
            SELECT doc_id, term, count(*) AS tf, 50 + (50 * n * all_docs) // all_terms AS m, all_docs
            FROM (SELECT doc_id, n, all_docs, all_terms, unnest(words) AS term FROM sized)
            WHERE term IN (SELECT term FROM asked) GROUP BY ALL
        ), weighed AS (
            SELECT *, CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * count(*) OVER (PARTITION BY term) + 1))) AS BIGINT) AS w
            FROM held
        ), scored AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
            FROM asked JOIN weighed USING (term) GROUP BY item_id, doc_id
        )
        SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
        WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY rank <= 50""",
    "op8_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op6_chat_formatting": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                             (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), sized AS (
            SELECT *, length(regexp_replace(text, '(</?s>|\[/?INST\]|<</?SYS>>)', '\\\1', 'g'))
                    + length(regexp_replace(role, '(</?s>|\[/?INST\]|<</?SYS>>)', '\\\1', 'g')) AS chars
            FROM rows
        )
        SELECT conv_id,
               count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
                   AS loss_sha256,
               CAST(4 + sum(chars + 22) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id""",
    "op4_bbit_minhash": f"""
        WITH RECURSIVE split AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
            FROM split, unnest(range(1, greatest(2, len(w) - 2))) AS t(i) WHERE len(w) > 0
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT x, y FROM (
                SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
                FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL)
            JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * c >= 80 * (p.n + q.n - c)
        ), reached AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION SELECT reached.doc_id, y FROM reached JOIN links ON other = x
        )
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id
             JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r ON r.doc_id = d.doc_id""",
    "op9_super_kmers": f"""
        WITH split AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
        windows AS (
            SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i : i + 19], ' ') ORDER BY doc_id, i) AS nth
            FROM split, unnest(range(1, len(w) - 18)) AS t(i)
        ), gone AS (
            SELECT DISTINCT doc_id, i + step AS place FROM windows, unnest(range(20)) AS t(step) WHERE nth > 1
        ), words AS (SELECT doc_id, place, w[place] AS word FROM split, unnest(range(1, len(w) + 1)) AS t(place)),
        kept AS (
            SELECT words.doc_id, count(gone.place) AS n_removed,
                   string_agg(word, ' ' ORDER BY words.place) FILTER (gone.place IS NULL) AS text
            FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.place = words.place GROUP BY words.doc_id
        )
        SELECT split.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM split LEFT JOIN kept ON kept.doc_id = split.doc_id""",
}
