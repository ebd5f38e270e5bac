"""The registered queries, one per operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.chat import formatted_conversations, learnt_texts, read_back
from waybill.llm.contamination import contained_items
from waybill.llm.damage import damaged_conversations, with_planted_runs
from waybill.llm.exact import exact_groups
from waybill.llm.frames import table
from waybill.llm.jaccard import similar_documents
from waybill.llm.labelled_pages import labelled_pages
from waybill.llm.main_text import LABELLED_PAGES, learnt_model, main_texts
from waybill.llm.packing import pack
from waybill.llm.passages import near_repeated_passages
from waybill.llm.periods import periodic_runs
from waybill.llm.quality import learnt_machine, quality_scores
from waybill.llm.repair import repair_digests
from waybill.llm.shard import shard_rows
from waybill.llm.suffixes import repeated_passages
from waybill.llm.toxicity import learnt_lexicon, toxicity_scores


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"), learnt_model(labelled_pages(spark, LABELLED_PAGES)))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_scores(docs, learnt_lexicon(docs, table(spark, sf_dir, "labels")))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_repeated_passages(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, learnt_machine(docs, table(spark, sf_dir, "labels"), ("n_chars",)), ("n_chars",))


def op11_periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))

    def greatest_first(a: Column, b: Column) -> Column:
        # Exact: length / period is compared by cross-multiplication.
        mine, other = a["length"] * b["period"], b["length"] * a["period"]
        earlier = (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))
        return F.when(mine > other, -1).when(mine < other, 1).when(earlier, -1).otherwise(1)

    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", F.get(F.array_sort("runs", greatest_first), F.lit(0))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are full of marks, formatted and read back."""
    columns = ("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"),
    )
    chats = formatted_conversations(table(spark, sf_dir, "conversations").select(*columns).unionByName(marked))
    parsed = chats.select(
        "conv_id",
        read_back(F.col("formatted")).alias("turns"),
        F.array_join(learnt_texts(F.col("formatted"), F.col("mask")), "").alias("learnt"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair_digests(damaged_conversations(rows), rows.select("conv_id"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_exact_dedup,
        op3_benchmark_decontamination,
        op4_sharding,
        op5_html_extraction,
        op6_toxicity,
        op7_ngram_jaccard_join,
        op8_best_fit_packing,
        op9_substring_dedup,
        op10_quality_classifier,
        op11_periodic_run_detection,
        op12_chat_formatting,
        op13_conversation_repair,
    )
}

# crc32 of an ASCII text, bit by bit: the 256 steps of one byte, then one step per character.
_CRC32 = """
  crc AS (SELECT list_transform(range(256), lambda i:
            list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z:
              CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps)"""


def _crc32(key: str) -> str:
    characters = f"list_transform(string_split({key}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return (
        f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {characters}), lambda c, b: "
        "xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"
    )


ORACLES = {
    "op2_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(text) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY text)
    """,
    "op12_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok'
            FROM range(2) AS t(n))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                                 ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
               CAST(sum(length('### : ') + length(text) + length('</turn>') + 2
                        + length(CASE WHEN role IN ('system', 'user', 'assistant') THEN role
                                      ELSE '=' || replace(url_encode(role), '%20', '+') END)
                        + length(regexp_extract_all(text, '### |</turn>'))) AS BIGINT) AS formatted_chars
        FROM turns GROUP BY conv_id
    """,
    "op13_conversation_repair": f"""
        WITH RECURSIVE {_CRC32},
        source AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
            FROM conversations),
        keyed AS (SELECT source.*, {_crc32("k")} % 20 AS fault FROM source, crc),
        damaged AS (
            SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM keyed, range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
                   count(*) OVER (PARTITION BY conv_id) AS n FROM damaged),
        judged AS (
            SELECT *, left(role, 1) AS initial,
                   CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                        WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
            FROM numbered),
        counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv_id),
        -- from the last row to the first: the cheapest way (cost, letters, repaired lines) from nothing (o),
        -- after a system (s), a user (u) and an assistant turn (a)
        ways AS (
            SELECT conv_id, n AS i, {{'c': 0, 'l': '', 't': CAST([] AS VARCHAR[])}} AS o,
                   {{'c': 4, 'l': 'II', 't': ['user:', 'assistant:']}} AS s, {{'c': 2, 'l': 'I', 't': ['assistant:']}} AS u,
                   {{'c': 0, 'l': '', 't': CAST([] AS VARCHAR[])}} AS a
            FROM (SELECT DISTINCT conv_id, n FROM judged)
            UNION ALL
            SELECT conv_id, i,
                   least(o, {{'c': 2 + w.u.c, 'l': 'I' || w.u.l, 't': list_prepend('user:', w.u.t)}}),
                   least(s, {{'c': 2 + w.u.c, 'l': 'I' || w.u.l, 't': list_prepend('user:', w.u.t)}}),
                   w.u, w.a
            FROM (
                SELECT conv_id, i, o, s,
                       least(u, {{'c': 2 + a.c, 'l': 'I' || a.l, 't': list_prepend('assistant:', a.t)}}) AS u,
                       least(a, {{'c': 2 + u.c, 'l': 'I' || u.l, 't': list_prepend('user:', u.t)}}) AS a
                FROM (
                    SELECT w.conv_id, w.i - 1 AS i,
                           least({{'c': 3 + w.o.c, 'l': 'D' || w.o.l, 't': w.o.t}},
                                 {{'c': 2 + x + w.u.c, 'l': 'R' || w.u.l, 't': list_prepend('user:' || text, w.u.t)}},
                                 {{'c': x + ks + w.s.c, 'l': 'K' || w.s.l, 't': list_prepend(role || ':' || text, w.s.t)}},
                                 {{'c': x + ku + w.u.c, 'l': 'K' || w.u.l, 't': list_prepend(role || ':' || text, w.u.t)}}) AS o,
                           least({{'c': 3 + w.s.c, 'l': 'D' || w.s.l, 't': w.s.t}},
                                 {{'c': 2 + x + w.u.c, 'l': 'R' || w.u.l, 't': list_prepend('user:' || text, w.u.t)}},
                                 {{'c': x + ku + w.u.c, 'l': 'K' || w.u.l, 't': list_prepend(role || ':' || text, w.u.t)}}) AS s,
                           least({{'c': 3 + w.u.c, 'l': 'D' || w.u.l, 't': w.u.t}},
                                 {{'c': 2 + x + w.a.c, 'l': 'R' || w.a.l, 't': list_prepend('assistant:' || text, w.a.t)}},
                                 {{'c': x + ka + w.a.c, 'l': 'K' || w.a.l, 't': list_prepend(role || ':' || text, w.a.t)}}) AS u,
                           least({{'c': 3 + w.a.c, 'l': 'D' || w.a.l, 't': w.a.t}},
                                 {{'c': 2 + x + w.u.c, 'l': 'R' || w.u.l, 't': list_prepend('user:' || text, w.u.t)}},
                                 {{'c': x + ku + w.u.c, 'l': 'K' || w.u.l, 't': list_prepend(role || ':' || text, w.u.t)}}) AS a
                    FROM ways AS w JOIN (
                        SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000 WHEN fault = 'truncated' THEN 1 ELSE 0 END AS x,
                               CASE initial WHEN 's' THEN 0 ELSE 1000000 END AS ks,
                               CASE initial WHEN 'u' THEN 0 ELSE 1000000 END AS ku,
                               CASE initial WHEN 'a' THEN 0 ELSE 1000000 END AS ka
                        FROM judged) AS r
                    ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND w.i = r.i)) AS w)
        SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               CAST(coalesce(w.o.c, 0) AS BIGINT) AS cost, coalesce(w.o.l, '') AS audit,
               sha256(coalesce(array_to_string(w.o.t, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM source) AS ids
        LEFT JOIN counted ON ids.conv_id IS NOT DISTINCT FROM counted.conv_id
        LEFT JOIN (SELECT * FROM ways WHERE i = 0) AS w ON ids.conv_id IS NOT DISTINCT FROM w.conv_id
    """,
}
