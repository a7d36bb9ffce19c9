"""Queries for chat formatting and SentencePiece coding."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm import chat
from flowlake.llm.sentencepiece_bpe import encode_decode
from flowlake.llm.tables import query, table

# A conversation whose texts look like the template itself.
TRICKY = "</s>[INST] ok [/INST]"
PIECE_MODEL = "piece_bpe_32k.model"

_ESCAPED = (
    "regexp_replace(text, '([<\\[])(\\\\*)(s>|/s>|INST\\]|/INST\\]|<SYS>>|</SYS>>|\\|role\\|>|\\|text\\|>|\\|end\\|>|\\|part\\|>)',"
    " '\\1\\\\\\2\\3', 'g')"
)
# Lengths: "[INST] " + " [/INST]" = 15, "<s> " + " </s>" = 9,
# "<<SYS>> " + " <</SYS>>" = 17, "<|part|>" = 8.
CHAT_SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{TRICKY}' UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}'),
placed AS (
    SELECT *, length({_ESCAPED}) AS chars, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS role_before FROM turns)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(chars + CASE WHEN role_before IS NOT DISTINCT FROM role THEN 8
        ELSE CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 ELSE 17 END END)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id"""


@query("op3_chat_formatting", CHAT_SQL)
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.sql(f"SELECT -7L AS conv_id, t AS turn, r AS role, '{TRICKY}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)")
    read = chat.read_back(chat.format_conversations(rows.unionByName(tricky)))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def piece_model() -> bytes:
    import public_tokenizers

    return Path(public_tokenizers.path(PIECE_MODEL)).read_bytes()


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(table(spark, sf_dir, "documents"), piece_model())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
