"""The registered queries of the subpackage, and the SQL of those that SQL can express on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import SQL as decontaminate_sql
from .licenses import SQL as licenses_sql
from .mixing import SQL as mixing_sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import chat

    own = spark.createDataFrame([(-7, i, role, "\\### Assistant: </turn> ok") for i, role in enumerate(("user", "assistant"))], "conv_id long, turn int, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    messages = chat.conversation_messages(rows)
    out = chat.format_paths(chat.reply_paths(spark, messages), messages)
    read = out.select("tree", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), F.concat_ws("", chat.read_loss(F.col("formatted"), F.col("loss_spans"))).alias("loss"))
    turns = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        F.when(~F.col("tree.missing"), F.col("tree.id")).alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import gif

    return gif.media_digests(gif.text_media(table(spark, sf_dir, "documents")))


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import tokens

    return tokens.read_tokens(tokens.write_tokens(table(spark, sf_dir, "documents")))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing

    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import simhash

    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_suffixtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import suffixtree

    return suffixtree.digests(suffixtree.dedup_words(table(spark, sf_dir, "documents")))


def op6_suffixarray(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import suffixarray

    return suffixarray.digests(suffixarray.dedup_bytes(table(spark, sf_dir, "documents")))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import language

    return language.language_of(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontaminate

    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import licenses

    return licenses.report(table(spark, sf_dir, "documents"), licenses.templates(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_gif": op2_gif,
    "op3_decontaminate": op3_decontaminate,
    "op4_suffixtree": op4_suffixtree,
    "op5_licenses": op5_licenses,
    "op6_suffixarray": op6_suffixarray,
    "op7_tokens": op7_tokens,
    "op8_mix": op8_mix,
    "op9_language": op9_language,
    "op10_simhash": op10_simhash,
}
SQL: dict[str, str] = {"op3_decontaminate": decontaminate_sql, "op5_licenses": licenses_sql, "op8_mix": mixing_sql}
