"""Data-quality rules: flags of tokens and issues of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def token_flags(df: DataFrame, text_col: str, stop_words: Sequence[str]) -> DataFrame:
    """(token, n, stop_word, single, short, odd): distinct lower-case tokens, counted first and flagged once each."""
    words = df.select(F.explode(F.regexp_extract_all(F.lower(text_col), F.lit("([a-z0-9_-]+)"), F.lit(1))).alias("token"))
    t = F.col("token")
    return words.groupBy("token").agg(F.count(F.lit(1)).alias("n")).select(
        "token", "n", t.isin(*stop_words).alias("stop_word"), (F.length(t) == 1).alias("single"), (F.length(t) < 3).alias("short"),
        t.rlike("_|--|^-|-$").alias("odd"),
    )


def conversation_issues(df: DataFrame, key: str = "conv_id", role: str = "role", text: str = "text", roles: Sequence[str] = ("system", "user", "assistant")) -> DataFrame:
    """(key, issue, severity): a row for every rule a turn or a conversation breaks."""
    r, x = F.col(role), F.col(text)
    issue = lambda df, name, severity: df.select(key, F.lit(name).alias("issue"), F.lit(severity).alias("severity"))
    silent = df.groupBy(key).agg(F.count_if(r == "assistant").alias("n")).where("n = 0")
    parts = [
        issue(df.where(x.isNull() | (F.trim(x) == "")), "empty_text", "critical"),
        issue(df.where(r.isNull() | ~r.isin(*roles)), "unknown_role", "critical"),
        issue(df.where((F.length(x) > 50) & ~x.rlike("[.!?]")), "not_one_sentence", "minor"),
        issue(silent, "no_answer", "major"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def issue_summary(issues: DataFrame, key: str) -> DataFrame:
    """(key, issues, critical, kinds) of every record with an issue."""
    return issues.groupBy(key).agg(
        F.count(F.lit(1)).alias("issues"), F.count_if(F.col("severity") == "critical").alias("critical"),
        F.array_join(F.array_sort(F.collect_set("issue")), ",").alias("kinds"),
    )


def junk_names(df: DataFrame, name: str, short: Sequence[str] = ("Al", "Ed", "Jo", "Ro")) -> DataFrame:
    """Rows whose name holds an underscore or two dashes, begins with a dash, is a capital and a dash, or has two characters at most and is no known ``short`` name."""
    n = F.col(name)
    return df.where(n.rlike("_|--|^[A-Z]-$|^-") | ((F.length(n) <= 2) & ~n.isin(*short)))
