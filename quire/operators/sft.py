"""Prompt / SFT formatting (A8, C14) as column templates.

The inference prompt of the source is ``"Q: {question}\\nReasoning:\\n"``;
training records carry ``input, trace, answer``.  How trace and answer follow
the prompt is not written down in the source; we append the trace, a newline,
``"Answer: "`` and the answer (our choice).
Conversations are formatted row by row (one line per turn) and paired with
an equi-join on the next turn, so no conversation is ever collected into one
row or task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Prompt template pieces.
PROMPT_PREFIX = "Q: "
PROMPT_SUFFIX = "\nReasoning:\n"
ANSWER_PREFIX = "\nAnswer: "


def prompt(question) -> F.Column:
    q = F.col(question) if isinstance(question, str) else question
    return F.concat(F.lit(PROMPT_PREFIX), q, F.lit(PROMPT_SUFFIX))


def sft_text(df: DataFrame, input: str = "input", trace: str = "trace", answer: str = "answer",
             out: str = "text") -> DataFrame:
    """A8 records -> ``prompt``, ``completion`` and the full training ``text``."""
    p = prompt(F.coalesce(F.col(input), F.lit("")))
    c = F.concat(F.coalesce(F.col(trace), F.lit("")), F.lit(ANSWER_PREFIX), F.coalesce(F.col(answer), F.lit("")))
    return df.withColumn("prompt", p).withColumn("completion", c).withColumn(out, F.concat(p, c))


def conversation_lines(conv: DataFrame) -> DataFrame:
    """C14: ``conv_id, turn, line`` with ``line = "Role: text"``; write with
    ``sortWithinPartitions(conv_id, turn)`` to get transcripts."""
    role = F.concat(F.upper(F.substring("role", 1, 1)), F.expr("substring(role, 2)"))
    return conv.select("conv_id", "turn", F.concat(role, F.lit(": "), F.col("text")).alias("line"))


def conversation_pairs(conv: DataFrame, user: str = "user", assistant: str = "assistant") -> DataFrame:
    """C14: every user turn followed by an assistant turn becomes an SFT
    record ``conv_id, turn, input, trace, answer`` (trace empty)."""
    u = conv.where(F.col("role") == user).select("conv_id", "turn", F.col("text").alias("input"))
    a = conv.where(F.col("role") == assistant).select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return u.join(a, ["conv_id", "turn"]).select("conv_id", "turn", "input", F.lit("").alias("trace"), "answer")
