r"""Chat formatting of reply trees.

Messages form trees by parent id. Root-to-leaf paths come from iterative self-joins by doubling:
round k joins every message with its 2**k-th ancestor, so a chain of n replies takes log n
rounds, not n. A leaf carries the sum of its path's scores and its depth; the branches of a
tree are ranked by mean score and the best ones chosen. Going back through the rounds' tables
gives each chosen leaf its path, and the path's texts are formatted as one conversation.

The template writes a turn as ``<|turn|>role<|text|>text<|end|>``. Control strings inside roles
and texts (those marks and the marks of common chat templates) get a backslash after their first
character, backslashes are doubled, so no control string is left in a text and the escape is
undone exactly. The loss mask is a list of code-point spans, one per assistant text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brandpulse.llm.common import shared_dir, written

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings of public chat templates.
CONTROL = (
    "<|turn|>", "<|text|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>",
    "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
LEARNED = "assistant"
_MARK = "(" + "|".join(re.escape(x[0]) + f"(?={re.escape(x[1:])})" for x in CONTROL) + ")"


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, _MARK, r"$1\\")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join by ``keys`` that takes nulls for equal; the keys stay as columns of ``left``."""
    named = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(named, same, how).drop(*[f"_r_{k}" for k in keys])


def _numbered(messages: DataFrame) -> DataFrame:
    """The messages that count, with ``no``: 1, or a number of its own in the tree if the id is null."""
    one = Window.partitionBy("tree", "id").orderBy(F.col("parent").asc_nulls_first(), F.col("score").desc_nulls_last())
    return messages.withColumn("no", F.row_number().over(one)).where("no = 1 or id is null")


def _paths(messages: DataFrame, branches: int) -> DataFrame:
    """:func:`paths` with ``no``, which tells messages without id apart."""
    m = _numbered(messages.select("tree", "id", "parent", F.col("score").cast("double").alias("score"))).withColumn(
        "score", F.coalesce("score", F.lit(0.0)))
    known = m.where("id is not null").select("tree", F.col("id").alias("parent"), F.lit(True).alias("_known"))
    m = _joined(m, known, ["tree", "parent"], "left").select(
        "tree", "id", "no", F.when(F.col("_known"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("dist"), "score")
    step = written(m.withColumn("dist", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long")), "chat-up0")
    rounds = [step]
    limit = max(1, step.count()).bit_length() + 1  # more rounds than any chain needs: what is left then is cyclic
    while len(rounds) <= limit and not step.where("up is not null").isEmpty():
        far = step.where("id is not null").select(
            "tree", F.col("id").alias("up"), F.col("up").alias("_up"), F.col("dist").alias("_dist"), F.col("score").alias("_score"))
        # messages that have reached their root are not joined again
        on = _joined(step.where("up is not null"), far, ["tree", "up"]).select(
            "tree", "id", "no", F.col("_up").alias("up"), (F.col("dist") + F.col("_dist")).alias("dist"),
            (F.col("score") + F.col("_score")).alias("score"))
        step = written(step.where("up is null").select(on.columns).unionByName(on), f"chat-up{len(rounds)}")
        rounds.append(step)
    inner = rounds[0].where("up is not null").select("tree", F.col("up").alias("id")).distinct()
    leaves = _joined(step.where("up is null"), inner, ["tree", "id"], "left_anti")
    best = Window.partitionBy("tree").orderBy((F.col("score") / (F.col("dist") + 1)).desc(), "id", "no")
    chosen = leaves.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= branches)
    on = written(chosen.select("tree", F.col("id").alias("leaf"), "id", "no", F.col("dist").alias("depth"), "branch"), "chat-leaves")
    for k in range(len(rounds) - 2, -1, -1):  # each row has the ancestor 2**k above, if there is one
        jump = rounds[k].where("up is not null").select("tree", "id", "no", "up")
        above = _joined(on, jump, ["tree", "id", "no"]).select(
            "tree", "leaf", F.col("up").alias("id"), F.lit(1).alias("no"), (F.col("depth") - (1 << k)).alias("depth"), "branch")
        on = written(on.unionByName(above), f"chat-path{k}")  # else the plan doubles with every round
    return on


def paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``tree, leaf, id, depth, branch`` of the ``branches`` best root-to-leaf paths per tree.

    ``messages`` has ``tree, id, parent, score``. A message whose parent is null or absent from
    its tree is a root. Of messages with one id only the first by (parent, score) counts. A null
    score counts as 0; equal branches are ranked by leaf id. Messages on a cycle, which no root
    reaches, are on no path. ``depth`` counts from the root, ``branch`` from 1.

    Messages whose tree is null are one tree. A message whose id is null is a message of its own
    that nothing can answer, and so a leaf.
    """
    return _paths(messages, branches).drop("no")


def format_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``tree, leaf, branch, formatted, loss`` for every chosen path of :func:`paths`.

    ``messages`` also has ``role`` and ``text``; nulls of either are empty. ``loss`` holds the
    (start, end) code points of each assistant text in ``formatted``, in order.
    """
    role, text = escape(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    turns = _numbered(messages.withColumn("score", F.col("score").cast("double"))).select(
        "tree", "id", "no", role.alias("_role"), text.alias("_text"), F.coalesce("role", F.lit("")).alias("_as"))
    head = F.concat(F.lit(TURN), F.col("_role"), F.lit(TEXT))
    rows = _joined(_paths(messages, branches), turns, ["tree", "id", "no"]).select(
        "tree", "leaf", "branch", "depth", head.alias("head"), F.col("_text").alias("text"), (F.col("_as") == LEARNED).alias("learn"))
    g = rows.groupBy("tree", "leaf", "branch").agg(F.sort_array(F.collect_list(F.struct("depth", "head", "text", "learn"))).alias("_t"))
    g = g.withColumn("formatted", F.array_join(F.transform("_t", lambda x: F.concat(x["head"], x["text"], F.lit(END))), ""))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def add(s: Column, x: Column) -> Column:
        start = s["at"] + F.length(x["head"])
        end = start + F.length(x["text"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(END)).alias("at"), F.when(x["learn"], F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return g.withColumn("loss", F.aggregate("_t", zero, add)["spans"]).select("tree", "leaf", "branch", "formatted", "loss")


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns = []
    for part in formatted.split(TURN)[1:]:
        role, text = part.split(TEXT, 1)
        turns.append((unescape(role), unescape(text.removesuffix(END))))
    return turns


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for s, spans in zip(b.column("formatted").to_pylist(), b.column("loss").to_pylist(), strict=True):
            turns = parse(s)
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            loss = "".join(unescape(s[x["start"]:x["end"]]) for x in spans)
            rows.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(s)))
        if rows:  # ids pass as they are: a null would turn them into floats in pandas
            n, turns_sha, chars, loss_sha, size = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [b.column("tree"), pa.array(n, pa.int64()), pa.array(turns_sha), pa.array(chars, pa.int64()), pa.array(loss_sha), pa.array(size, pa.int64())],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def op5_chat(spark, sf_dir: str) -> DataFrame:
    probe = [(-7, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))]
    convs = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = convs.unionByName(spark.createDataFrame(probe, "conv_id long, turn long, role string, text string"))
    # each turn answers the one before it
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    messages = rows.select(F.col("conv_id").alias("tree"), F.row_number().over(order).cast("long").alias("id"), "role", "text",
                           F.lit(0.0).alias("score")).withColumn("parent", F.when(F.col("id") > 1, F.col("id") - 1))
    messages = written(messages, "chat-messages")
    path = shared_dir(spark, "chat")
    format_paths(messages).write.parquet(path)
    back = spark.read.schema("tree long, leaf long, branch int, formatted string, loss array<struct<start:bigint,end:bigint>>").parquet(path)
    return back.select("tree", "formatted", "loss").mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


OP5_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, k, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(k, role)),
e AS (
  SELECT *, len(replace(role, '\', '\\')) + len(regexp_extract_all(role, '__MARKS__'))
          + len(replace(text, '\', '\\')) + len(regexp_extract_all(text, '__MARKS__')) + 23 AS chars
  FROM r)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""".replace("__MARKS__", "|".join(re.escape(x).replace("'", "''") for x in CONTROL))
