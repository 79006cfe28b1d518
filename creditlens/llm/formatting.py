"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted by (turn, role,
text), so equal turns and repeated rows have one defined order.  Adjacent
turns of one role become one block (array aggregation over the sorted
structs) whose texts are parted by ``<|im_sep|>``:

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

Escaping is reversible: inside a text ``<``, any number of backslashes and
``|`` gain one backslash, so no text holds a control string; roles escape
backslash and newline too.  ``loss_spans`` holds the [start, end) code-point
spans of the assistant texts in ``formatted``.

Defined cases: NULL text or role is empty; a NULL turn sorts first; a NULL
conversation id is a conversation of its own; no rows give no rows.  A
conversation is one output document, so its turns meet in one task by nature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escape_sql(col: str) -> str:
    return rf"regexp_replace({col}, r'<(\\*)\|', r'<$1\\|')"


def unescape_sql(col: str) -> str:
    return rf"regexp_replace({col}, r'<(\\*)\\\|', r'<$1|')"


def escape_role_sql(col: str) -> str:
    return escape_sql(rf"replace(replace({col}, r'\', r'\\'), '\n', r'\n')")


def unescape_role_sql(col: str) -> str:
    return rf"array_join(transform(split({unescape_sql(col)}, r'\\\\'), p -> replace(p, r'\n', '\n')), r'\')"


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """turns -> (conv, formatted, loss_spans array<struct<start,end>>)."""
    rows = turns.select(F.col(conv).alias("conv"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    # positions where a block starts, then one block per start with its texts
    starts = sorted_turns.withColumn("starts", F.expr(
        "filter(sequence(0, size(ts) - 1), i -> i = 0 OR ts[i].role <> ts[i - 1].role)"))
    blocks = starts.withColumn("blocks", F.expr(
        "transform(starts, (s, k) -> struct(ts[s].role as role, transform("
        "slice(ts, s + 1, IF(k + 1 < size(starts), get(starts, k + 1), size(ts)) - s), "
        f"x -> {escape_sql('x.text')}) as texts))"))
    headed = blocks.withColumn("blocks", F.expr(
        f"transform(blocks, b -> struct(b.role = '{ASSISTANT}' as learn, "
        f"concat('{START}', {escape_role_sql('b.role')}, '\\n') as head, b.texts as texts))"))
    out = headed.withColumn("formatted", F.expr(
        f"array_join(transform(blocks, b -> concat(b.head, array_join(b.texts, '{SEP}'), "
        f"'{END}')), '')".replace("\n", "\\n")))
    # running code-point position over blocks and texts gives the mask of the assistant texts
    walk = (
        "aggregate(blocks, struct(0 as pos, cast(array() as array<struct<start:int,end:int>>) as spans), "
        "(a, b) -> named_struct('pos', cast(a.pos + length(b.head) + "
        f"aggregate(b.texts, 0, (n, x) -> n + length(x)) + {len(SEP)} * (size(b.texts) - 1) + {len(END)} as int), "
        "'spans', IF(b.learn, concat(a.spans, "
        "aggregate(b.texts, struct(cast(a.pos + length(b.head) as int) as pos, "
        "cast(array() as array<struct<start:int,end:int>>) as s), "
        f"(c, x) -> named_struct('pos', cast(c.pos + length(x) + {len(SEP)} as int), "
        "'s', concat(c.s, array(named_struct('start', c.pos, 'end', cast(c.pos + length(x) as int))))), c -> c.s)), "
        "a.spans)), a -> a.spans)")
    return out.select(F.col("conv").alias(conv), "formatted", F.expr(walk).alias("loss_spans"))


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, formatted, loss_spans) -> (conv, turns array<struct<role,text>>, loss_text)."""
    cut = formatted.withColumn("_b", F.expr(r"filter(split(formatted, r'<\|im_start\|>'), (b, i) -> i > 0)"))
    turns = (
        r"flatten(transform(_b, b -> transform("
        rf"split(substr(b, instr(b, '\n') + 1, length(b) - instr(b, '\n') - {len(END)}), r'<\|im_sep\|>'), "
        rf"x -> struct({unescape_role_sql(chr(32) + 'substr(b, 1, instr(b, chr(10)) - 1)')} as role, "
        rf"{unescape_sql('x')} as text))))")
    loss = ("array_join(transform(loss_spans, s -> "
            + unescape_sql("substr(formatted, s.start + 1, s.end - s.start)") + "), '')")
    return cut.select(conv, "formatted", F.expr(turns).alias("turns"), F.expr(loss).alias("loss_text"))


def digest(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    r = read_back(formatted, conv)
    return r.select(
        conv, F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.expr(r"array_join(transform(turns, t -> concat(t.role, '\n', t.text, '\n')), '')"), 256)
        .alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
o AS (SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before FROM c
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (SELECT *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS et,
  regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g') AS er FROM o)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(et) + CASE WHEN k > 1 AND role = before THEN 10 ELSE 12 + length(er) + 1 + 11 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
