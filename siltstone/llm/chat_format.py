"""Chat formatting: reply trees become conversations [DataFrame operations only].

``format_reply_trees`` takes messages of reply trees, enumerates every root-to-leaf path by
iterative self-joins, ranks the paths of a tree by their score and formats each chosen path as one
conversation with a loss mask.

Paths: J_k maps a message to its ancestor 2^k steps up (J_{k+1} is J_k joined with itself). Leaves
climb with J_k for falling k, each join adding to the ancestors known so far those 2^k above them,
so a path of n messages takes log2(n) joins and every message of a path is made once. Rows in
flight stay in proportion to the output, however deep the trees are.

Template: ``### role: text </turn>\\n`` for each turn. Inside roles and texts ``\\`` becomes ``\\b``,
``<`` becomes ``\\l`` and ``#`` becomes ``\\h`` (in roles also ``:`` becomes ``\\c``), so that no
control string can occur there and ``read_turns`` inverts it exactly.

Every message gets a key of its own first, and replies are joined by it, so rows that share an id stay apart.

Defined cases: null role or text counts as empty; a message whose parent is null or missing is a root; messages of
null tree form one tree, apart from one called "null"; of messages that share tree and id the first by role, text, score and parent takes
the replies, the others are leaves, as is a message of null id, so every message is on a path and equal rows give equal
conversations; a cycle raises ValueError; score ties go to the smaller leaf (null last), then to the smaller text; empty input gives no rows.
One conversation is one record, so its turns meet in one row; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.registry import query
from siltstone.session import materialize, table

START, SEP, END = "### ", ": ", " </turn>\n"
_ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))


def _sub(c: Column, pairs) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape(c: Column) -> Column:
    """No control string of the template is left in the result."""
    return _sub(F.coalesce(c, F.lit("")), _ESCAPES)


def unescape(c: Column) -> Column:
    """Inverse of escape: the backslash itself comes last."""
    return _sub(c, [(b, a) for a, b in _ESCAPES[::-1]])


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit(":"), F.lit("\\c"))


def _unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("\\c"), F.lit(":")))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    pieces = F.split(formatted, END)
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def parse(p: Column) -> Column:
        at = F.instr(p, SEP)
        return F.struct(
            _unescape_role(F.substring(p, F.lit(len(START) + 1), at - len(START) - 1)).alias("role"),
            unescape(F.substring(p, at + len(SEP), F.length(p))).alias("text"),
        )

    return F.transform(pieces, parse)


def read_masked(formatted: Column, mask: Column) -> Column:
    """The unescaped texts under the loss mask, in order, as an array; linear in the conversation's length."""
    pieces = F.split(formatted, END)
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.array_compact(
        F.zip_with(
            pieces, mask, lambda p, m: F.when(m["learn"], unescape(F.substring(p, m["offset"] + 1, m["length"])))
        )
    )


def with_keys(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """messages (tree, node, parent, role, text, score) with key, and (key, up): the key of the message replied to; both written once."""
    rank = F.struct(F.md5(F.concat_ws("\n", "role", "text")).alias("digest"), "score", "parent", "key")
    m = materialize(messages.withColumn("key", F.monotonically_increasing_id()), "messages")
    first = m.where("node IS NOT NULL").groupBy(F.col("tree").alias("_tree"), F.col("node").alias("_node")).agg(F.min(rank)["key"].alias("up"))
    links = m.join(first, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("parent") == F.col("_node")), "left").select("key", "up")
    return m, materialize(links, "replies")


def leaf_paths(links: DataFrame) -> DataFrame:
    """(leaf, key, at): for every leaf each message of its path, at steps above it.

    links: (key long, up long or null), each key once.
    """
    jump = replies = links.where("up IS NOT NULL").select("key", "up")
    total, jumps = links.count(), []
    while not jump.isEmpty():
        if 2 ** len(jumps) > max(1, total):
            raise ValueError("the replies hold a cycle")
        jumps.append(jump)
        above = jump.select(F.col("key").alias("up"), F.col("up").alias("far"))
        jump = materialize(jump.join(above, "up").select("key", F.col("far").alias("up")), "jump")
    found = links.join(replies.select(F.col("up").alias("key")).distinct(), "key", "left_anti").select(
        F.col("key").alias("leaf"), "key", F.lit(0).cast("long").alias("at")
    )
    for k in range(len(jumps) - 1, -1, -1):
        here = F.struct("key", "at")
        both = F.array(here, F.struct(F.col("up").alias("key"), (F.col("at") + 2**k).alias("at")))
        found = (
            found.join(jumps[k], "key", "left")
            .select("leaf", F.explode(F.when(F.col("up").isNull(), F.array(here)).otherwise(both)).alias("x"))
            .select("leaf", "x.key", "x.at")
        )
    return found


def format_reply_trees(messages: DataFrame, top_k: int | None = None) -> DataFrame:
    """One row per chosen path: tree, leaf, branch_rank, branch_score, n_turns, formatted, loss_mask.

    messages: tree (any type), node long, parent long, role, text, score double; other columns are
    ignored. branch_score is the sum of the scores on the path; top_k keeps that many best paths of
    each tree, None all. loss_mask: for each turn (learn, offset, length): where its text lies, in code
    points, inside the turn's piece of the formatted text (pieces end with END); learn for assistants.
    """
    m = messages.select(
        F.col("tree").cast("string").alias("tree"),
        "node",
        "parent",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    m, links = with_keys(m)
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit(SEP))
    rows = (
        leaf_paths(links)
        .join(m.select("key", "tree", "node", "role", "text", "score"), "key")
        .select("leaf", "at", "tree", "node", "role", "score", head.alias("head"), escape(F.col("text")).alias("body"))
    )
    turn = F.struct(
        (-F.col("at")).alias("at"),
        F.concat("head", "body", F.lit(END)).alias("piece"),
        (F.col("role") == "assistant").alias("learn"),
        F.length("head").alias("offset"),
        F.length("body").alias("length"),
    )
    own = F.when(F.col("at") == 0, F.struct("tree", "node"))
    paths = rows.groupBy("leaf").agg(
        F.max(own).alias("own"), F.sum("score").alias("branch_score"), F.array_sort(F.collect_list(turn)).alias("turns")
    )
    out = paths.select(
        "own.tree",
        F.col("own.node").alias("leaf"),
        "branch_score",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(
            "turns", lambda t: F.struct(t["learn"].alias("learn"), t["offset"].alias("offset"), t["length"].alias("length"))
        ).alias("loss_mask"),
    )
    best = Window.partitionBy("tree").orderBy(F.desc("branch_score"), F.col("leaf").asc_nulls_last(), F.md5("formatted"))
    out = out.withColumn("branch_rank", F.row_number().over(best))
    return out if top_k is None else out.where(F.col("branch_rank") <= top_k)


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Messages of the conversations table: each turn replies to the turn before it; ties in turn go by role, then text.

    A message scores its length, so that the longer of two branches ranks first.
    """
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return conversations.select(
        F.col("conv_id").alias("tree"),
        "role",
        "text",
        F.row_number().over(w).cast("long").alias("node"),
        F.length(F.coalesce("text", F.lit(""))).cast("double").alias("score"),
    ).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


_PROBE = "\\### Assistant: </turn> ok"


def _esc_sql(c: str) -> str:
    return f"replace(replace(replace({c}, '\\', '\\b'), '<', '\\l'), '#', '\\h')"


@query(
    "op1_chat_format",
    rf"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '{_PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{_PROBE}')
    SELECT conv_id, count(*)::BIGINT AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum({len(START) + len(SEP) + len(END)} + length(replace({_esc_sql('role')}, ':', '\c')) + length({_esc_sql('text')}))::BIGINT AS formatted_chars,
           sum(length(text))::DOUBLE AS branch_score, 1 AS branch_rank
    FROM c GROUP BY conv_id
    """,
)
def op1_chat_format(spark, sf):
    """Formats all conversations and one that imitates the template, and digests what is read back."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_PROBE).alias("text"),
    )
    out = format_reply_trees(conversation_messages(c.unionByName(probe)))
    turns, learn = read_turns(F.col("formatted")), F.array_join(read_masked(F.col("formatted"), F.col("loss_mask")), "")
    out = out.select("tree", "formatted", "branch_score", "branch_rank", turns.alias("turns"), learn.alias("learn"))
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return out.select(
        F.col("tree").cast("long").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learn").cast("long").alias("loss_chars"),
        F.sha2("learn", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "branch_score",
        "branch_rank",
    )
