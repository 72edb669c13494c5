"""Conversations formatted for training, in windows of a token budget.

A conversation is dealt into blocks of neighbouring turns, so that a very long one spreads over many
tasks. In a block, prefix sums of the turns' tokens choose spans of whole turns: every ``room``
tokens begin a slot; a turn that crosses into a slot joins the turns inside it where they fit
together, else it is a span of its own. A window is a span behind what it repeats: the system turn
and a few turns before it. Its loss mask covers the text of its own assistant turns, so each is
learned once, however often it is repeated.

A turn reads ``### role: text</turn>`` and a line end. Roles are percent-encoded. In texts a
backslash goes before every backslash, inside every ``</turn>`` and between neighbouring ``#``, so
that no text holds a control string; taking away a backslash before any character restores it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
LEARNED, SYSTEM = "assistant", "system"
#: Tokens of a window, tokens and turns of the history it may repeat.
BUDGET, HISTORY, HISTORY_TURNS = 1024, 128, 4
#: A turn number divided by this, a power of two, is its block.
BLOCK = 64
#: Tokens are runs of letters or digits and single other marks; markers count as so many.
TOKEN, MARKERS = r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}\x09-\x0d\x20]", 4
KEYS = ("conv_id", "block")


def escaped(text: Column) -> Column:
    """The text without control strings."""
    for found, put in ((r"\\", r"\\\\"), (r"#(?=#)", r"#\\"), ("</turn>", r"<\\/turn>")):
        text = F.regexp_replace(text, found, put)
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _turns(conversations: DataFrame) -> DataFrame:
    """Own columns only. ``turn`` null comes first; ``kind`` 2 marks turns that windows are made of."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turn = F.col("turn").cast("long")
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.shiftright(turn, BLOCK.bit_length() - 1), F.lit(-(2**58))).alias("block"),
        F.lit(2).alias("kind"),
        turn.alias("turn"),
        role.alias("role"),
        text.alias("text"),
        (F.regexp_count(text, F.lit(TOKEN)) + MARKERS).cast("long").alias("cost"),
    )


def _context(turns: DataFrame) -> DataFrame:
    """Turns that a block only repeats: the last ones before it, and its conversation's system turn.

    A block is reached by turn numbers alone, so a conversation with gaps in its numbers repeats less.
    Only conversations of more than one block have rows here.
    """
    spread = turns.select(*KEYS).distinct()
    first = spread.groupBy("conv_id").agg(F.min("block").alias("first"), F.max("block").alias("last"))
    first = first.where("first < last").select(F.col("conv_id").alias("_conv"), "first")
    later = spread.join(first, F.col("conv_id").eqNullSafe(F.col("_conv"))).where("block > first")
    later = later.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"))

    def beside(rows: DataFrame, blocks: DataFrame, where: Column, kind: int) -> DataFrame:
        met = rows.join(blocks, F.col("conv_id").eqNullSafe(F.col("_conv")) & where)
        return met.select(
            "conv_id", F.col("_block").alias("block"), F.lit(kind).alias("kind"), "turn", "role", "text", "cost"
        )

    tail = turns.where((F.pmod("turn", F.lit(BLOCK)) >= BLOCK - HISTORY_TURNS) & (F.col("role") != SYSTEM))
    history = beside(tail, later, F.col("block") + 1 == F.col("_block"), 1)
    systems = turns.where(F.col("role") == SYSTEM).join(
        first.select(F.col("_conv").alias("_many")), F.col("conv_id").eqNullSafe(F.col("_many")), "left_semi"
    )
    earliest = systems.groupBy("conv_id").agg(
        F.min(F.struct("turn", "text", "block", "role", "cost")).alias("s")
    ).select("conv_id", "s.*")
    return history.unionByName(beside(earliest, later, F.col("block") < F.col("_block"), 0))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Formatted windows of conversations: one row per window, ordered by (conv_id, block, span).

    ``conversations`` has conv_id, turn, role and text; other columns are not looked at. Columns of
    the result: conv_id, block, span, tokens, n_repeated (turns at the head that were given before),
    text, and loss, an array of (start, end) in code points of the text.

    Rows are taken by turn, ties by role and text, so repeated rows are turns of their own. A null
    text or role is empty, a null turn comes first, rows without conv_id are one conversation. A
    window holds ``budget`` tokens at most, unless it is a single turn that does not fit beside what
    it repeats; at least a quarter of the budget is left for the span. The system turn is the
    conversation's first turn with that role; windows that begin after it repeat it. Turns of the
    same number cannot be dealt into different blocks. An empty table gives no rows.
    """
    turns = _turns(conversations)
    rows = turns.unionByName(_context(turns))
    block = Window.partitionBy(*KEYS)
    order = block.orderBy("kind", F.col("turn").asc_nulls_first(), "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own, is_system = F.col("kind") == 2, F.col("role") == SYSTEM
    counted = F.when(F.col("kind") > 0, F.col("cost")).otherwise(0)
    rows = (
        rows.withColumn("at", F.row_number().over(order))
        .withColumn("systems", F.sum(is_system.cast("int")).over(so_far))
        .withColumn("end", F.sum(counted).over(so_far))
        .withColumn("before", F.coalesce(F.sum(F.when(F.col("kind") == 1, F.col("cost"))).over(block), F.lit(0)))
        .withColumn("end", F.col("end") - F.col("before"))
        .withColumn("start", F.col("end") - counted)
        .withColumn("system", is_system & (F.col("systems") == 1))
        .withColumn("repeats", F.coalesce(F.sum(F.when(F.col("system"), F.col("cost"))).over(block), F.lit(0)))
        .withColumn("room", F.greatest(F.lit(budget // 4), F.lit(budget - history) - F.col("repeats")))
    )
    # A turn belongs to the slot in which it ends; one that began in an earlier slot crosses into it.
    rows = rows.withColumn("slot", F.when(own, F.floor((F.col("end") - 1) / F.col("room"))))
    crosses = own & (F.floor(F.col("start") / F.col("room")) < F.col("slot"))
    slot = Window.partitionBy(*KEYS, "slot")
    together = F.max("end").over(slot) - F.min("start").over(slot) <= F.col("room")
    span = F.when(own, F.col("slot") * 2 + F.when(crosses | together, 0).otherwise(1))
    turn = F.struct("at", "span", "system", "start", "end", "cost", "role", escaped(F.col("text")).alias("text"))
    blocks = rows.withColumn("span", span).groupBy(*KEYS).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    spans = F.array_distinct(F.filter(F.col("turns.span"), lambda s: s.isNotNull()))
    each = blocks.select(*KEYS, "turns", F.explode(spans).alias("span"))
    each = each.withColumn("own", F.filter("turns", lambda t: t["span"] == F.col("span")))
    begin = F.col("own")[0]["start"]
    repeated = F.concat(
        F.filter("turns", lambda t: t["system"] & (t["at"] < F.col("own")[0]["at"])),
        _last(
            F.filter(
                "turns",
                lambda t: (t["role"] != SYSTEM) & (t["at"] < F.col("own")[0]["at"]) & (t["start"] >= begin - history),
            ),
            HISTORY_TURNS,
        ),
    )
    each = each.withColumn("repeated", repeated).drop("turns")
    head = F.transform(F.concat("repeated", "own"), lambda t: F.concat(F.lit(HEAD), F.url_encode(t["role"]), F.lit(MIDDLE)))
    each = each.select(
        *KEYS, "span", F.concat("repeated", "own").alias("shown"), head.alias("heads"), F.size("repeated").alias("n_repeated")
    )
    pieces = F.zip_with("heads", "shown", lambda h, t: F.concat(h, t["text"], F.lit(END)))
    marks = F.zip_with(
        "heads",
        F.transform("shown", lambda t, i: F.struct(t["text"].alias("text"), t["role"].alias("role"), i.alias("i"))),
        lambda h, t: F.struct(
            F.length(h).alias("head"),
            F.length(t["text"]).alias("text"),
            ((t["role"] == LEARNED) & (t["i"] >= F.col("n_repeated"))).alias("learned"),
        ),
    )
    nothing = F.expr("named_struct('to', 0L, 'loss', cast(array() as array<struct<start: bigint, end: bigint>>))")

    def add(done: Column, m: Column) -> Column:
        start = done["to"] + m["head"]
        here = F.struct(start.alias("start"), (start + m["text"]).alias("end"))
        return F.struct(
            (start + m["text"] + len(END)).alias("to"),
            F.when(m["learned"], F.concat(done["loss"], F.array(here))).otherwise(done["loss"]).alias("loss"),
        )

    tokens = F.aggregate("shown", F.lit(0).cast("long"), lambda a, t: a + t["cost"])
    return each.select(
        "conv_id", "block", "span", tokens.alias("tokens"), "n_repeated",
        F.array_join(pieces, "").alias("text"), F.aggregate(marks, nothing, add)["loss"].alias("loss"),
    )


def _last(turns: Column, most: int) -> Column:
    return F.when(F.size(turns) > most, F.slice(turns, -most, most)).otherwise(turns)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the windows of ``windows`` say: (conv_id, block, span, turns, learned, chars), one row per window.

    ``turns`` are the (role, text) given here for the first time; ``learned`` is the text under the
    loss mask, piece by piece; ``chars`` is the length of the window.
    """
    pieces = F.split("text", END)
    given = F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))

    def parsed(piece: Column) -> Column:
        middle = F.instr(piece, MIDDLE)
        return F.struct(
            F.url_decode(F.substring(piece, len(HEAD) + 1, middle - 1 - len(HEAD))).alias("role"),
            unescaped(F.substring(piece, middle + len(MIDDLE), F.length(piece))).alias("text"),
        )

    under = F.transform("loss", lambda s: unescaped(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])))
    return formatted.select(
        "conv_id", "block", "span", F.transform(given, parsed).alias("turns"), under.alias("learned"),
        F.length("text").cast("long").alias("chars"),
    )


def conversations_and_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table and conversation -7, whose texts are made of control strings."""
    said = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").select(added.columns).unionByName(added)


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation, read back from its windows.

    The digest of a conversation needs all of its text in one row; nothing else does.
    """
    back = read_back(windows(conversations_and_one(spark, sf_dir)))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    parts = back.select(
        "conv_id", F.size("turns").cast("long").alias("n"), "chars",
        F.struct("block", "span", F.array_join(said, "").alias("said"), F.array_join("learned", "").alias("learned")).alias("part"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list("part")).alias("p")
    )
    learned = F.array_join(F.col("p.learned"), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.col("p.said"), ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars",
    )


QUERIES = {"op13_chat": op13_chat}
#: The rules of ``windows`` over lengths instead of texts; the digests straight from the table.
SQL = {
    "op13_chat": rf"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), turns AS (
    SELECT conv_id, turn, role, text, CAST(floor(turn / {BLOCK}) AS BIGINT) AS block, 2 AS kind,
        len(regexp_extract_all(text, '{TOKEN}')) + {MARKERS} AS cost,
        {len(HEAD) + len(MIDDLE) + len(END)} + length(url_encode(role)) + length(text)
            + length(text) - length(replace(text, '\', ''))
            + len(regexp_extract_all(text, '#')) - len(regexp_extract_all(text, '#+'))
            + len(regexp_extract_all(text, '</turn>')) AS chars
    FROM said
), first AS (
    SELECT conv_id, min(block) AS first FROM turns GROUP BY conv_id
), later AS (
    SELECT DISTINCT t.conv_id, t.block FROM turns t
    JOIN first f ON t.conv_id IS NOT DISTINCT FROM f.conv_id AND t.block > f.first
), earliest AS (
    SELECT * FROM turns WHERE role = '{SYSTEM}'
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) = 1
), shown AS (
    SELECT conv_id, block, kind, turn, role, text, cost, chars FROM turns
    UNION ALL
    SELECT t.conv_id, l.block, 1, turn, role, text, cost, chars FROM turns t
    JOIN later l ON t.conv_id IS NOT DISTINCT FROM l.conv_id AND t.block + 1 = l.block
    WHERE turn % {BLOCK} >= {BLOCK - HISTORY_TURNS} AND role <> '{SYSTEM}'
    UNION ALL
    SELECT e.conv_id, l.block, 0, turn, role, text, cost, chars FROM earliest e
    JOIN later l ON e.conv_id IS NOT DISTINCT FROM l.conv_id AND e.block < l.block
), summed AS (
    SELECT *, row_number() OVER o AS place,
        sum(CASE WHEN kind > 0 THEN cost ELSE 0 END) OVER o
            - coalesce(sum(cost) FILTER (kind = 1) OVER b, 0) AS done,
        role = '{SYSTEM}' AND sum(CASE WHEN role = '{SYSTEM}' THEN 1 ELSE 0 END) OVER o = 1 AS system
    FROM shown WINDOW b AS (PARTITION BY conv_id, block),
        o AS (PARTITION BY conv_id, block ORDER BY kind, turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
), roomed AS (
    SELECT *, done - CASE WHEN kind > 0 THEN cost ELSE 0 END AS start,
        greatest({BUDGET // 4}, {BUDGET - HISTORY} - coalesce(sum(cost) FILTER (system) OVER
            (PARTITION BY conv_id, block), 0)) AS room
    FROM summed
), slots AS (
    SELECT *, CASE WHEN kind = 2 THEN CAST(floor((done - 1) / room) AS BIGINT) END AS slot FROM roomed
), spans AS (
    SELECT *, CASE WHEN kind = 2 THEN slot * 2 + CASE WHEN floor(start / room) < slot
        OR max(done) OVER s - min(start) OVER s <= room THEN 0 ELSE 1 END END AS span
    FROM slots WINDOW s AS (PARTITION BY conv_id, block, slot)
), begun AS (
    SELECT conv_id, block, span, min(start) AS start, min(place) AS place FROM spans WHERE kind = 2 GROUP BY ALL
), repeated AS (
    SELECT b.conv_id, r.chars, r.system, row_number() OVER
        (PARTITION BY b.conv_id, b.block, b.span, r.system ORDER BY r.place DESC) AS back
    FROM begun b JOIN spans r ON b.conv_id IS NOT DISTINCT FROM r.conv_id AND b.block = r.block AND r.place < b.place
    WHERE r.system OR (r.role <> '{SYSTEM}' AND r.start >= b.start - {HISTORY})
), formatted AS (
    SELECT conv_id, chars FROM turns
    UNION ALL SELECT conv_id, chars FROM repeated WHERE system OR back <= {HISTORY_TURNS}
), chars AS (
    SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM formatted GROUP BY conv_id
), digests AS (
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{LEARNED}'), '') AS learned
    FROM turns GROUP BY conv_id
)
SELECT d.conv_id, n_turns, turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
    sha256(learned) AS loss_sha256, formatted_chars
FROM digests d JOIN chars c ON d.conv_id IS NOT DISTINCT FROM c.conv_id
"""
}
