"""Personal data, and terms that give it away.

Patterns find e-mail and IP addresses, card and phone numbers. The corpus then tells which words
reveal such a value: over all lines, the pointwise mutual information of a word and a value of the
same line is compared with the information of the value itself. A word that holds at least
``DISCLOSED`` of it, and was seen with it in at least ``LEAST_TOGETHER`` different lines (copies are
one), is marked wherever it stands, in documents without the value as well. Marked spans are
generalised to their kind.

Everything is column functions and joins. Words and pairs are counted before they are shuffled, so that
a word or value in very many lines is one row of each task. Telling words meet the documents as one row
each, so that adaptive execution can split the documents of a frequent one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import documents, narrow, written

KINDS = ("email", "ip", "card", "phone", "term")
#: The kinds' patterns. A match begins where a run of its letters begins or the last match ended, so
#: that long runs are read once; possessive repeats keep them from being tried again.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold to be searched for a kind at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
TERM = r"[\p{L}\p{N}]{3,}"
LEAST_TOGETHER = 3
DISCLOSED = 0.9


def _luhn(digits: Column) -> Column:
    backward = F.reverse(digits)

    def weight(i: Column) -> Column:
        digit = F.substr(backward, i, F.lit(1)).cast("int")
        double = digit * 2
        return F.when(i % 2 == 1, digit).when(double > 9, double - 9).otherwise(double)

    total = F.aggregate(
        F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), lambda sum_, i: sum_ + weight(i)
    )
    return total % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    size = F.char_length(digits)
    if kind == "ip":
        return value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.when(size.between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return size.between(10, 15)
    return F.lit(True)


def _placed(text: Column, pattern: str, words: Column) -> Column:
    """Matches with their places in code points: what lies between them, and the matches, add up."""
    between = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long,value:string>>").alias("found"))

    def add(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.char_length(pair["gap"])
        end = begin + F.char_length(pair["word"])
        one = F.struct(begin.alias("start"), end.alias("end"), pair["word"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(one)).alias("found"))

    pairs = F.zip_with(
        F.slice(between, 1, F.size(words)), words,
        lambda gap, word: F.struct(gap.alias("gap"), word.alias("word")),
    )
    return F.aggregate(pairs, start, add)["found"]


def _of_kind(text: Column, number: int) -> Column:
    kind = KINDS[number]
    pattern = PATTERNS[kind]
    found = _placed(text, pattern, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))

    def named(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"), F.lit(number).alias("kind"),
            s["end"].alias("end"), s["value"].alias("value"),
        )

    return F.transform(F.filter(found, lambda s: _holds(kind, s["value"])), named)


def _count(number: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")


def _base_spans(text: Column) -> Column:
    """array<struct<start, kind number, end, value>> of all base kinds, in order."""
    none = F.array().cast("array<struct<start:long,kind:int,end:long,value:string>>")
    every = [
        F.when(text.rlike(HINTS[kind]), _of_kind(text, number)).otherwise(none)
        for number, kind in enumerate(KINDS[:4])
    ]
    return F.array_sort(F.concat(*every))


def _written_out(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def _outside(text: Column, spans: Column) -> Column:
    """The text without its spans, a line end in place of each."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def add(state: Column, s: Column) -> Column:
        gap = F.substr(text, state["at"].cast("int") + 1, F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        end = F.greatest(s["end"], state["at"])
        return F.struct(end.alias("at"), F.concat(state["out"], gap, F.lit("\n")).alias("out"))

    state = F.aggregate(spans, start, add)
    return F.concat(state["out"], F.substr(text, state["at"].cast("int") + 1, F.char_length(text)))


def _telling_words(rows: DataFrame, together: int, disclosed: float) -> DataFrame:
    """value and the terms that disclose it."""
    lines = rows.select(F.explode(F.split("text", "\n", -1)).alias("line"))
    meetings = (
        lines.where(F.col("line").rlike("[0-9@]"))
        .groupBy("line")
        .agg(F.count("*").alias("times"))
        .withColumn("base", _base_spans(F.col("line")))
        .where(F.size("base") > 0)
        .select(
            "times", F.array_distinct("base.value").alias("values"),
            _outside(F.col("line"), F.col("base")).alias("line"),
        )
    )
    meetings = written(meetings, "meetings")
    values = meetings.select("times", F.explode("values").alias("value")).groupBy("value")
    values = values.agg(F.count("*").alias("apart"), F.sum("times").alias("n_value"))
    values = written(values.where(F.col("apart") >= together).select("value", "n_value"), "values")
    pairs = (
        meetings.select("line", "times", F.explode("values").alias("value"))
        .join(values.select("value"), "value", "left_semi")
        .select("value", "times", F.explode(_terms(F.col("line"))).alias("term"))
        .groupBy("value", "term")
        .agg(F.count("*").alias("apart"), F.sum("times").alias("n_both"))
        .where(F.col("apart") >= together)
    )
    pairs = written(pairs, "pairs")
    words = lines.select(F.explode(_terms(F.col("line"))).alias("term")).groupBy("term")
    words = words.agg(F.count("*").alias("n_term"))
    total = float(lines.count())
    bits = F.log2(F.lit(total) * F.col("n_both") / (F.col("n_term") * F.col("n_value")))
    own = F.log2(F.lit(total) / F.col("n_value"))
    return (
        pairs.join(words, "term")
        .join(values, "value")
        .where((own > 0) & (bits >= disclosed * own))
        .select("value", "term")
    )


def find_personal(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    together: int = LEAST_TOGETHER,
    disclosed: float = DISCLOSED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, h (hash of the text), base and spans, arrays in order.

    A span has start, kind (a number into KINDS), end and value; places are code points, end
    exclusive. ``base`` holds what the patterns find, ``spans`` the telling words as well. Null and
    empty texts have no spans. Rows repeated with id and text get equal spans. Spans of different
    kinds may overlap. An empty table gives no rows.
    """
    rows = narrow(docs, id_col, text_col)
    based = rows.withColumn("h", F.xxhash64("text")).withColumn(
        "base",
        F.when(F.col("text").rlike("[0-9@]"), _base_spans(F.col("text"))).otherwise(
            F.array().cast("array<struct<start:long,kind:int,end:long,value:string>>")
        ),
    )
    held = written(based.select("doc_id", "h", "base"), "personal")
    telling = written(_telling_words(rows, together, disclosed).select("term").distinct(), "telling")
    told = (
        rows.select("doc_id", F.xxhash64("text").alias("h"), F.explode(_terms(F.col("text"))).alias("term"))
        .join(telling, "term")
        .groupBy(F.col("doc_id").alias("of_id"), F.col("h").alias("of_h"))
        .agg(F.collect_set("term").alias("terms"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("h") == F.col("of_h"))
    texts = based.join(written(told, "told"), same).dropDuplicates(["doc_id", "h"])
    words = F.regexp_extract_all("text", F.lit(TERM), F.lit(0))
    so_far = Window.partitionBy("doc_id", "h").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.char_length("w.gap") + F.char_length("w.word")).over(so_far)
    inside = lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start"))
    marked = (
        texts.withColumn("between", F.slice(F.split("text", TERM, -1), F.lit(1), F.size(words)))
        .select(
            "doc_id", "h", "terms", "base",
            F.posexplode(
                F.zip_with("between", words, lambda g, w: F.struct(g.alias("gap"), w.alias("word")))
            ).alias("i", "w"),
        )
        .withColumn("end", end.cast("long"))
        .withColumn("start", F.col("end") - F.char_length("w.word"))
        .where(F.array_contains("terms", F.lower("w.word")) & ~F.exists("base", inside))
        .groupBy(F.col("doc_id").alias("of_id"), F.col("h").alias("of_h"))
        .agg(
            F.collect_list(
                F.struct("start", F.lit(4).alias("kind"), "end", F.col("w.word").alias("value"))
            ).alias("more")
        )
    )
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(
        F.array_sort(F.concat("base", F.col("more")))
    )
    return held.join(marked, same, "left").select("doc_id", "h", "base", spans.alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """doc_id and text with every span replaced by its kind; of overlapping spans the first counts."""
    found = find_personal(docs).select(F.col("doc_id").alias("of_id"), F.col("h").alias("of_h"), "spans")
    rows = narrow(docs).withColumn("h", F.xxhash64("text"))
    joined = rows.join(
        found.dropDuplicates(["of_id", "of_h"]),
        F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("h") == F.col("of_h")),
    )
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def add(state: Column, s: Column) -> Column:
        gap = F.substr("text", state["at"].cast("int") + 1, (s["start"] - state["at"]).cast("int"))
        return F.when(s["start"] < state["at"], state).otherwise(
            F.struct(s["end"].alias("at"), F.concat(state["out"], gap, F.get(names, s["kind"])).alias("out"))
        )

    state = F.aggregate("spans", start, add)
    rest = F.substr("text", state["at"].cast("int") + 1, F.char_length("text"))
    return joined.select("doc_id", F.concat(state["out"], rest).alias("text"))


def op9_personal(spark, sf_dir: str) -> DataFrame:
    found = find_personal(documents(spark, sf_dir))
    counts = [
        _count(number).alias(f"n_{kind}") for number, kind in enumerate(KINDS[:4])
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_written_out(F.col("base")), 256).alias("base_sha256"),
        _written_out(F.col("spans")).alias("spans"),
    )


QUERIES = {"op9_personal": op9_personal}
SQL: dict[str, str] = {}
