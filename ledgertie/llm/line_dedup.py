"""Line deduplication up to an edit distance of one, by deletion neighbourhoods.

Lines within one edit of each other have an equal variant: the line itself or the line
without one character. Lines that differ in one character also lack it at the same
place. So every line's variants are hashed, lines meet on equal variants, the variants
are compared letter by letter, and the earliest line stays. A group of equal variants is folded
to its earliest line, never to pairs.

Long lines have as many variants as characters. A line is therefore hashed as the
exclusive or of a hash per word and place, which changes by one word for a character
and by two for a blank; running values give every variant in constant time. Words of more
than ``LONG_WORD`` characters are hashed in the same way from their characters. And only
lines that share a half with another line get variants: one edit leaves a half intact.

Everything is DataFrame functions. A line counts without blanks, tabs and carriage
returns around it. It goes if an earlier line equals it, whatever its length unless it is
empty, and from ``min_chars`` on also if an earlier one is within one edit. Order is by
document id, null first, then by the hash of the text and the row's number, then by line;
every row is judged by itself, also where ids are null or repeated. Defined results: a null
text stays null; an empty one stays empty; a text that loses all lines becomes empty; an
empty table gives an empty one. Other columns stay as they are, and new ones take other
names if the table has theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgertie.llm.tables import free_name, materialise, numbered
from ledgertie.sources.session import passing_tables

MIN_CHARS = 20
LONG_WORD = 32


def _xor(a: Column, *others: Column) -> Column:
    for b in others:
        a = a.bitwiseXOR(b)
    return a


def _split(text: Column) -> Column:
    return F.split(text.cast("string"), "\n", -1)


def _lines(docs: DataFrame) -> DataFrame:
    """A row per line that counts: row, place, and a 128-bit name of its text.

    ``docs`` has the columns doc, text and row.
    """
    split = docs.select(
        "doc", "row", F.xxhash64("text").alias("t"), F.posexplode(_split(F.col("text"))).alias("no", "raw")
    )
    line = F.btrim(F.col("raw"), F.lit(" \t\r"))
    held = split.select(F.struct("doc", "t", "row", "no").alias("place"), line.alias("line"))
    return held.filter(F.length("line") > 0).select(
        "place",
        "line",
        F.xxhash64("line").alias("h"),
        F.xxhash64(F.lit("second"), "line").alias("g"),
    )


def _sharing_a_half(lines: DataFrame) -> DataFrame:
    """Lines whose first or last half some other line has, among those of like length.

    Of two lines one edit apart, with the shorter ``n`` characters long, the first or
    the last ``n / 2`` characters agree.
    """
    size = F.length("line")

    def halves(length: Column) -> list[Column]:
        half = F.floor(length / 2).cast("int")
        return [
            F.xxhash64(length, F.lit("first"), F.left(F.col("line"), half)),
            F.xxhash64(length, F.lit("last"), F.right(F.col("line"), half)),
        ]

    keys = lines.select(
        "h", F.explode(F.array(*halves(size), *halves(size - 1))).alias("key")
    )
    shared = (
        keys.groupBy("key")
        .agg(F.min("h").alias("low"), F.max("h").alias("high"))
        .filter("low <> high")
        .select("key")
    )
    return keys.join(shared, "key", "left_semi").select("h").distinct()


def _word_hash(word: Column) -> Column:
    letters = F.transform(F.split(word, ""), lambda letter, i: F.xxhash64(i, letter))
    long = F.aggregate(letters, F.lit(0).cast("long"), lambda held, x: held.bitwiseXOR(x))
    return F.when(F.length(word) <= LONG_WORD, F.xxhash64(word)).otherwise(long)


def _shorter_words(words: DataFrame) -> DataFrame:
    """Each word of each line without one of its characters: the hash, and the place in the word."""
    size = F.length("word")
    rest = F.concat(F.expr("substring(word, 1, cut - 1)"), F.expr("substring(word, cut + 1)"))
    short = words.filter(size.between(1, LONG_WORD + 1)).select(
        "*", F.explode(F.sequence(F.lit(1), size)).alias("cut")
    )
    short = short.withColumn("left_over", F.xxhash64(rest))
    letters = words.filter(size > LONG_WORD + 1).select(
        "*", F.posexplode(F.split("word", "")).alias("i", "letter")
    )
    word = Window.partitionBy("h", "at")
    until = word.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    here, moved = F.xxhash64("i", "letter"), F.xxhash64(F.col("i") - 1, "letter")
    long = letters.withColumns(
        {
            "cut": F.col("i") + 1,
            "left_over": _xor(
                F.bit_xor(here).over(until),
                here,
                F.bit_xor(moved).over(word),
                F.bit_xor(moved).over(until),
            ),
        }
    )
    return short.unionByName(long.drop("i", "letter"))


def _variants(lines: DataFrame) -> DataFrame:
    """All lines and their deletion variants: hash, length, place of the deletion."""
    words = lines.select(
        "h", "first", "size", F.posexplode(F.split("line", " ", -1)).alias("at", "word")
    )
    words = words.withColumn("name", _word_hash(F.col("word")))
    line = Window.partitionBy("h")
    before = line.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    here, moved = F.xxhash64("at", "name"), F.xxhash64(F.col("at") - 1, "name")
    none = F.lit(0).cast("long")
    known = words.withColumns({"here": here, "moved": moved}).withColumns(
        {
            "start": F.coalesce(F.sum(F.length("word") + 1).over(before), none),
            "before": F.coalesce(F.bit_xor("here").over(before), none),
            "moved_before": F.coalesce(F.bit_xor("moved").over(before), none),
            "whole": F.bit_xor("here").over(line),
            "moved_whole": F.bit_xor("moved").over(line),
            "next": F.lead("word").over(line.orderBy("at")),
            "next_name": F.lead("name").over(line.orderBy("at")),
        }
    )
    inside = _shorter_words(known.select("h", "first", "size", "at", "word", "whole", "here", "start"))
    inside = inside.select(
        "h",
        "first",
        _xor(F.col("whole"), F.col("here"), F.xxhash64("at", "left_over")).alias("key"),
        (F.col("size") - 1).alias("length"),
        (F.col("start") + F.col("cut")).alias("place"),
    )
    after = _xor(
        F.col("moved_whole"), F.col("moved_before"), F.col("moved"), F.xxhash64("at", "next_name")
    )
    joined = F.xxhash64("at", _word_hash(F.concat("word", "next")))
    blanks = known.filter(F.col("next").isNotNull()).select(
        "h",
        "first",
        _xor(F.col("before"), joined, after).alias("key"),
        (F.col("size") - 1).alias("length"),
        (F.col("start") + F.length("word") + 1).alias("place"),
    )
    itself = known.filter("at = 0").select(
        "h",
        "first",
        F.col("whole").alias("key"),
        F.col("size").alias("length"),
        F.lit(None).cast("long").alias("place"),
    )
    return inside.unionByName(blanks).unionByName(itself)


def _without(text: str, cut: str) -> str:
    """SQL for a text without the character at ``cut``, or whole where that is null."""
    return f"concat(left({text}, coalesce({cut} - 1, length({text}))), substring({text}, coalesce({cut} + 1, length({text}) + 1)))"


def _earlier_neighbours(lines: DataFrame) -> DataFrame:
    """Lines with the earliest line within one edit, where that is earlier (h, near)."""
    variants = _variants(lines)
    alike = Window.partitionBy("key", "length")
    own = F.struct("first", "h", "place")
    deleted, kept = F.col("place").isNotNull(), F.col("place").isNull()
    met = variants.withColumns(
        {
            "swapped": F.min(F.when(deleted, own)).over(
                Window.partitionBy("key", "length", "place")
            ),
            "shorter": F.min(F.when(kept, own)).over(alike),
            "longer": F.min(F.when(deleted, own)).over(alike),
        }
    )
    # a deletion meets deletions at its place and the line that it makes; a line meets all
    candidate = F.explode(
        F.when(deleted, F.array("swapped", "shorter")).otherwise(F.array("longer"))
    )
    pairs = (
        met.select("h", "first", "place", candidate.alias("other"))
        .filter(F.col("other")["first"] < F.col("first"))
        .select(
            "h",
            F.col("other")["h"].alias("other"),
            F.col("other")["first"].alias("near"),
            F.col("place").cast("int").alias("cut"),
            F.col("other")["place"].cast("int").alias("other_cut"),
        )
        .distinct()
    )
    texts = lines.select("h", "line")
    others = texts.select(F.col("h").alias("other"), F.col("line").alias("text"))
    same = F.expr(f"{_without('line', 'cut')} = {_without('text', 'other_cut')}")
    verified = pairs.join(texts, "h").join(others, "other").filter(same)
    return verified.groupBy("h").agg(F.min("near").alias("near"))


def _cuts(lines: DataFrame, min_chars: int) -> DataFrame:
    """Lines that come more than once or have an earlier neighbour, and the one that stays."""
    long = lines.filter(F.length("line") >= min_chars)
    sharing = materialise(_sharing_a_half(long), "sharing")
    distinct = long.groupBy("h", "g").agg(F.min("place").alias("first"), F.max("line").alias("line"))
    compared = materialise(
        distinct.join(sharing, "h", "left_semi").withColumn("size", F.length("line")), "compared"
    )
    near = materialise(_earlier_neighbours(compared), "near")
    near = compared.join(near, "h").select("h", "g", F.col("near").alias("first"))
    repeated = lines.groupBy("h", "g").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    repeated = repeated.filter("n > 1").drop("n")
    cuts = near.unionByName(repeated).groupBy("h", "g").agg(F.min("first").alias("keeps"))
    return materialise(cuts, "cuts", lasting=True)


def removed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Lines of (doc, text, row) that an earlier line equals, long ones up to one edit (row, no)."""
    lines = _lines(docs)
    with passing_tables(docs.sparkSession):
        cuts = _cuts(lines, min_chars)
    later = lines.select("h", "g", "place").join(cuts, ["h", "g"])
    later = later.filter(F.col("place") > F.col("keeps"))
    return later.select(F.col("place")["row"].alias("row"), F.col("place")["no"].alias("no"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """``docs`` without repeated lines, and the numbers of lines and of removed ones.

    A line goes if an earlier one, of any row, is equal, or from ``min_chars`` characters
    on within one edit of it, whether or not that one stays itself.
    """
    names = ["_row", "_gone", "_lines", "n_lines", "n_removed"]
    row, gone, lines, n_lines, n_removed = (free_name(docs, name) for name in names)
    rows = numbered(docs, row)
    text = F.col(f"`{text_col}`")
    own = rows.select(
        F.col(f"`{id_col}`").alias("doc"), text.cast("string").alias("text"), F.col(row).alias("row")
    )
    removed = removed_lines(own, min_chars).groupBy(F.col("row").alias(f"{row}_of"))
    removed = removed.agg(F.collect_set("no").alias(gone))
    told = rows.join(removed, F.col(row) == F.col(f"{row}_of"), "left")
    told = told.withColumn(lines, _split(text))
    total, lost = F.size(lines), F.coalesce(F.size(gone), F.lit(0))
    stay = F.array_except(F.sequence(F.lit(0), total - 1), F.col(gone))
    rest = F.array_join(F.transform(stay, lambda i: F.col(lines)[i]), "\n")
    kept = F.when(F.col(gone).isNull(), text).otherwise(rest)
    columns = [
        kept.alias(name) if name == text_col else F.col(f"`{name}`") for name in docs.columns
    ]
    return told.select(
        *columns,
        F.when(F.col(lines).isNull(), 0).otherwise(total).cast("long").alias(n_lines),
        lost.cast("long").alias(n_removed),
    )
