"""Line-first cleaning in DataFrame functions: every line is judged, failing lines go, then documents that lost too much.

Nothing leaves the JVM and nothing is shuffled: each text is split into lines and words inside its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8  # words of a window that should not repeat
LEAST_WORDS = 20
REPEAT_PERCENT = 30
LOST_PERCENT = 50  # of a document's words
SYMBOL_PERCENT = 10  # of a line's characters
SHORT_LINE = 5  # words; a shorter line needs an end mark

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
# Latin marks, then sentence ends and closing marks of other scripts (CJK, full width, Arabic, Urdu, Devanagari, Armenian, Ethiopic,
# Khmer, Myanmar, Tibetan)
END_MARK = (
    r"[.!?:;\x{2026}\"'\x{201D}\x{2019}\x{BB})\]"
    r"\x{3002}\x{FF0E}\x{FF61}\x{FF01}\x{FF1F}\x{FF1A}\x{FF1B}\x{300D}\x{300F}\x{FF63}\x{FF09}\x{3011}\x{3009}\x{300B}\x{203C}\x{203D}\x{2047}-\x{2049}"
    r"\x{061F}\x{061B}\x{06D4}\x{0964}\x{0965}\x{0589}\x{1362}\x{1367}\x{1368}\x{17D4}\x{17D5}\x{104A}\x{104B}\x{0F0D}\x{0F0E}]"
    r"[\x20\x09-\x0D]*$"
)
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]"
SHORT_UNSPACED = 10  # characters of a script without spaces that make up for SHORT_LINE words
SEPARATOR = r"(?:^|\s)[|\x{BB}\x{203A}>\x{B7}\x{2022}](?=\s|$)"
SEPARATED_SHARE = 4  # words for each separator, at most, make a menu
STUTTER = r"(?:^|\s)(\S+)(?:\s+\1){4}(?=\s|$)"  # one word five times on end
#: What menus and page furniture say, in lower case.
NAVIGATION = (
    r"^\W*(home|menu|search|login|log in|sign in|sign up|next|previous|back to top|read more|share|share this|contact us"
    r"|about us|site map|sitemap|skip to content)\W*$"
)
BOILERPLATE = (
    r"cookie policy|uses cookies|accept cookies|privacy policy|terms of use|terms of service|all rights reserved"
    r"|enable javascript|lorem ipsum|subscribe to our newsletter|click here to"
)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _counted(line: Column) -> Column:
    return F.struct(line.alias("line"), F.regexp_count(line, F.lit(WORD)).alias("n"))


def _fails(line: Column, n: Column) -> Column:
    """Whether a line with ``n`` words breaks a rule; one without words never does."""
    low = F.lower(line)
    symbols = F.regexp_count(line, F.lit(SYMBOL)) * 100 > F.length(line) * SYMBOL_PERCENT
    unfinished = (n < SHORT_LINE) & ~line.rlike(END_MARK) & (F.regexp_count(line, F.lit(UNSPACED)) < SHORT_UNSPACED)
    shouted = (n >= SHORT_LINE) & (F.upper(line) == line) & (low != line)
    separated = (n > SHORT_LINE) & (F.regexp_count(line, F.lit(SEPARATOR)) * SEPARATED_SHARE >= n)
    furniture = low.rlike(NAVIGATION) | low.rlike(BOILERPLATE)
    return (n > 0) & (symbols | unfinished | shouted | separated | furniture | line.rlike(STUTTER))


def _covered(ordered: Column) -> Column:
    """Words inside windows that occur more than once; ``ordered`` has (hash, place) of all windows, sorted."""
    n = F.size(ordered)
    twins = F.zip_with(
        F.slice(ordered, 1, n - 1), F.slice(ordered, 2, n - 1), lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i))
    )
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda x: x.isNotNull()))))
    begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(
        starts, begin, lambda s, i: F.struct(i.alias("last"), (s.n + F.least(i - s["last"], F.lit(WINDOW))).alias("n")), lambda s: s.n
    )


def judge_lines(docs: DataFrame, text: str = "text", into: str = "rules") -> DataFrame:
    """``docs`` with a struct column ``into`` (it replaces a column of that name).

    Its fields: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``n_bad_lines``, ``n_words_lost``, ``clean_text`` and ``kept``. A null or empty text has no words, fails and has an
    empty clean text; repeated rows are judged one by one.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    split = docs.withColumns({"__words": _words(body), "__lines": F.split(body, "\n")})
    # eight hashed words at every place; equal windows have equal hashes
    at = F.sequence(F.lit(1), F.size("__words") - (WINDOW - 1))
    windows = F.when(F.size("__words") > WINDOW, F.transform(at, lambda i: F.xxhash64(F.slice("__words", i, WINDOW))))
    counted = split.withColumns(
        {
            "__windows": windows,
            "__counted": F.transform("__lines", _counted),
            "__n": F.size("__words"),
            "__chars": F.length(F.array_join("__words", "")),
        }
    ).drop("__words", "__lines")
    again = F.size(F.array_distinct("__windows")) < F.size("__windows")
    places = F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    judged = counted.withColumns(
        {
            "__ordered": F.when(again, F.sort_array(places)),
            "__judged": F.transform(
                "__counted", lambda x: F.struct(x.line.alias("line"), x.n.alias("n"), _fails(x.line, x.n).alias("fails"))
            ),
        }
    ).drop("__windows", "__counted")
    repeats = judged.withColumns(
        {
            "__repeats": F.when(F.col("__ordered").isNotNull(), _covered(F.col("__ordered"))).otherwise(0),
            "__full": F.transform(F.filter("__judged", lambda x: x.n > 0), lambda x: x.line),
            "__lost": F.aggregate(F.filter("__judged", lambda x: x.fails), F.lit(0), lambda s, x: s + x.n),
        }
    ).drop("__ordered")
    n, rep, lost = F.col("__n"), F.col("__repeats"), F.col("__lost")
    failed = (n < LEAST_WORDS) | (rep * 100 > n * REPEAT_PERCENT)
    rules = F.struct(
        n.cast("long").alias("n_words"),
        F.col("__chars").cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("__full") - F.size(F.array_distinct("__full"))).cast("long").alias("n_dup_lines"),
        rep.cast("long").alias("n_repeat_words"),
        failed.alias("base_failed"),
        F.size(F.filter("__judged", lambda x: x.fails)).cast("long").alias("n_bad_lines"),
        lost.cast("long").alias("n_words_lost"),
        F.array_join(F.transform(F.filter("__judged", lambda x: ~x.fails), lambda x: x.line), "\n").alias("clean_text"),
        (~failed & (lost * 100 <= n * LOST_PERCENT)).alias("kept"),
    )
    return repeats.withColumn(into, rules).drop("__judged", "__n", "__chars", "__repeats", "__full", "__lost")


def kept_documents(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """Rows that stay, all columns, their text without the failing lines (and ``n_chars`` counted anew where there is one)."""
    packed = docs.select(F.struct("*").alias("__doc"), F.col(text).alias("__text"))
    judged = judge_lines(packed, "__text", "__rules")
    clean = F.col("__rules.clean_text")
    changes = {text: clean} | ({n_chars: F.length(clean).cast(docs.schema[n_chars].dataType)} if n_chars in docs.columns else {})
    row = F.struct(*(changes.get(c, F.col(f"__doc.`{c}`")).alias(c) for c in docs.columns))
    # a filter would be pushed below the steps above and repeat them all for its own sake; an exploded array is not
    return judged.select(F.explode(F.when(F.col("__rules.kept"), F.array(row))).alias("row")).select("row.*")
