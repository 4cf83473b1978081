"""Quality rules over whole texts, with cross-document line frequency. DataFrame functions only.

Rules of a text: too few words, or too many of them in three-word windows that repeat.

Line frequency: the lines (only those of up to ``line_words`` words, if that is given) are
normalised (A-Z lower-cased, digits to 0, white space to one space) and hashed; for each host the documents with a line are counted. Documents of one host
with the same text count as one. A line is over the limit if more than ``limit`` documents and
more than ``share`` of the host's documents have it. Such lines are removed (``cleaned`` gives
the text without them), and a document that loses more than half of its words by that is rejected.

Texts are read where they are; only counts and hashes are shuffled. A frequent line is counted
before the shuffle, and equal texts are judged once.

Defined results: a null or empty text has no words and is rejected as too short. A null host
is a host of its own. Equal rows get equal results. Other columns are returned unchanged; the
new columns replace any of the same name. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.stage import carried, staged

#: ASCII white space, and the symbols that are counted.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz0000000000"
_GAP = r"[\x20\x09-\x0D]+"


def _bare(c: Column) -> Column:
    """A text without its white space."""
    return F.translate(c, SPACE, "")


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value worked out once a row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _GAP), lambda w: w != "")


def repeated_words(ws: Column) -> Column:
    """How many words lie in three-word windows that are found twice or more.

    The windows' hashes are sorted with their places, so that equal ones are neighbours.
    """
    def covered(s):
        same = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        return F.size(F.array_distinct(F.flatten(F.transform(same, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    def hashed(w):
        at = F.sequence(F.lit(0), F.size(w) - 3)
        return F.sort_array(F.transform(at, lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))

    return _let(ws, lambda w: F.when(F.size(w) < 3, 0).otherwise(_let(hashed(w), covered))).cast("long")


def repeated_lines(text: Column) -> Column:
    """How many lines with a word equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: _bare(x) != "")
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def lines_of(text: Column, line_words: int | None) -> Column:
    """The lines with a word, as structs of place, hash and words; with ``line_words``, those of at most so many words."""
    norm = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x, i: F.struct(i.alias("at"), F.trim(F.regexp_replace(F.translate(x, _UPPER, _LOWER), _GAP, " ")).alias("s")))
    counted = F.transform(F.filter(norm, lambda x: x["s"] != ""), lambda x: F.struct(
        x["at"].alias("at"), F.xxhash64(x["s"]).alias("line"), (F.char_length(x["s"]) - F.char_length(F.translate(x["s"], " ", "")) + 1).alias("words")))
    return counted if line_words is None else F.filter(counted, lambda x: x["words"] <= line_words)


def without_lines(text: Column, places: Column) -> Column:
    """The text without the lines at ``places``."""
    def left(lines):
        return F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places), lambda i: F.get(lines, i)), "\n")

    return _let(F.split(text, "\n"), left)


def judge(docs: DataFrame, host_col: str = "source", text_col: str = "text", line_words: int | None = None, limit: int = 10, share: float = 0.005,
          cleaned: bool = False) -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``n_removed_words`` (in lines over the limits) and ``kept``. ``line_words=None`` counts every line. ``cleaned`` adds
    ``kept_text``, the text without the lines over the limits (one that loses none is as it was). Jobs run when it is called."""
    new = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "kept", *["kept_text"] * cleaned)
    names, others = carried(docs, new)
    text, host = F.col(f"`{text_col}`"), F.col(f"`{host_col}`").cast("string")
    key = F.struct(host.alias("host"), F.xxhash64(text).alias("a"), F.hash(text).alias("b"))
    found = lines_of(text, line_words)
    found = found if cleaned else F.transform(found, lambda x: F.struct(x["line"].alias("line"), x["words"].alias("words")))
    texts = staged(docs.select(key.alias("_key"), found.alias("lines")).groupBy("_key").agg(F.first("lines").alias("lines")), "lines")
    hosts = texts.groupBy(F.col("_key.host").alias("host")).agg(F.count(F.lit(1)).alias("docs"))
    lines = texts.select("_key", F.explode("lines").alias("x")).select("_key", F.col("_key.host").alias("host"), "x.*")
    seen = texts.select(F.col("_key.host").alias("host"), F.explode(F.array_distinct("lines.line")).alias("line"))
    counts = seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    frequent = (counts.alias("c").join(hosts.alias("h"), F.col("c.host").eqNullSafe(F.col("h.host")))
                .where(F.col("n") > share * F.col("docs")).select("c.host", "c.line"))
    # Both are staged, so that Spark can split the rows of a line, or of a text, that a great part of a host has.
    frequent = staged(frequent, "frequent")
    removed = (lines.alias("l").join(frequent.alias("f"), F.col("l.host").eqNullSafe(F.col("f.host")) & (F.col("l.line") == F.col("f.line")))
               .groupBy(F.col("l._key").alias("_of")).agg(F.sum("words").cast("long").alias("_gone"), *[F.collect_list("at").alias("_places")] * cleaned))
    removed = staged(removed, "removed")
    ws = words(text)
    base = docs.select(others, key.alias("_key"),
                       _let(ws, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("again"))).alias("_words"),
                       F.coalesce(F.char_length(_bare(text)), F.lit(0)).cast("long").alias("word_chars"),
                       F.coalesce(F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, "")), F.lit(0)).cast("long").alias("n_symbols"),
                       repeated_lines(text).alias("n_dup_lines"), *[text.alias("_text")] * cleaned)
    n, again, gone = F.col("_words.n"), F.col("_words.again"), F.coalesce("_gone", F.lit(0))
    failed = (n < 50) | (again * 100 > n * 50)
    # One plan for every size: what is removed grows with the corpus, so it is never sent to all tasks.
    out = base.join(removed.hint("merge"), F.col("_key").eqNullSafe(F.col("_of")), "left")
    return out.select(*(F.col(f"others.`{c}`").alias(c) for c in names), n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", again.alias("n_repeat_words"),
                      failed.alias("base_failed"), gone.alias("n_removed_words"), (~failed & (gone * 2 <= n)).alias("kept"),
                      *[F.when(F.col("_places").isNull(), F.col("_text")).otherwise(without_lines(F.col("_text"), F.col("_places"))).alias("kept_text")] * cleaned)
