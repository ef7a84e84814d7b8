"""Quality rules from line frequencies across documents, in DataFrame functions only.

Lines are normalised (lower case, digits to 0, single blanks) and hashed.  Per
host, the distinct documents that hold a line are counted; a line above the
limit is boilerplate and is removed, and a document of which too little is left
is rejected.  Exact copies of one document are no evidence of boilerplate:
documents are told apart by a hash of their whole text, for the lines and for the
size of the host alike.  Near copies count one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockside.llm.common import BLANK_CLASS, BLANKS, let, row_key, settled, whole_text


@dataclass(frozen=True)
class LineLimits:
    """A line is removed in a host where more documents hold it than both limits allow."""

    documents: int = 20
    share: float = 0.005
    #: A document is rejected when fewer than this share of its words is left.
    words_left: float = 0.5


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK_CLASS + "+"), lambda w: w != "")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.length(without(line, BLANKS)) > 0)


def normal_line(line: Column) -> Column:
    """One line as it is compared across documents."""
    plain = F.translate(F.lower(line), "123456789\t\x0b\x0c\r", "000000000    ")
    return F.trim(F.regexp_replace(plain, "  +", " "))


def repeated_window_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text.

    Windows are sorted by hash, then place; equal neighbours are repeats.  Their
    places in order give the words they cover: three each, less the overlaps.
    """
    n = F.size(words)
    windows = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("at")
        ),
    )

    def is_repeat(ordered: Column, one: Column, i: Column) -> Column:
        before, after = F.get(ordered, i - 1)["h"], F.get(ordered, i + 1)["h"]
        return F.coalesce(one["h"] == before, F.lit(False)) | F.coalesce(one["h"] == after, F.lit(False))

    def places(ordered: Column) -> Column:
        repeats = F.filter(ordered, lambda one, i: is_repeat(ordered, one, i))
        return F.array_sort(F.transform(repeats, lambda one: one["at"]))

    def covered(found: Column) -> Column:
        gaps = F.transform(found, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(found, i + 1) - at, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    return F.when(n < 4, F.lit(0)).otherwise(let(F.array_sort(windows), lambda s: let(places(s), covered)))


def measured(text: Column) -> dict[str, Column]:
    """The base columns of a text."""
    lines = lines_with_words(text)
    marked = F.length(text) - F.length(without(text, "#*$%&|<>"))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            repeated_window_words(words).cast("bigint").alias("n_repeat_words"),
        )

    return {
        "_words": let(words_of(text), of_words),
        "word_chars": F.length(without(text, BLANKS)).cast("bigint"),
        "n_symbols": marked.cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
    }


def hashed_lines(text: Column) -> Column:
    """Per line with words: hash of its normal form, and its words."""
    return F.transform(
        lines_with_words(text),
        lambda line: F.struct(
            F.xxhash64(normal_line(line)).alias("line"), F.size(words_of(line)).cast("bigint").alias("words")
        ),
    )


def frequent_lines(hashed: DataFrame, limits: LineLimits) -> DataFrame:
    """(host, line) above the limits, from each document's host, content hash and lines.

    Distinct documents are first combined per line and document, so a line or a
    host with a third of all rows is spread over many tasks.
    """
    hosts = hashed.groupBy("host").agg(F.count_distinct("content").alias("host_documents"))
    distinct = F.array_distinct(F.transform(F.col("lines"), lambda x: x["line"]))
    each = hashed.select("host", "content", F.explode(distinct).alias("line"))
    per_line = each.groupBy("host", "line").agg(F.count_distinct("content").alias("documents"))
    often = per_line.where(F.col("documents") > limits.documents)
    limit = F.greatest(F.lit(limits.documents), F.col("host_documents") * limits.share)
    return often.join(hosts, "host").where(F.col("documents") > limit).select("host", "line")


RULES = "__rules"


def line_rules(documents: DataFrame, host: str = "source", limits: LineLimits = LineLimits()) -> DataFrame:
    """All rows and columns of ``documents`` with the verdict in a struct ``__rules``.

    The struct holds the base columns, ``removed`` (hashes of removed lines),
    ``words_removed``, ``base_failed`` and ``kept``.  A missing text counts as
    empty and fails the base rule; documents without a host share one; rows that
    repeat are judged alike; an empty table gives no rows.

    Lines are shuffled as hashes and combined in the map tasks; a line or a host
    with a third of all rows is spread by its documents before it is counted.
    Texts are shuffled only if the caller selects them.
    """
    text = whole_text()
    source = F.coalesce(F.col(host).cast("string"), F.lit("")) if host in documents.columns else F.lit("")
    keys = [F.xxhash64("doc_id", text, source).alias("__key"), F.hash(text, "doc_id").alias("__more")]
    lines = documents.select(*keys, source.alias("host"), F.xxhash64(text).alias("content"), hashed_lines(text).alias("lines"))
    hashed = settled(lines, "lines")
    frequent = settled(frequent_lines(hashed, limits), "frequent")
    held = hashed.select("__key", "__more", "host", F.posexplode("lines").alias("at", "l"))
    removed = (
        held.select("__key", "__more", "host", "at", "l.line", "l.words")
        .join(frequent, ["host", "line"])
        # Rows that repeat bring the same lines at the same places.
        .groupBy("__key", "__more", "at")
        .agg(F.max("line").alias("line"), F.max("words").alias("words"))
        .groupBy("__key", "__more")
        .agg(F.collect_set("line").alias("removed"), F.sum("words").alias("words_removed"))
    )
    base = measured(text)
    rows = documents.select("*", *keys, F.struct(*[c.alias(n) for n, c in base.items()]).alias("__base"))
    n_words, repeats = F.col("__base._words.n_words"), F.col("__base._words.n_repeat_words")
    gone = F.coalesce("words_removed", F.lit(0)).cast("bigint")
    failed = (n_words < 50) | (100 * repeats > 50 * n_words)
    verdict = F.struct(
        n_words.alias("n_words"),
        *[F.col(f"__base.{n}").alias(n) for n in base if n != "_words"],
        repeats.alias("n_repeat_words"),
        F.col("removed").alias("removed"),
        gone.alias("words_removed"),
        failed.alias("base_failed"),
        (~failed & (n_words - gone >= limits.words_left * n_words)).alias("kept"),
    )
    found = rows.join(removed.alias("found"), ["__key", "__more"], "left")
    return found.select(*[F.col(f"`{c}`") for c in documents.columns], verdict.alias(RULES))


def cleaned_text(removed: Column) -> Column:
    """The text without the lines whose hashes are ``removed``."""
    lines = F.split(whole_text(), "\n")
    stays = F.filter(lines, lambda line: ~F.array_contains(removed, F.xxhash64(normal_line(line))))
    return F.when(F.size(removed) > 0, F.array_join(stays, "\n")).otherwise(F.col("text"))


def kept_documents(documents: DataFrame, host: str = "source", limits: LineLimits = LineLimits()) -> DataFrame:
    """The documents that pass, in their own columns, without their frequent lines.

    Missing and empty texts fail; very long ones are judged whole; rows that repeat
    are judged alike; a line exactly at a limit stays; an empty table gives no rows.
    """
    rows = line_rules(documents, host, limits).where(F.col(f"{RULES}.kept"))
    text = cleaned_text(F.coalesce(F.col(f"{RULES}.removed"), F.array().cast("array<bigint>")))
    changed = {"text": text}
    if "n_chars" in documents.columns:
        changed["n_chars"] = F.length(text).cast(documents.schema["n_chars"].dataType)
    return rows.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in documents.columns])
