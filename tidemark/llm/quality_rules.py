"""Quality rules: a table of thresholds compiled into one projection of ratios, without user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import LOWER, SPACE, UPPER

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
EDGE = ".,;:!?()\"'"
WINDOW_HASH = "xxhash64(get(words, i), get(words, i + 1), get(words, i + 2))"

# Frequent function words of the four languages.
STOP_WORDS = {
    "en": "a an and are as at be by for from had he his in is it of on or that the this to was were which with you",
    "fr": "au aux ce dans de des du elle en est et il la le les par pas pour qui que sur un une",
    "de": "auf das dem den der des die ein eine einen im in ist mit nicht sich sie und von zu",
    "es": "al como con de del el en es la las lo los no para por que se su un una y",
}


@dataclass(frozen=True)
class Rule:
    """Rows whose measure lies outside [least, most] are rejected; a null measure is inside."""

    measure: str
    least: float | None = None
    most: float | None = None

    def broken(self) -> Column:
        out = F.lit(False)
        if self.least is not None:
            out = out | (F.col(self.measure) < self.least)
        if self.most is not None:
            out = out | (F.col(self.measure) > self.most)
        return F.coalesce(out, F.lit(False))


DEFAULT_RULES = (
    Rule("n_words", least=50, most=1_000_000),
    Rule("mean_word_chars", least=2, most=14),
    Rule("symbol_ratio", most=0.1),
    Rule("alpha_ratio", least=0.6),
    Rule("stop_word_ratio", least=0.02),
    Rule("dup_line_ratio", most=0.5),
    Rule("repeat_word_ratio", most=0.5),
)


def repeat_words() -> list[tuple[str, str]]:
    """Steps (name, SQL) that count the words in three-word windows found twice or more, from words and n_words.

    A text whose windows have as many hashes as there are windows has none. Else the full 64-bit hashes are sorted
    with their positions, so equal windows are neighbours. Where neighbours of equal hash have unequal words, the
    text's windows are sorted by their words too; either way the count is exact.
    """
    beside = "coalesce({0} = {1}, false) or coalesce({0} = {2}, false)"
    by_hash = beside.format("x.h", "get(sorted, j - 1).h", "get(sorted, j + 1).h")
    by_words = beside.format("x.w", "get(told, j - 1).w", "get(told, j + 1).w")
    unlike = " or ".join(f"get(words, x.i + {k}) <> get(words, get(sorted, j + 1).i + {k})" for k in range(3))
    return [
        ("hashes", f"if(n_words < 3, cast(array() as array<bigint>), transform(sequence(0, cast(n_words as int) - 3), i -> {WINDOW_HASH}))"),
        ("sorted", "if(size(array_distinct(hashes)) = size(hashes), cast(array() as array<struct<h: bigint, i: int>>),"
                   " sort_array(transform(hashes, (h, i) -> struct(h as h, i as i))))"),
        ("told", "if(exists(transform(sorted, (x, j) -> coalesce(x.h = get(sorted, j + 1).h, false) and"
                 f" ({unlike})), x -> x), sort_array(transform(sorted, x -> struct(slice(words, x.i + 1, 3) as w, x.i as i))),"
                 " cast(array() as array<struct<w: array<string>, i: int>>))"),
        ("hits", f"sort_array(if(size(told) > 0, transform(filter(told, (x, j) -> {by_words}), x -> x.i),"
                 f" transform(filter(sorted, (x, j) -> {by_hash}), x -> x.i)))"),
        ("n_repeat_words", "aggregate(transform(hits, (p, j) -> least(3L, coalesce(get(hits, j + 1) - p, 3L))),"
                           " 0L, (a, x) -> a + x)"),
    ]


def _counted(text: Column, characters: str) -> Column:
    """How many of some ASCII characters a text has."""
    listed = "".join(f"\\x{ord(c):02x}" for c in characters)
    return F.regexp_count(text, F.lit(f"[{listed}]")).cast("long")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every whole text: words, their code points, symbols, repeated lines, repeated windows, stop words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    stops = sorted({w for line in STOP_WORDS.values() for w in line.split()})
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = docs.select(F.col(id_col).alias("doc_id"), F.array_remove(F.split(text, SPACE), "").alias("words"), lines.alias("lines"),
                     (F.length(text) - _counted(text, SPACES)).cast("long").alias("word_chars"),
                     _counted(text, SYMBOLS).alias("n_symbols"),
                     _counted(text, SYMBOLS + EDGE + "0123456789-_/\\+=@^~`[]{}").alias("_other"))
    # lower() and translate() of A-Z agree on these words: no other letter's lower case is an ASCII one but for k
    lower = F.lower if not any("k" in w for w in stops) else lambda w: F.translate(w, UPPER, LOWER)
    df = df.select("doc_id", "words", "word_chars", "n_symbols", (F.col("word_chars") - F.col("_other")).alias("n_letters"),
                   F.size("words").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
                   (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                   F.size(F.filter("words", lambda w: F.btrim(lower(w), F.lit(EDGE)).isin(stops))).cast("long").alias("n_stop_words"))
    for name, sql in repeat_words():
        df = df.withColumn(name, F.expr(sql))
    return df.drop("words", "hashes", "sorted", "told", "hits")


def ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part).cast("double") / F.col(whole))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """The counts, ``base_failed``, the names of broken rules, and ``kept``.

    base_failed: under 50 words, or more than half of the words in repeated windows. A document is kept if that does
    not hold and no rule is broken. Null or empty text has only zeros and fails; ids may be null or repeated, each
    row is judged by itself; other columns are not read; an empty table gives no rows.
    """
    df = measures(docs, id_col, text_col).select(
        "*", ratio("word_chars", "n_words").alias("mean_word_chars"),
        ratio("n_symbols", "n_words").alias("symbol_ratio"), ratio("n_letters", "word_chars").alias("alpha_ratio"),
        ratio("n_stop_words", "n_words").alias("stop_word_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("n_repeat_words", "n_words").alias("repeat_word_ratio"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    broken = F.concat_ws(",", *[F.when(r.broken(), F.lit(r.measure)) for r in rules])
    df = df.select("*", failed.alias("base_failed"), broken.alias("broken_rules"))
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("broken_rules") == ""))
