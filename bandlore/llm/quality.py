"""Line-first cleaning with DataFrame functions only.

Every line is judged by rules on punctuation, navigation and boilerplate; failing lines are removed. A document that
loses more than half of its words, or fails the base rules on the whole text, is rejected. All rules look at one
document, so there is no shuffle, and a lost executor costs its own rows only.
"""

from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
#: Most share of a line's words that carry doubled marks or stray symbols.
MARKED = 0.3
#: Separators per word from which a line counts as navigation, and the fewest separators.
SEPARATORS, FEWEST = 0.25, 3
#: Longest line, in words, that a boilerplate phrase condemns. Longer ones may discuss it.
BOILERPLATE_WORDS = 30
#: Most share of words that cleaning may take from a kept document.
LOST = 0.5
BOILERPLATE = (
    r"(?i)\b(all rights reserved|copyright \(c\)|cookie policy|privacy policy|terms of (use|service)|"
    r"(licensed|released) under|subscribe to our|sign up for|log in to|enable javascript|click here|read more|"
    r"share this|follow us|skip to content|back to top)\b"
)


def _let(value, use):
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _words(text):
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def _marked(word):
    return word.rlike(r"([!?#*$%&|<>~=_^])\1|[#*$%&<>~^]$")


def line_fails(line):
    """Whether a line with words is removed."""

    def judged(words):
        n = F.size(words)
        marked = F.size(F.filter(words, _marked))
        separators = F.size(F.filter(words, lambda w: w.rlike(r"^[|»›>·•]+$")))
        navigation = (separators >= FEWEST) & (separators >= SEPARATORS * n)
        boilerplate = (n <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE)
        return (marked > MARKED * n) | navigation | boilerplate

    return _let(_words(line), judged)


def _covered(words):
    """Number of words inside three-word windows that the text holds twice or more."""

    def windows(n):
        return F.sequence(F.lit(0), n - 3)

    def repeated(sorted_windows):
        def same(i, j):
            a, b = F.get(sorted_windows, i), F.get(sorted_windows, j)
            return F.coalesce((a.a == b.a) & (a.b == b.b) & (a.c == b.c), F.lit(False))

        twice = F.filter(F.sequence(F.lit(0), F.size(sorted_windows) - 1), lambda i: same(i, i - 1) | same(i, i + 1))
        return F.size(F.array_distinct(F.flatten(F.transform(
            twice, lambda i: _let(F.get(sorted_windows, i).i, lambda p: F.array(p, p + 1, p + 2))))))

    def window(i):
        return F.struct(F.get(words, i).alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"),
                        i.alias("i"))

    n = F.size(words)
    hashes = F.transform(windows(n), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    # Equal windows have equal hashes, so most texts are settled by the hashes; the rest are compared word by word.
    differ = F.size(F.array_distinct(hashes)) == n - 2
    exact = _let(F.sort_array(F.transform(windows(n), window)), repeated)
    return F.when(n < 4, 0).when(differ, 0).otherwise(exact)


def cleaned(docs):
    """One row per document: doc_id, text (cleaned; null stays null), the base measures, base_failed and kept.

    Null and empty texts have no words and fail the base rules. Repeated rows are judged one by one. Lines end at a line
    feed; lines without words are neither judged nor counted, and stay.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", F.col("text").alias("whole"), _words(text).alias("words"), F.split(text, "\n").alias("lines"))
    has_word = r"[^\x20\x09-\x0D]"
    spoken = F.filter("lines", lambda line: line.rlike(has_word))
    good = F.filter("lines", lambda line: ~(line.rlike(has_word) & line_fails(line)))
    row = split.select(
        "doc_id", "whole", "words", good.alias("good"), F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count("whole", F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("long").alias("n_symbols"),
        _let(spoken, lambda s: F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
        _covered(F.col("words")).cast("long").alias("n_repeat_words"))
    row = row.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    row = row.withColumn("left", F.array_join("good", "\n"))
    left = F.size(_words(F.col("left"))).cast("long")
    return row.select(
        "doc_id", F.when(F.col("whole").isNotNull(), F.col("left")).alias("text"), "n_words", "word_chars", "n_symbols",
        "n_dup_lines", "n_repeat_words", "base_failed", left.alias("words_left"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("words_left") >= (1 - LOST) * F.col("n_words")))
