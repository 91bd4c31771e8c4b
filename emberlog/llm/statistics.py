"""Statistics of whole texts as built-in column expressions.

Higher-order functions evaluate what they are given once per element, so shared parts
are bound with `let`: a one-element array handed to `transform`.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words are runs of anything but these; symbols are counted one by one.
SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES, -1), "")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + x)


def repeat_words(words: Column) -> Column:
    """How many words lie in a three-word window that the text holds at least twice.

    Windows are compared by 64-bit hash; a text without repeated hashes is done at once,
    else (hash, place) pairs are sorted and neighbours compared.
    """
    places = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(places, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def marked(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, repeated_places)

    def repeated_places(pairs: Column) -> Column:
        def place(pair: Column, k: Column) -> Column:
            before, after = F.get(pairs, k - 1)["h"], F.get(pairs, k + 1)["h"]
            same = F.coalesce(pair["h"] == before, F.lit(False)) | F.coalesce(pair["h"] == after, F.lit(False))
            return F.when(same, pair["i"]).otherwise(-1)

        found = F.sort_array(F.filter(F.transform(pairs, place), lambda i: i >= 0))
        return let(found, lambda at: _total(F.transform(at, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - i, F.lit(3))))))

    def counted(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), marked(hashes)).otherwise(F.lit(0).cast("long"))

    return F.when(F.size(words) >= 3, let(hashes, counted)).otherwise(F.lit(0).cast("long"))


def shape(text: Column, repeats: bool) -> Column:
    """A struct of counts of a text; null counts as empty. `repeats` adds n_repeat_words."""
    text = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        def of_lines(lines: Column) -> Column:
            fields = [
                F.size(words).cast("long").alias("n_words"),
                F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
                F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                F.size(lines).cast("long").alias("n_lines"),
                F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
                F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
            ]
            if repeats:
                fields.append(repeat_words(words).alias("n_repeat_words"))
            return F.struct(*fields)

        return let(lines_with_words(text), of_lines)

    return let(words_of(text), of_words)
