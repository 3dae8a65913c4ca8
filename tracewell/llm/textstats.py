"""Statistics of whole texts as built-in column functions, for the operators that judge quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What parts words, and what counts as a symbol.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]+"


def without(pattern: str) -> str:
    return f"length(text) - length(regexp_replace(text, r'{pattern}', ''))"


def basic_stats(texts: DataFrame) -> DataFrame:
    """texts with columns text (not null) and others; adds words and lines and what is counted from them, as longs."""
    split = texts.withColumns({
        "words": F.expr(f"filter(split(text, r'{SPACE}'), w -> w <> '')"),
        "lines": F.expr(r"filter(split(text, '\n'), l -> btrim(l, ' \t\n\u000b\u000c\r') <> '')"),
    })
    counted = {
        "n_words": "size(words)",
        "word_chars": "length(array_join(words, ''))",
        "n_distinct_words": "size(array_distinct(words))",
        "n_lines": "size(lines)",
        "n_dup_lines": "size(lines) - size(array_distinct(lines))",
        "n_symbols": without(SYMBOLS),
        "n_upper": without("[A-Z]+"),
        "n_marks": without("[!?]+"),
        "n_digits": without("[0-9]+"),
        "text_chars": "length(text)",
    }
    return split.withColumns({k: F.expr(v).cast("long") for k, v in counted.items()})


def repeated_words(texts: DataFrame, width: int = 8) -> DataFrame:
    """Adds n_repeat_words: words that lie in a window of `width` words found twice or more in the text.

    texts has a column words. Windows are told apart by a 64-bit hash, which two different windows of one
    text share with a chance of 2^-64. Sorting finds the repeated ones, so a text costs n log n at most.
    """
    hashes = f"if(size(words) < {width}, array(), transform(sequence(1, size(words) - {width - 1}), i -> xxhash64(slice(words, i, {width}))))"
    twice = "if(size(array_distinct(_hashes)) = size(_hashes), array(), array_sort(transform(_hashes, (h, i) -> struct(h, i))))"
    places = (
        "transform(filter(sequence(0, size(_sorted) - 1), j -> (j > 0 and _sorted[j].h = _sorted[greatest(j - 1, 0)].h)"
        " or (j + 1 < size(_sorted) and _sorted[j].h = _sorted[least(j + 1, size(_sorted) - 1)].h)), j -> _sorted[j].i)"
    )
    covered = f"size(array_distinct(flatten(transform(_places, i -> sequence(i, i + {width - 1})))))"
    return (
        texts.withColumn("_hashes", F.expr(hashes))
        .withColumn("_sorted", F.expr(twice))
        .withColumn("_places", F.expr(f"if(size(_sorted) = 0, cast(array() as array<int>), {places})"))
        .withColumn("n_repeat_words", F.expr(covered).cast("long"))
        .drop("_hashes", "_sorted", "_places")
    )


#: Ratios that judge a text whatever its length.
RATES = {
    "mean_word": "word_chars / greatest(n_words, 1)",
    "distinct_rate": "n_distinct_words / greatest(n_words, 1)",
    "symbol_rate": "n_symbols / greatest(word_chars, 1)",
    "upper_rate": "n_upper / greatest(word_chars, 1)",
    "mark_rate": "n_marks / greatest(word_chars, 1)",
    "digit_rate": "n_digits / greatest(word_chars, 1)",
    "dup_line_rate": "n_dup_lines / greatest(n_lines, 1)",
}


def with_rates(stats: DataFrame, rates: dict[str, str] = RATES) -> DataFrame:
    return stats.withColumns({k: F.expr(f"cast({v} as double)") for k, v in rates.items()})


def sample_of_labels(labels: DataFrame, rows: int, label: str = "quality") -> DataFrame:
    """At most `rows` labelled doc_ids, those with the smallest hashes: doc_id and y. Contradicting labels of one id count as their smallest."""
    known = labels.filter(f"doc_id is not null and {label} is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label).cast("int").alias("y"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def one_row_each(docs: DataFrame) -> DataFrame:
    """Of the rows that repeat a doc_id only the one with the smallest hash, so that no id takes the place of others in a sample.

    Told apart before the shuffle, so an id on very many rows is one row of each task.
    """
    row = F.struct(*docs.columns)
    return docs.groupBy("doc_id").agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("_row")).select("_row.*")
