"""Quality rules: Jensen-Shannon distance of a document to language references.

Everything here is DataFrame expressions. One pass over the texts gives a small row
of counts per document (`measures`); the references are medians of those rows over
all documents of a language, and the verdict compares each row with the references.

Base rules: fewer than `min_words` words, or more than half of the words inside
3-word windows found twice, reject a document. The method's rules, each behind a
minimum length below which the histogram is too noisy to judge:

* character classes (lower, upper, other letters, digits, symbols, other marks,
  spaces): distance to the nearest reference above `max_class_distance`, widened for
  the sampling noise of short texts, rejects;
* common words: distance of the histogram of a language's function words (and "any
  other word") to the nearest reference above `max_word_distance` rejects.

Defined results: a NULL text has no words and fails the base rules; a NULL or
unlisted language is judged by the character classes alone unless no reference
exists, when only the base rules hold; repeated rows give repeated results; an empty
table gives an empty table. Columns of the input other than `id_col`, `text_col` and
`lang_col` are not touched, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawgrain.session import staged

SEPARATORS = "[\\x20\\x09-\\x0D]+"
CLASSES = ("lower", "upper", "letter", "digit", "symbol", "mark", "space")

# Frequent function words of the languages with a reference.
COMMON_WORDS = {
    "en": "the of and to in a is that it was for on with as be at by this from or".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
}


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 50
    max_repeat_percent: int = 50
    min_class_chars: int = 100
    min_common_words: int = 150
    max_class_distance: float = 0.185
    class_noise: float = 1.2  # added to the limit, over the root of the code points
    max_word_distance: float = 0.28
    common_words: dict[str, list[str]] = field(default_factory=lambda: COMMON_WORDS)


def _bound(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often `body` names it."""
    return F.transform(F.array(value), body)[0]


def _repeats_exact(words: Column, windows: Column) -> Column:
    """Start positions of repeated windows, by sorting the windows as text."""
    entries = F.sort_array(
        F.transform(windows, lambda i: F.struct(F.array(words[i], words[i + 1], words[i + 2]).alias("k"), i.alias("p")))
    )
    return _bound(
        entries,
        lambda s: F.flatten(
            F.transform(
                F.filter(F.sequence(F.lit(1), F.size(s) - 1), lambda i: s[i]["k"] == s[i - 1]["k"]),
                lambda i: F.array(s[i - 1]["p"], s[i]["p"]),
            )
        ),
    )


_POSITION = 20  # bits for a window's position; longer texts take the exact path


def _repeated_positions(words: Column) -> Column:
    """Start positions (some twice) of 3-word windows found more than once.

    Sorts hashes with the position in their low bits, then compares the words of
    neighbours. A text in which different windows share a hash is sorted as text.
    """
    low = (1 << _POSITION) - 1
    windows = F.sequence(F.lit(0), F.size(words) - 3)

    def place(key: Column) -> Column:
        return key.bitwiseAND(F.lit(low)).cast("int")

    def same(s: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(1), F.size(s) - 1),
            lambda i: F.shiftright(s[i], _POSITION) == F.shiftright(s[i - 1], _POSITION),
        )

    def differ(p: Column, q: Column) -> Column:
        return (words[p] != words[q]) | (words[p + 1] != words[q + 1]) | (words[p + 2] != words[q + 2])

    def found(s: Column) -> Column:
        return _bound(
            same(s),
            lambda at: F.when(
                F.exists(at, lambda i: differ(place(s[i - 1]), place(s[i]))), _repeats_exact(words, windows)
            ).otherwise(F.flatten(F.transform(at, lambda i: F.array(place(s[i - 1]), place(s[i]))))),
        )

    keys = F.transform(
        windows,
        lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")),
    )
    return (
        F.when(F.size(words) < 4, F.array().cast("array<int>"))
        .when(F.size(words) > low, _repeats_exact(words, windows))
        .otherwise(_bound(F.sort_array(keys), found))
    )


def _repeat_words(words: Column) -> Column:
    """Words inside a 3-word window that is found twice or more in the text."""

    def covered(at: Column) -> Column:
        gaps = F.transform(
            F.sequence(F.lit(1), F.size(at) - 1), lambda i: F.least(F.lit(3), at[i] - at[i - 1]).cast("long")
        )
        return F.when(F.size(at) < 2, F.lit(0).cast("long")).otherwise(
            F.aggregate(gaps, F.lit(3).cast("long"), lambda a, x: a + x)
        )

    return _bound(F.sort_array(F.array_distinct(_repeated_positions(words))), covered)


def _per_word_list(words: Column, lists: dict[str, list[str]]) -> Column:
    """Per language, how often each of its common words occurs (case ignored)."""
    every = sorted({word for listed in lists.values() for word in listed})
    longest = max(map(len, every), default=0)
    lowered = F.transform(
        F.filter(words, lambda w: F.length(w) <= longest + 1), lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?"))
    )
    hits = F.filter(lowered, lambda w: w.isin(every)) if every else F.array().cast("array<string>")

    def count(h: Column, word: str) -> Column:
        return F.size(F.filter(h, lambda x: x == F.lit(word))).cast("long")

    def counts(h: Column) -> Column:
        return F.struct(
            *[F.array(*[count(h, w) for w in listed]).alias(lang) for lang, listed in lists.items()]
        )

    return _bound(hits, counts)


def _left(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def measure(text: Column, params: QualityParams) -> Column:
    """Struct of the base counts, `classes` and `common` of a text."""

    def of_text(t: Column) -> Column:
        solid = _left(t, SEPARATORS)
        words = F.filter(F.split(t, SEPARATORS), lambda w: w != "")
        lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\f\r"))) > 0)
        return _bound(
            F.struct(solid.alias("solid"), words.alias("words"), lines.alias("lines")),
            lambda x: F.struct(
                F.size(x["words"]).cast("long").alias("n_words"),
                F.length(x["solid"]).cast("long").alias("word_chars"),
                (F.length(x["solid"]) - F.length(_left(x["solid"], "[#*$%&|<>]+"))).cast("long").alias("n_symbols"),
                (F.size(x["lines"]) - F.size(F.array_distinct(x["lines"]))).cast("long").alias("n_dup_lines"),
                _bound(x["words"], _repeat_words).alias("n_repeat_words"),
                _classes(t, x["solid"]).alias("classes"),
                _per_word_list(x["words"], params.common_words).alias("common"),
            ),
        )

    return _bound(F.coalesce(text, F.lit("")), of_text)


def measures(docs: DataFrame, params: QualityParams, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """One row of counts per document."""
    return docs.select(
        docs[id_col].alias("doc_id"), docs[lang_col].alias("lang"), measure(docs[text_col], params).alias("m")
    ).select("doc_id", "lang", "m.*")


def _classes(text: Column, solid: Column) -> Column:
    """Code points per character class, in the order of CLASSES."""

    def rest(r: Column) -> Column:
        return _bound(
            F.struct(_left(r, "[\\p{L}\\p{M}]+").alias("a"), _left(r, "\\p{Lu}+").alias("u")),
            lambda x: _bound(
                F.struct(_left(x["a"], "\\p{Nd}+").alias("n"), _left(x["a"], "[#*$%&|<>]+").alias("s")),
                lambda y: F.array(
                    F.length(solid) - F.length(r),
                    F.length(r) - F.length(x["u"]),
                    F.length(x["u"]) - F.length(x["a"]),
                    F.length(x["a"]) - F.length(y["n"]),
                    F.length(x["a"]) - F.length(y["s"]),
                    F.length(x["a"]) - (F.length(x["a"]) - F.length(y["n"])) - (F.length(x["a"]) - F.length(y["s"])),
                    F.length(text) - F.length(solid),
                ).cast("array<long>"),
            ),
        )

    return _bound(_left(solid, "\\p{Ll}+"), rest)


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)


def _shares(counts: Column) -> Column:
    return _bound(_total(counts), lambda n: F.transform(counts, lambda x: x / F.greatest(n, F.lit(1))))


def _word_counts(lang: str) -> Column:
    """Counts of a language's common words with, last, all other words."""
    listed = F.col(f"common.{lang}")
    return F.concat(listed, F.array(F.col("n_words") - _total(listed)))


def base_failed(params: QualityParams) -> Column:
    return (F.col("n_words") < params.min_words) | (
        100 * F.col("n_repeat_words") > params.max_repeat_percent * F.col("n_words")
    )


def references(measured: DataFrame, params: QualityParams) -> dict[str, tuple[list[float], list[float]]]:
    """Median histograms per listed language, over all its long enough documents.

    Medians, so that junk does not move them. The answer has one row for each
    language of `params.common_words` at most, which bounds what the driver reads.
    """
    found = {}
    usable = measured.where(~base_failed(params) & (F.col("n_words") >= params.min_common_words))
    widths = {lang: len(listed) + 1 for lang, listed in params.common_words.items()}
    for_word = F.lit(None).cast("array<double>")
    for lang in widths:
        for_word = F.when(F.col("lang") == lang, _shares(_word_counts(lang))).otherwise(for_word)
    longest = max(widths.values(), default=0)
    rows = (
        usable.where(F.col("lang").isin(*widths))
        .select("lang", _shares(F.col("classes")).alias("c"), for_word.alias("w"))
        .groupBy("lang")
        .agg(
            *[F.percentile_approx(F.col("c")[i], 0.5, 1000).alias(f"c{i}") for i in range(len(CLASSES))],
            *[F.percentile_approx(F.get("w", F.lit(i)), 0.5, 1000).alias(f"w{i}") for i in range(longest)],
        )
        .collect()
    )
    for row in rows:
        classes = [row[f"c{i}"] for i in range(len(CLASSES))]
        common = [row[f"w{i}"] for i in range(widths[row["lang"]])]
        found[row["lang"]] = tuple([x / (sum(v) or 1.0) for x in v] for v in (classes, common))
    return found


def js_distance(shares: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of a histogram to a reference."""
    pairs = F.arrays_zip(shares.alias("p"), F.array(*[F.lit(float(x)) for x in reference]).alias("q"))

    def part(x: Column, mean: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / mean)).otherwise(F.lit(0.0))

    def term(z: Column) -> Column:
        mean = (z["p"] + z["q"]) / 2
        return (part(z["p"], mean) + part(z["q"], mean)) / 2

    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(pairs, F.lit(0.0), lambda a, z: a + term(z))))


def judge(measured: DataFrame, refs: dict[str, tuple[list[float], list[float]]], params: QualityParams) -> DataFrame:
    """`measured` with base_failed, class_distance, word_distance and kept."""
    failed = base_failed(params)
    if refs:
        by_class = F.array_min(
            _bound(_shares(F.col("classes")), lambda s: F.array(*[js_distance(s, c) for c, _ in refs.values()]))
        )
        by_word = F.array_min(F.array(*[js_distance(_shares(_word_counts(k)), w) for k, (_, w) in refs.items()]))
    else:
        by_class = by_word = F.lit(None).cast("double")
    chars = _total(F.col("classes"))
    class_judged = chars >= params.min_class_chars
    class_limit = params.max_class_distance + params.class_noise / F.sqrt(chars)
    word_judged = (F.col("n_words") >= params.min_common_words) & F.col("lang").isin(*params.common_words)
    verdict = ~failed & ~(
        F.coalesce(F.when(class_judged, F.col("class_distance") > class_limit), F.lit(False))
        | F.coalesce(F.when(word_judged, F.col("word_distance") > params.max_word_distance), F.lit(False))
    )
    return (
        measured.withColumn("base_failed", failed)
        .withColumn("class_distance", by_class)
        .withColumn("word_distance", by_word)
        .withColumn("kept", verdict)
    )


def quality_rules(
    docs: DataFrame,
    params: QualityParams | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Base counts, distances and verdict of every document.

    The counts are stored in the shared folder between the two passes, so the texts
    are read once.
    """
    params = params or QualityParams()
    measured = staged(measures(docs, params, id_col, text_col, lang_col), "quality")
    return judge(measured, references(measured, params), params)


def keep_good(
    docs: DataFrame, params: QualityParams | None = None, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The rows of `docs` that the rules keep, columns unchanged.

    Documents are stored once with their counts, so that nothing has to be joined.
    """
    params = params or QualityParams()
    names = docs.columns
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs[lang_col].alias("lang"), measure(docs[text_col], params).alias("m"))
    rows = staged(rows, "quality")
    refs = references(rows.select("lang", "m.*"), params)
    judged = judge(rows.select("row", "lang", "m.*"), refs, params)
    return judged.where("kept").select("row.*")
