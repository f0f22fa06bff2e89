"""Quality rules by distribution divergence from language references.

A document's histograms of character classes and of common words are compared
with those of its language by the Jensen-Shannon distance (the root of the
divergence in bits, 0 to 1).  The references are the summed histograms of all
documents of the language.  Documents too short to have a stable histogram are
not judged by it, only by the base rules.

Everything is DataFrame expressions.  One pass over the texts makes the counts
and histograms, which are staged; the references are their sums by language,
and the distances need the staged histograms only.  No text is shuffled.

Defined results: a null or empty text has no words, fails the base rules and
is not kept; a null language is a language of its own; repeated rows each get
their row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from strata.operators.staging import stage

# White space and symbols of the base rules.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Common words of English, German, French and Spanish.
COMMON_WORDS = (
    "the of and to in a is that it for as with on be are at this by or was from an have not you "
    "der die das und ist den von zu mit sich des auf für im dem nicht ein eine als auch es "
    "le la les de des du un une et en que qui dans pour par sur avec est au pas plus ce il "
    "el los las y del se por con no su una para es al lo como más pero sus"
).split()

# Character classes as Java and RE2 write them; the rest is the last class.
CLASSES = (r"\p{Ll}", r"\p{Lu}", r"\p{N}", r".,;:!?'\"()-")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[ \x09-\x0D]+"), lambda w: w != "")


def repeated_line_count(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \x09-\x0D]"))
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long")


def repeated_word_count(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Windows are hashed to 64 bits and sorted with their places, so the work
    grows as n log n with the length of the text.
    """

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda at, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), at - starts[k - 1])))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def repeats(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            twin = lambda p, k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == p["h"])) | (
                (k < F.size(s) - 1) & (s[F.least(k + 1, F.size(s) - 1)]["h"] == p["h"])
            )
            return F.sort_array(F.transform(F.filter(s, twin), lambda p: p["i"]))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            let(let(placed, starts), covered)
        )

    def of(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
        return F.when(F.size(w) < 3, 0).otherwise(let(windows, repeats))

    return let(words, of).cast("long")


def class_counts(text: Column) -> Column:
    """Characters of each class and of none, blanks left out.

    Each class is cut out of what the ones before it left, so that all but
    the first look at short rests only.
    """

    def counted(rest: Column, classes: tuple[str, ...], found: list[Column]) -> Column:
        if not classes:
            return F.array(*found, F.length(rest)).cast("array<long>")
        less = F.regexp_replace(rest, f"[{classes[0]}]+", "")
        return let(less, lambda r: counted(r, classes[1:], [*found, F.length(rest) - F.length(r)]))

    return let(F.translate(text, BLANKS, ""), lambda t: counted(t, CLASSES, []))


def word_counts(text: Column) -> Column:
    """``code, n`` per common word of the text, by place in the list; all other runs of letters share the last code."""
    table = F.array(*map(F.lit, COMMON_WORDS))
    code = lambda w: F.when(w.isin(COMMON_WORDS), F.array_position(table, w).cast("int") - 1)

    def counted(s: Column) -> Column:
        """Runs of equal sorted codes."""
        last = F.size(s) - 1
        places = F.filter(F.sequence(F.lit(0), last), lambda k: (k == 0) | (s[k] != s[F.greatest(k - 1, F.lit(0))]))

        def run(starts: Column) -> Column:
            stop = lambda j: F.when(j == F.size(starts) - 1, last + 1).otherwise(
                starts[F.least(j + 1, F.size(starts) - 1)]
            )
            return F.transform(starts, lambda at, j: F.struct(s[at].alias("code"), (stop(j) - at).alias("n")))

        return F.when(F.size(s) > 0, let(places, run)).otherwise(F.array().cast("array<struct<code:int,n:int>>"))

    runs = F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")
    codes = F.transform(runs, lambda w: F.coalesce(code(w), F.lit(len(COMMON_WORDS))))
    return let(F.sort_array(codes), counted)


def _half(p: Column, q: Column) -> Column:
    """``p log2(p / m)`` with ``m`` the mean of both, 0 where ``p`` is."""
    return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)


def class_distance(counts: Column, reference: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)

    def distance(n: Column) -> Column:
        terms = F.zip_with(counts, reference, lambda c, q: (_half(c / n, q) + _half(q, c / n)) / 2)
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)))

    return let(total, lambda n: F.when(n > 0, distance(n)))


def word_distance(counts: Column, reference: Column) -> Column:
    """Common words that the text lacks add half of their share each."""
    total = F.aggregate(counts, F.lit(0), lambda a, x: a + x["n"])

    def distance(n: Column) -> Column:
        def term(x: Column) -> Column:
            return let(
                F.struct((x["n"] / n).alias("p"), reference[x["code"]].alias("q")),
                lambda y: (_half(y["p"], y["q"]) + _half(y["q"], y["p"]) - y["q"]) / 2,
            )

        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(F.transform(counts, term), F.lit(0.5), lambda a, x: a + x)))

    return let(total, lambda n: F.when(n > 0, distance(n)))


def measure_documents(docs: DataFrame) -> DataFrame:
    """Per document of ``docs(doc_id, text, lang)`` the base counts and both histograms."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    text = F.col("text")
    counted = let(
        words_of(text),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_word_count(w).alias("n_repeat_words")),
    )
    return rows.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        "lang",
        counted.alias("counted"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        repeated_line_count(text).alias("n_dup_lines"),
        class_counts(text).alias("classes"),
        word_counts(text).alias("words"),
    ).select("doc_id", "text_hash", "lang", "counted.*", "word_chars", "n_symbols", "n_dup_lines", "classes", "words")


def language_references(measured: DataFrame) -> DataFrame:
    """``lang, class_shares, word_shares``: the histograms of all measured documents, summed."""
    n = len(CLASSES) + 1
    classes = measured.groupBy("lang").agg(F.array(*[F.sum(F.col("classes")[i]) for i in range(n)]).alias("classes"))
    words = (
        measured.select("lang", F.explode("words").alias("word"))
        .groupBy("lang", "word.code")
        .agg(F.sum("word.n").alias("n"))
        .groupBy("lang")
        .agg(F.map_from_entries(F.collect_list(F.struct("code", "n"))).alias("found"))
    )
    summed = lambda array: F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x)
    share = lambda x, total: F.when(total > 0, x / total).otherwise(0.0)
    return (
        classes.alias("c")
        .join(words.alias("w"), F.col("c.lang").eqNullSafe(F.col("w.lang")), "left")
        .select(
            "c.lang",
            let(summed(F.col("classes")), lambda t: F.transform("classes", lambda x: share(x, t))).alias("class_shares"),
            let(
                summed(F.map_values("found")),
                lambda t: F.transform(
                    F.sequence(F.lit(0), F.lit(len(COMMON_WORDS))),
                    lambda i: F.coalesce(share(F.element_at("found", i), t), F.lit(0.0)),
                ),
            ).alias("word_shares"),
        )
    )


def judge_documents(
    docs: DataFrame,
    references: DataFrame | None = None,
    max_class_distance: float = 0.28,
    max_word_distance: float = 0.30,
    min_chars: int = 200,
    min_words: int = 150,
) -> DataFrame:
    """Per document the base counts, both distances and ``kept``; ``text_hash`` tells rows of one id apart.

    A distance is judged only from ``min_chars`` characters or ``min_words``
    letter runs on; ``references`` replaces those of ``docs`` itself.  The
    measures are staged once, so texts are read once.
    """
    measured = stage(measure_documents(docs), "measures")
    # a row per language, written so that its size is known: small ones are broadcast, others joined by a shuffle
    shares = stage(language_references(measured) if references is None else references, "references")
    judged = measured.alias("d").join(shares.alias("r"), F.col("d.lang").eqNullSafe(F.col("r.lang")), "left").select(
        "d.*",
        class_distance(F.col("d.classes"), F.col("r.class_shares")).alias("class_distance"),
        word_distance(F.col("d.words"), F.col("r.word_shares")).alias("word_distance"),
        F.aggregate("d.words", F.lit(0), lambda a, x: a + x["n"]).alias("n_runs"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    strange = ((F.col("word_chars") >= min_chars) & (F.col("class_distance") > max_class_distance)) | (
        (F.col("n_runs") >= min_words) & (F.col("word_distance") > max_word_distance)
    )
    return judged.select(
        "doc_id",
        "text_hash",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        "class_distance",
        "word_distance",
        (~failed & ~F.coalesce(strange, F.lit(False))).alias("kept"),
    )
