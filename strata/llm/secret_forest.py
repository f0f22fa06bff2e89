"""Secret findings and a random forest that removes the false ones.

Candidates are all long runs with a digit inside words, without the marks
around them; a run before or after one in the same word is its neighbour, so
compact JSON, CSV and code are read like spaced text.  Each has features of its shape (length, changes between character classes, share
of digits, entropy), of its words (share of its letters inside dictionary
words), of its path and of its neighbours.  The dictionary is the corpus's
own: letter runs outside candidates that a fixed share of the distinct texts
has, so that neither copies of a text nor a secret in many texts make words.
A forest is fitted on labelled findings and scores every candidate.

All of it is DataFrame expressions, joins and Spark's own forest.  The texts
are read three times: for candidates, for their hashes, which tell copies, and
for the dictionary.  Only letter runs that candidates have are kept.

Defined results: null and empty texts have no candidates; a null path has no
path words; a null id is returned as null; repeated rows each have their
candidates; without labels of both kinds every candidate is scored 1 (nothing
is removed that was not learned); an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.divergence import let, words_of
from strata.operators.staging import stage

# Words that announce a secret, and words of paths that hold examples.
SECRET_WORDS = r"(?i)(token|secret|passw|pwd|api.?key|apikey|auth|credential|private|bearer|access.?key)"
EXAMPLE_WORDS = r"(?i)(test|example|sample|mock|fixture|demo|doc)"
RUN = r"A-Za-z0-9+/_=\-"
CANDIDATE = f"[{RUN}]{{12,}}"
PIECES = f"[{RUN}]+|[^{RUN}]+"
OPENING = r"[\"'`(\[{\\]+$"

FEATURES = (
    "length",
    "changes",
    "digit_share",
    "upper_share",
    "is_hex",
    "is_number",
    "entropy",
    "dictionary_share",
    "announced",
    "assigned",
    "quoted",
    "number_beside",
    "example_path",
)


def find_candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, path, place, run, candidate``, two neighbours before and one after, from ``docs(doc_id, text, path)``.

    ``run`` numbers the candidates of a word.  Neighbours are the runs beside
    it in its word, else the words beside that; ``word`` is the candidate with
    the marks around it, never the whole word, which may be a file's length.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def found(words: Column) -> Column:
        long = lambda w: (F.length(w) >= 12) & w.rlike("[0-9]") & w.rlike(CANDIDATE)
        places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: long(words[i]))
        return F.when(F.size(words) > 0, places)

    def beside(words: Column) -> Column:
        near = lambda i: F.coalesce(F.get(words, i), F.lit(""))

        def of_word(i: Column) -> Column:
            def of_pieces(p: Column) -> Column:  # runs and marks by turns
                piece = lambda k: F.coalesce(F.get(p, k), F.lit(""))
                is_one = lambda k: p[k].rlike("[0-9]") & p[k].rlike(f"^{CANDIDATE}")
                return F.transform(
                    F.filter(F.sequence(F.lit(0), F.size(p) - 1), is_one),
                    lambda k, number: F.struct(
                        i.alias("place"),
                        number.alias("run"),
                        p[k].alias("candidate"),
                        F.concat(piece(k - 1), p[k], piece(k + 1)).alias("word"),
                        F.when(k >= 4, piece(k - 4)).when(k >= 2, near(i - 1)).otherwise(near(i - 2)).alias("before2"),
                        F.when(k >= 2, F.concat(piece(k - 2), F.regexp_replace(piece(k - 1), OPENING, "")))
                        .otherwise(near(i - 1))
                        .alias("before1"),
                        F.when(k + 2 < F.size(p), piece(k + 2)).otherwise(near(i + 1)).alias("after1"),
                    ),
                )

            return let(F.regexp_extract_all(words[i], F.lit(PIECES), F.lit(0)), of_pieces)

        return F.flatten(F.transform(found(words), of_word))

    listed = rows.select("doc_id", "path", F.explode(let(words_of(F.col("text")), beside)).alias("found"))
    return listed.select("doc_id", "path", "found.*")


def dictionary_of(docs: DataFrame, runs: DataFrame, min_count: int | None, min_share: float) -> DataFrame:
    """The values of ``runs(run)`` that are words of the documents, candidates left out.

    A word stands in ``min_share`` of the distinct texts, and in two at least;
    where ``min_count`` is given, it occurs so many times instead.
    """
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("text <> ''")
    outside = F.regexp_replace("text", f"(?<![{RUN}])(?=[{RUN}]*?[0-9]){CANDIDATE}", " ")
    cut = F.split(F.lower(outside), r"[^\p{L}]+")
    if min_count is not None:
        words, least = texts.select(F.explode(cut).alias("run"), F.lit(1.0).alias("part")), float(min_count)
    else:
        hashed = texts.withColumn("text_hash", F.xxhash64("text"))
        sizes = stage(hashed.groupBy("text_hash").count(), "text-copies")
        least = max(2.0, min_share * sizes.count())
        # a text's copies share the one time that it counts
        parts = sizes.where("count > 1").select("text_hash", (1 / F.col("count")).alias("part"))
        counted_once = hashed.join(parts, "text_hash", "left").withColumn("part", F.coalesce("part", F.lit(1.0)))
        words = counted_once.select(F.explode(F.array_distinct(cut)).alias("run"), "part")
    counted = words.where("length(run) between 3 and 20").groupBy("run").agg(F.sum("part").alias("n"))
    known = counted.where(F.col("n") >= least - 1e-6)
    return known.join(runs.select("run").distinct(), "run", "left_semi").select("run")


def _entropy(text: Column) -> Column:
    """Bits per character."""

    def bits(letters: Column) -> Column:
        n = F.size(letters)
        share = lambda c: F.size(F.filter(letters, lambda x: x == c)) / n
        return F.aggregate(
            F.transform(F.array_distinct(letters), lambda c: let(share(c), lambda p: -p * F.log2(p))),
            F.lit(0.0),
            lambda a, x: a + x,
        )

    return let(F.split(text, ""), bits)


def describe_candidates(docs: DataFrame, min_count: int | None = None, min_share: float = 0.001) -> DataFrame:
    """All candidates of ``docs(doc_id, text, path)`` with ``FEATURES`` as doubles.

    ``min_share`` and ``min_count`` as in ``dictionary_of``.
    """
    found = stage(find_candidates(docs).withColumn("id", F.monotonically_increasing_id()), "candidates")
    runs = found.select(
        "id", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit(r"(\p{L}{3,20})"))).alias("run")
    )
    known = dictionary_of(docs, runs, min_count, min_share)
    covered = runs.join(known, "run", "left_semi").groupBy("id").agg(F.sum(F.length("run")).alias("covered"))
    length = F.length("candidate")
    count = lambda pattern: length - F.length(F.regexp_replace("candidate", pattern, ""))
    classes = F.regexp_extract_all("candidate", F.lit(r"([a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+)"))
    before = F.concat_ws(" ", "before2", "before1")
    features = {
        "length": length,
        "changes": (F.size(classes) - 1) / length,
        "digit_share": count("[0-9]") / length,
        "upper_share": count("[A-Z]") / length,
        "is_hex": F.col("candidate").rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "is_number": F.col("candidate").rlike("^[0-9]+$"),
        "entropy": _entropy(F.col("candidate")),
        "dictionary_share": F.coalesce("covered", F.lit(0)) / length,
        "announced": before.rlike(SECRET_WORDS) | F.split("candidate", "=")[0].rlike(SECRET_WORDS),
        "assigned": before.rlike(r"[=:]\s*$") | F.col("candidate").rlike("^[A-Za-z_]+="),
        "quoted": F.col("word").rlike(r"[\"'`]"),
        "number_beside": F.col("before1").rlike("[0-9]") | F.col("after1").rlike("[0-9]"),
        "example_path": F.col("path").rlike(EXAMPLE_WORDS),
    }
    described = found.join(covered, "id", "left")
    return described.select(
        "doc_id", "path", "place", "run", "candidate", "word", "before2", "before1", "after1",
        *[F.col(c) if isinstance(c, str) else c.cast("double").alias(name) for name, c in features.items()],
    )


def remove_false_findings(
    candidates: DataFrame, findings: DataFrame, threshold: float = 0.5, max_findings: int = 20_000, trees: int = 20, seed: int = 7
) -> DataFrame:
    """``candidates`` with ``score`` and ``is_secret`` by a forest fitted on ``findings``.

    ``findings`` are candidates with ``label`` (1 a secret, 0 a false one); of
    more than ``max_findings`` of a label, those with the smallest hashes are
    used, so that the fit is bounded.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    order = [F.xxhash64(F.lit(seed), F.col("candidate"), F.col("doc_id"), F.col("place"), F.col("run")).asc()]
    kinds = [findings.where(F.col("label") == label).orderBy(*order).limit(max_findings) for label in (0, 1)]
    train = stage(kinds[0].unionByName(kinds[1]).select(*FEATURES, F.col("label").cast("double").alias("label")), "findings")
    counts = {row["label"]: row["count"] for row in train.groupBy("label").count().collect()}
    if len(counts) < 2:
        return candidates.withColumn("score", F.lit(1.0)).withColumn("is_secret", F.lit(True))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="forest_features", handleInvalid="keep")
    forest = RandomForestClassifier(
        featuresCol="forest_features", labelCol="label", predictionCol="forest_prediction",
        probabilityCol="forest_probability", rawPredictionCol="forest_votes", numTrees=trees, maxDepth=6, seed=seed,
    )
    model = forest.fit(assembler.transform(train))
    scored = model.transform(assembler.transform(candidates.drop("score", "is_secret")))
    return (
        scored.withColumn("score", vector_to_array("forest_probability")[1])
        .withColumn("is_secret", F.col("score") >= threshold)
        .drop("forest_features", "forest_votes", "forest_probability", "forest_prediction")
    )


def review_by_rule(candidates: DataFrame) -> DataFrame:
    """Labels that a reviewer's first rules would give, null where they don't decide.

    A random-looking value that is assigned to an announced name is a secret;
    a plain number that nothing announces, or a value made of dictionary
    words, is not.
    """
    secret = (F.col("announced") == 1) & (F.col("assigned") == 1) & (F.col("entropy") >= 3) & (F.col("length") >= 20)
    false = ((F.col("is_number") == 1) & (F.col("announced") == 0)) | (F.col("dictionary_share") >= 0.6)
    return candidates.withColumn("label", F.when(secret, 1).when(false, 0))
