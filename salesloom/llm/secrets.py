"""Secret findings judged by a random forest, in DataFrame functions."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.shared import stash, table

LEAST_LENGTH = 8
LONG = 16
MIN_DOCUMENTS = 5
#: At most so many distinct labelled findings train the forest, half of them of each label as far as there are, those with the smallest hash.
TRAINING_ROWS = 20_000
TREES, DEPTH, SEED = 24, 6, 17

CREDENTIAL = r"(?i)(token|secret|passw|pwd|api[_-]?key|apikey|access[_-]?key|auth|credential|private[_-]?key|bearer)|//[^\s/:@]*:[^\s:@]+@$"
FINGERPRINT = r"(?i)(sha|md5|commit|checksum|digest|revision|uuid|etag|hash|version|build)"
PREFIX = r"^(AKIA|ASIA|gh[pousr]_|glpat-|xox[abprs]-|sk_live_|sk-|AIza|eyJ)"
#: A word is runs of key characters, with the padding of base64, and what stands between them.
RUNS = r"[A-Za-z0-9_+/.-]+(?:={1,2}(?![A-Za-z0-9_+/.=-]))?|[^A-Za-z0-9_+/.-]+"
ASSIGNS = r"[=:][\\\"'`(\[{]*$"
FEATURES = ["length", "transitions", "digits", "uppers", "lowers", "hex", "variety", "coverage", "slashes", "dots", "extension", "credential", "fingerprint", "assigned", "quoted", "prefixed", "after_plain"]


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, word_no, value, before2, before, word, after): runs that may hold a secret, with their neighbours.

    Every run of key characters from LEAST_LENGTH on is looked at, wherever it stands in a word, which is a run without white
    space. It counts when it is assigned a name, or mixes letters and digits over LONG characters, or starts like a provider's
    key. Its word is the run with the name and separator that assign it and a closing quote or @; before2 and before are the words
    before, empty from a word's third run on; after is the next run of the word or the next word.
    """
    words = F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"\s+"), lambda w: w != "")
    none = F.lit("")

    def of(w: Column) -> Column:
        def near(i: Column, by: int) -> Column:
            return F.coalesce(F.get(w, i + by), none)

        def inside(x: Column, i: Column) -> Column:
            def place(p: Column, value: Column, j: Column) -> Column:
                between = F.coalesce(F.get(p, j - 1), none)
                assigned = between.rlike(ASSIGNS) & ~value.startswith("//")
                word = F.concat(F.when(assigned, F.coalesce(F.get(p, j - 2), none)).otherwise(none), F.when(assigned, between).otherwise(F.regexp_extract(between, "[\"'`]$", 0)), value, F.regexp_extract(F.coalesce(F.get(p, j + 1), none), "^[\"'`@]", 0))
                named = assigned | ((j <= 1) & near(i, -1).rlike("[=:][\"']?$")) | value.rlike(PREFIX)
                mixed = (F.length(value) >= LONG) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
                first = lambda by: F.when(j <= 3, near(i, by)).otherwise(none)
                parts = F.struct(i.cast("long").alias("word_no"), value.alias("value"), first(-2).alias("before2"), first(-1).alias("before"), word.alias("word"), F.coalesce(F.get(p, j + 2), near(i, 1)).alias("after"))
                return F.when((F.length(value) >= LEAST_LENGTH) & value.rlike("^[A-Za-z0-9_+/.-]") & (named | mixed), parts)

            runs = F.array(F.regexp_extract_all(x, F.lit(RUNS), F.lit(0)))  # bound as a lambda variable: made once a word
            found = F.get(F.transform(runs, lambda p: F.filter(F.transform(p, lambda v, j: place(p, v, j)), lambda c: c.isNotNull())), F.lit(0))
            worth = (F.length(x) >= LEAST_LENGTH) & (x.rlike("[0-9=:]") | near(i, -1).rlike("[=:][\"']?$") | x.rlike(PREFIX[1:]))
            return F.when(worth, found)

        return F.flatten(F.filter(F.transform(w, inside), lambda c: c.isNotNull()))

    found = F.get(F.transform(F.array(words), of), F.lit(0))  # the words are bound as a lambda variable: made once a row
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(found).alias("c")).select("doc_id", "c.*")


def dictionary(docs: DataFrame) -> DataFrame:
    """(piece, documents): lower-cased runs of at least three letters that MIN_DOCUMENTS documents use."""
    pieces = F.array_distinct(F.filter(F.split(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), r"[^\p{L}]+"), lambda w: F.length(w) >= 3))
    return docs.select(F.explode(pieces).alias("piece")).groupBy("piece").agg(F.count("*").alias("documents")).where(F.col("documents") >= MIN_DOCUMENTS)


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.greatest(F.length("value"), F.lit(1))


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds FEATURES as doubles. coverage is the share of a value's characters within dictionary words."""
    pieces = found.select("value").distinct().select("value", F.explode(F.split(F.lower(F.regexp_replace("value", "([a-z])([A-Z])", "$1 $2")), r"[^\p{L}]+")).alias("piece")).where(F.length("piece") >= 3)
    covered = pieces.join(words, "piece").groupBy("value").agg(F.sum(F.length("piece")).alias("letters"))
    kind = F.translate("value", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "U" * 26 + "L" * 26 + "D" * 10)
    near = F.concat_ws(" ", "before2", "before", "word")
    columns = {
        "length": F.length("value"),
        "transitions": F.regexp_count(F.col("kind"), F.lit("U(?=[^U])|L(?=[^L])|D(?=[^D])|[^ULD](?=[ULD])")) / F.greatest(F.length("value"), F.lit(1)),
        "digits": _share("[0-9]"),
        "uppers": _share("[A-Z]"),
        "lowers": _share("[a-z]"),
        "hex": _share("[0-9a-f]"),
        "variety": F.size(F.array_distinct(F.split("value", ""))),
        "coverage": F.coalesce(F.col("letters"), F.lit(0)) / F.greatest(F.length("value"), F.lit(1)),
        "slashes": F.regexp_count("word", F.lit(r"[/\\]")),
        "dots": F.regexp_count("value", F.lit(r"\.")),
        "extension": F.col("word").rlike(r"\.[A-Za-z]{2,4}\W*$"),
        "credential": near.rlike(CREDENTIAL),
        "fingerprint": near.rlike(FINGERPRINT),
        "assigned": F.concat_ws(" ", "before", "word").rlike("[=:]"),
        "quoted": F.col("word").rlike("[\"'`]"),
        "prefixed": F.col("value").rlike(PREFIX),
        "after_plain": F.col("after").rlike(r"^\p{L}+[.,;]?$"),
    }
    out = found.join(covered, "value", "left").withColumn("kind", kind)
    return out.select("*", *[c.cast("double").alias(f"f_{name}") for name, c in columns.items()]).drop("kind", "letters")


def labelled_findings(found: DataFrame) -> DataFrame:
    """Findings with a label where no reviewed ones are given, made from the documents' own.

    1: a value in a credential's assignment that mixes letters and digits, or one with a provider's prefix.
    0: the same value named a checksum or commit; a plain neighbouring word put into the credential's assignment
    (a placeholder); every finding outside such an assignment.
    """
    near = F.concat_ws(" ", "before2", "before", "word")
    sure = near.rlike(CREDENTIAL) & F.concat_ws(" ", "before", "word").rlike("[=:]") & F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]") | F.col("value").rlike(PREFIX)
    base = found.withColumn("label", F.when(sure, 1.0).when(~near.rlike(CREDENTIAL), 0.0)).where("label is not null")
    positive = base.where("label = 1")
    swapped = positive.withColumns({"before2": F.lit("sha256"), "before": F.lit("="), "word": F.concat(F.lit('"'), "value", F.lit('"')), "label": F.lit(0.0)}).where(~F.col("value").rlike(PREFIX))
    plain = F.regexp_extract("after", r"(\p{L}+)", 1)
    placeholder = positive.withColumns({"value": plain, "word": F.concat(F.lit('"'), plain, F.lit('"')), "label": F.lit(0.0)}).where("value <> ''")
    return base.unionByName(swapped).unionByName(placeholder)


def drawn(known: DataFrame) -> DataFrame:
    """At most TRAINING_ROWS distinct labelled findings: half of each label, and of one what the other leaves free."""
    fields = ["value", "before2", "before", "word", "after", "label"]
    once = stash(known.where("label is not null").select(fields).dropDuplicates().withColumn("order", F.xxhash64(*fields)), "known")
    count = {r["label"]: r["count"] for r in once.groupBy((F.col("label") > 0).alias("label")).count().collect()}
    half = TRAINING_ROWS // 2
    room = {x: max(half, TRAINING_ROWS - count.get(not x, 0)) for x in (True, False)}
    parts = [once.where((F.col("label") > 0) == F.lit(x)).orderBy("order", *fields).limit(n) for x, n in room.items()]
    return parts[0].unionByName(parts[1])


def train(labelled: DataFrame):
    """A forest fitted on drawn labelled findings with features; a number, the share of secrets, without both kinds."""
    sample = stash(labelled.select("label", "order", *[f"f_{x}" for x in FEATURES]).coalesce(1).sortWithinPartitions("order").drop("order"), "labelled")
    n, positive = sample.agg(F.count("*"), F.sum("label")).first()
    if not n or positive in (0, n):
        return positive / n if n else 0.5
    vectors = VectorAssembler(inputCols=[f"f_{x}" for x in FEATURES], outputCol="features").transform(sample)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(vectors)


def judge(found: DataFrame, forest) -> DataFrame:
    """Adds probability and is_secret (from 0.5 on) to findings with features."""
    if isinstance(forest, float):
        return found.withColumn("probability", F.lit(forest)).withColumn("is_secret", F.col("probability") >= 0.5)
    vectors = VectorAssembler(inputCols=[f"f_{x}" for x in FEATURES], outputCol="features").transform(found)
    scored = forest.transform(vectors).withColumn("probability", vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "prediction").withColumn("is_secret", F.col("probability") >= 0.5)


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(doc_id, word_no, value, before2, before, word, after, f_..., probability, is_secret) per finding.

    labelled: reviewed findings (value, before2, before, word, after, label); without it they are made from the documents.
    Null and empty texts have no findings; repeated rows give repeated findings; a null doc_id is kept as null. Other columns
    are not read. Without labelled findings of both kinds every finding gets the share of secrets among them, 0.5 if there are none.
    """
    found = stash(candidates(docs), "findings")
    words = stash(dictionary(docs), "dictionary")
    known = labelled_findings(found) if labelled is None else labelled.select("value", "before2", "before", "word", "after", F.col("label").cast("double").alias("label"))
    return judge(with_features(found, words), train(with_features(stash(drawn(known), "drawn"), words)))


def redact(docs: DataFrame, findings: DataFrame, mark: str = "[secret]", key: str = "doc_id") -> DataFrame:
    """The same documents, with every value judged a secret replaced by the mark.

    key: the column of the documents that the findings' doc_id holds. Columns may have any names; a null key meets the findings without one.
    """
    sized = F.struct(F.length("value").alias("size"), "value")
    secrets = findings.where("is_secret").groupBy("doc_id").agg(F.sort_array(F.collect_set(sized), asc=False).alias("found")).alias("f")
    text = F.col("d.text")
    cleaned = F.aggregate(F.col("f.found.value"), text.cast("string"), lambda t, v: F.replace(t, v, F.lit(mark)))
    columns = [F.when(F.col("f.found").isNull(), text).otherwise(cleaned).alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns]
    return docs.alias("d").join(secrets, F.col(f"d.`{key}`").eqNullSafe(F.col("f.doc_id")), "left").select(*columns)


def op1_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every finding in `documents` with its probability."""
    return scan(table(spark, sf_dir, "documents")).select("doc_id", "word_no", F.sha2("value", 256).alias("value_sha256"), F.length("value").alias("n_chars"), F.round("probability", 9).alias("probability"), "is_secret")
