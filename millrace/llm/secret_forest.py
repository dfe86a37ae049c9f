"""Secret scan with a random forest that removes false positives. DataFrame functions and Spark ML only.

A candidate is a run of 16 or more key-like characters with a digit; a word may hold many. Its features are its length, the transitions
between character kinds, how much of it a dictionary covers, whether it looks like a path or link, and the words beside it. The
forest is trained from labelled findings, a bounded sample of them.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import table

#: Words that name credentials (fixed values).
CREDENTIAL_WORDS = ["access", "api", "apikey", "auth", "bearer", "credential", "key", "passwd", "password", "private", "pwd", "secret", "token"]
VALUE = r"[A-Za-z0-9_+/\-]{16,}={0,2}"
#: What ends the piece of a word that a value belongs to, and the characters of the piece that are looked at on each side.
ENDS, BESIDE = r"?&,;{}\[\]|", 80
#: Findings that the forest is trained on, and words of the dictionary, at most.
SAMPLE, DICTIONARY = 20_000, 2_000
FEATURES = ["size", "digits", "uppers", "lowers", "changes", "distinct", "hexadecimal", "covered", "vowels", "path_like", "quoted", "assigned", "near_credential", "after_length", "before_length"]


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> list[str]:
    """The most frequent lower-case words of 4 to 20 ASCII letters in all texts: at most `size`, whatever the input."""
    words = docs.select(F.explode_outer(F.split(text_col, " ")).alias("w")).where(F.col("w").rlike("^[a-z]{4,20}$"))
    return [r[0] for r in words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(size).collect()]


def findings(docs: DataFrame, words: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, position, value, features): every candidate. id_col must not be named as one of these. position counts the text's words from 0; a word's candidates share it."""
    split = docs.select(id_col, F.split(F.regexp_replace(F.coalesce(text_col, F.lit("")), r"[\t\r\n]", " "), " ").alias("w"))
    # candidates are chosen inside each text's array, so that no other word becomes a row
    chosen = F.filter(F.transform("w", lambda x, i: F.struct(i.alias("position"), x.alias("word"))), lambda c: (F.length(c["word"]) >= 16) & c["word"].rlike(VALUE) & c["word"].rlike("[0-9]"))
    near = lambda c, k: F.lower(F.coalesce(F.get("w", c["position"] + k), F.lit("")))
    beside = lambda c: F.struct(c["position"].alias("position"), c["word"].alias("word"), F.concat_ws(" ", near(c, -3), near(c, -2), near(c, -1)).alias("before"), near(c, -1).alias("just_before"), near(c, 1).alias("after"))
    each = split.select(id_col, F.explode(F.transform(chosen, beside)).alias("_c")).select(id_col, "_c.*")
    each = each.withColumn("_values", F.regexp_extract_all("word", F.lit(VALUE), F.lit(0))).withColumn("_gaps", F.split("word", VALUE, -1))
    # the text before a value starts with the value before it: in name=value the name may be one
    one = lambda v, i: F.struct(v.alias("value"), i.alias("number"), F.concat(F.coalesce(F.get("_values", i - 1), F.lit("")), F.get("_gaps", i)).alias("lead"), F.get("_gaps", i + 1).alias("tail"))
    each = each.select(id_col, "position", "before", "just_before", "after", F.explode(F.filter(F.transform("_values", one), lambda c: c["value"].rlike("[0-9]"))).alias("_c")).select("*", "_c.*")
    each = each.withColumn("lead", F.regexp_extract(F.right("lead", F.lit(BESIDE)), f"[^{ENDS}]*$", 0)).withColumn("tail", F.regexp_extract(F.left("tail", F.lit(BESIDE)), f"^[^{ENDS}]*", 0))
    each = each.withColumn("piece", F.concat("lead", "value", "tail")).withColumn("lead", F.lower("lead"))
    n = F.length("value")
    share = lambda pattern: F.regexp_count("value", F.lit(pattern)) / n
    runs = F.filter(F.split(F.lower("value"), "[^a-z]+"), lambda r: F.length(r) >= 4)
    known = F.array(*(F.lit(w) for w in words)) if words else F.expr("cast(array() as array<string>)")
    credential = "(" + "|".join(CREDENTIAL_WORDS) + ")"
    return each.select(
        id_col, "position", "value",
        n.cast("double").alias("size"), share("[0-9]").alias("digits"), share("[A-Z]").alias("uppers"), share("[a-z]").alias("lowers"),
        share("(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]|(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]").alias("changes"),
        (F.size(F.array_distinct(F.split("value", ""))) / n).alias("distinct"), F.col("value").rlike("^[0-9a-fA-F]+$").cast("double").alias("hexadecimal"),
        F.coalesce(F.size(F.array_intersect(runs, known)) / F.nullif(F.size(runs), F.lit(0)), F.lit(0.0)).alias("covered"), share("[aeiouAEIOU]").alias("vowels"),
        F.col("piece").rlike(r"://|/[a-z]+/|\.[a-z]{2,5}\b|@").cast("double").alias("path_like"), F.col("piece").rlike("[\"']").cast("double").alias("quoted"),
        (F.col("lead").rlike("[=:]") | ((F.col("number") == 0) & F.col("just_before").rlike("[=:]$|^[\"']?(bearer|basic)$"))).cast("double").alias("assigned"), F.concat_ws(" ", "before", "lead").rlike(credential).cast("double").alias("near_credential"),
        F.length("after").cast("double").alias("after_length"), F.length("just_before").cast("double").alias("before_length"),
    )


def train(labelled: DataFrame, trees: int = 24, depth: int = 6, sample: int = SAMPLE, seed: int = 3) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (a label of 0 or 1 and the features), at most `sample` of them; None where one label is missing."""
    chosen = labelled.select(F.col("label").cast("double"), "value", *FEATURES).orderBy(F.xxhash64("value", F.lit(9)), *FEATURES).limit(sample)
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(chosen).select("label", "features").persist()
    try:
        if ready.select("label").distinct().count() < 2:
            return None
        return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(ready)
    finally:
        ready.unpersist()


def judge_findings(found: DataFrame, model: RandomForestClassificationModel | None, threshold: float = 0.5) -> DataFrame:
    """found with score (0 to 1, 1 without a model) and is_secret."""
    if model is None:
        return found.withColumn("score", F.lit(1.0)).withColumn("is_secret", F.lit(True))
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found))
    return scored.withColumn("score", vector_to_array("probability")[1]).withColumn("is_secret", F.col("score") >= threshold).drop("features", "rawPrediction", "probability", "prediction")


def weak_labels(found: DataFrame) -> DataFrame:
    """Labels for findings where no reviewed ones exist: 1 for a value assigned to a credential name, 0 for links, paths,
    plain numbers and values that words of the dictionary cover. Others, such as bare keys in prose, have no label and are left out."""
    sure = (F.col("assigned") == 1) & (F.col("near_credential") == 1) & (F.col("path_like") == 0) & (F.col("changes") > 0.1)
    unsure = (F.col("path_like") == 1) | (F.col("digits") == 1) | (F.col("covered") > 0.5)
    return found.withColumn("label", F.when(sure, 1).when(unsure, 0)).where("label IS NOT NULL")


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(id_col, position, value, score, is_secret) of every candidate in the whole texts.

    labelled: reviewed findings with a label; weak_labels() of the candidates stand in for them. Null and empty texts have no
    candidates; repeated rows give repeated findings; null ids stay null; an empty table gives an empty table. Only id_col and
    text_col are read; an id_col named as another column of the result comes back as <id_col>_id.
    """
    name = f"{id_col}_id" if id_col in ("position", "value", "score", "is_secret") else id_col
    docs = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    found = findings(docs, dictionary(docs, "_text"), "_id", "_text")
    model = train(weak_labels(found) if labelled is None else labelled)
    return judge_findings(found, model, threshold).select(F.col("_id").alias(name), "position", "value", "score", "is_secret")


def op5_query(spark, sf_dir: str) -> DataFrame:
    out = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "position", F.sha2("value", 256).alias("value_sha256"), F.length("value").alias("length"), F.round("score", 6).alias("score"), "is_secret")
