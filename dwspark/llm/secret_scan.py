"""Secret scans with a random forest that removes false positives.

Candidates are the runs of at least MIN_LENGTH credential characters in a word, a
digit among them; a word may hold several. The forest sees a candidate's length, its classes of characters and the
transitions between them, how much of it is covered by words of a dictionary,
the path it stands in, and the words next to it. It is trained on labelled
findings, MAX_TRAIN of them at most, half of them of each class, chosen by hash; all findings are scored. The dictionary
is counted over all documents.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, row_identity, stored

MIN_LENGTH, MAX_TRAIN, MIN_COUNT = 12, 20_000, 20
# FIXED VALUES: names that credentials are assigned to, and words that mark samples.
CREDENTIAL = r"(?i)(token|secret|passw|pwd|api[_-]?key|apikey|access[_-]?key|private[_-]?key|credential|bearer|auth)"
SAMPLE = r"(?i)(example|sample|dummy|test|placeholder|changeme|your[_-]|xxxx)"
KEY = r"(A3T[A-Z0-9]|AKIA|ASIA)[A-Z0-9]{12,}|gh[pousr]_[A-Za-z0-9]{16,}|glpat-[\w-]{16,}|[rs]k_(live|test)_[A-Za-z0-9]{16,}|xox[abprs]-[\w-]{10,}|AIza[\w-]{30,}|eyJ[\w-]{10,}\.[\w-]{10,}"
CLEAR = (r"^[+-]?[0-9]+([.:/_,-][0-9]+)*[.:]?$|^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:.+-]+Z?$"       # numbers, dates, addresses
         r"|^[A-Za-z]+://|^[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}[.:]?$")                                   # URLs, mail
RUN = r"[A-Za-z0-9_+/=.@:-]"


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """One row per candidate: row (identity of the document), doc_id, word_no, run_no
    (its place among the runs of the word), candidate, word (the part of the word that
    belongs to it), before2, before1, after (words next to it, null at an end or where another
    candidate of the word stands between), path.
    Null, empty and digit-free texts have none; repeated rows count once."""
    path = F.col(f"`{path_col}`").cast("string") if path_col in docs.columns else F.lit(None).cast("string")
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), path.alias("path"))
            .filter(F.col("text").rlike(f"{RUN}{{{MIN_LENGTH}}}") & F.col("text").rlike("[0-9]"))
            .withColumn("row", row_identity(F.col("doc_id"), F.col("text")))
            .withColumn("words", F.split("text", f"[{SPACE}]+")))
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1),
                  lambda i: (F.length(F.get("words", i)) >= MIN_LENGTH) & F.get("words", i).rlike("[0-9]")
                  & F.get("words", i).rlike(f"{RUN}{{{MIN_LENGTH}}}"))
    rows = rows.withColumn("at", at)
    found = F.flatten(F.transform("at", _runs))
    # explode_outer: an inner explode would have its filter pushed below, where the words are split anew for each
    return (rows.select("row", "doc_id", "path", F.explode_outer(found).alias("f")).filter("f IS NOT NULL")
            .select("row", "doc_id", "path", "f.*").dropDuplicates(["row", "word_no", "run_no"]))


def _runs(i: Column) -> Column:
    """The candidates of word ``i``. Gaps lie around the runs, so a run's part of the word is the
    gap before it, with the run before that if it is its name, and the last gap after the last run:
    the parts of a word are no longer than twice the word."""
    word = F.get("words", i)
    runs, gaps = F.regexp_extract_all(word, F.lit(f"{RUN}{{{MIN_LENGTH},}}"), 0), F.split(word, f"{RUN}{{{MIN_LENGTH},}}", -1)

    def one(run: Column, k: Column) -> Column:
        before, gap, last = F.get(runs, k - 1), F.get(gaps, k), k == F.size(runs) - 1
        name = (k > 0) & (~before.rlike("[0-9]") | before.rlike("[=:]$") | gap.rlike("""^["'`]?[=:]"""))
        first = (k == 0) | ((k == 1) & name)
        part = F.concat(F.when(name, F.concat(F.get(gaps, k - 1), before)).otherwise(""), gap, run,
                        F.when(last, F.get(gaps, k + 1)).otherwise(""))
        return F.struct(i.alias("word_no"), k.alias("run_no"), part.alias("word"), F.when(first, F.get("words", i - 2)).alias("before2"),
                        F.when(first, F.get("words", i - 1)).alias("before1"), F.when(last, F.get("words", i + 1)).alias("after"), run.alias("candidate"))
    return F.filter(F.transform(runs, one), lambda f: f["candidate"].rlike("[0-9]"))


def dictionary(docs: DataFrame, text_col: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """Words of 3 to 15 letters that occur ``min_count`` times or more in all documents, in lower case."""
    return (docs.select(F.explode(F.split(F.lower(text_col), "[^a-z]+")).alias("word"))
            .filter(F.length("word").between(3, 15))
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count).select("word"))


FEATURES = ["length", "lower", "upper", "digits", "marks", "hex", "digit_to_letter", "letter_to_digit", "case_changes",
            "distinct", "coverage", "in_path", "path_depth", "path_sample", "named", "assigned", "quoted", "sample", "at_sign", "dots"]


# what labels are made from where none are given, and quotes, which come with an assignment: not seen by the forest then
CONTEXT = ["named", "assigned", "sample", "quoted"]


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds the columns of FEATURES, all numbers between 0 and 1 or counts."""
    c, n = F.col("candidate"), F.length("candidate")
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    near = F.concat_ws(" ", "before2", "before1", "word")
    letters = (found.select("row", "word_no", "run_no", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{3,}"), 0)).alias("word"))
               .join(words, "word").groupBy("row", "word_no", "run_no").agg(F.sum(F.length("word")).alias("covered")))
    return (found.join(letters, ["row", "word_no", "run_no"], "left").withColumns({
        "length": n.cast("double"), "lower": share("[a-z]"), "upper": share("[A-Z]"), "digits": share("[0-9]"),
        "marks": share("[^A-Za-z0-9]"), "hex": c.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "digit_to_letter": share("[0-9](?=[A-Za-z])"), "letter_to_digit": share("[A-Za-z](?=[0-9])"),
        "case_changes": share("[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "distinct": F.size(F.array_distinct(F.split("candidate", ""))) / n,
        "coverage": F.coalesce("covered", F.lit(0)) / n,
        "in_path": F.col("word").rlike(r"://|^/|/[^/]+/").cast("double"),
        "path_depth": F.coalesce(F.regexp_count("path", F.lit("/")), F.lit(0)).cast("double"),
        "path_sample": F.coalesce(F.col("path").rlike(SAMPLE), F.lit(False)).cast("double"),
        "named": near.rlike(CREDENTIAL).cast("double"),
        "assigned": F.concat_ws("", "before1", "word").rlike("[=:]").cast("double"),
        "quoted": F.col("word").rlike("""["'`]""").cast("double"),
        "sample": F.concat_ws(" ", near, "after").rlike(SAMPLE).cast("double"),
        "at_sign": F.instr("candidate", "@").cast("boolean").cast("double"), "dots": F.regexp_count(c, F.lit(r"\.")).cast("double"),
    }).drop("covered"))


def weak_labels(found: DataFrame) -> DataFrame:
    """Labels where none are given by people: 1 for a well-known key format and for what is
    assigned to a credential's name, 0 for a clear shape (number, date, address, URL, mail or
    dictionary words) that is not named; samples and all other runs, such as a random one
    in running text, have no label. The forest must not see CONTEXT then."""
    clear = F.col("candidate").rlike(CLEAR) | (F.col("coverage") >= 0.6)
    key = F.col("candidate").rlike(KEY)
    return found.withColumn("label", F.when((F.col("sample") == 0) & (key | ((F.col("named") == 1) & (F.col("assigned") == 1) & ~clear)), 1.0)
                            .when(clear & ~key & (F.col("named") == 0), 0.0))


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, max_train: int = MAX_TRAIN,
                 trees: int = 40, depth: int = 6, seed: int = 5, **columns) -> DataFrame:
    """One row per candidate: doc_id, word_no, run_no, candidate, probability, is_secret.

    ``labelled`` has (candidate, label 0 or 1), or (doc_id, word_no, run_no, label) of
    reviewed findings, where a label without run_no holds for all of a word; without it ``weak_labels`` are used. Null labels don't
    count; both classes weigh the same. If a class is missing among all labels nothing can be learned: probability is null
    and every candidate stays a finding.
    """
    scored = stored(with_features(findings(docs, **columns), dictionary(docs, columns.get("text_col", "text"))), "findings")
    if labelled is None:
        known = weak_labels(scored)
    else:
        on = [c for c in ("doc_id", "word_no", "run_no") if c in labelled.columns] if "word_no" in labelled.columns else ["candidate"]
        known = scored.join(labelled.select(*on, F.col("label").cast("double").alias("label")).dropDuplicates(on), on, "left")
    known = stored(known.filter("label IN (0.0, 1.0)").select("row", "word_no", "run_no", "label", *FEATURES), "labelled-findings")
    found = {r.label: min(r.n, max_train // 2) for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(found) < 2:
        return scored.select("doc_id", "word_no", "run_no", "candidate", F.lit(None).cast("double").alias("probability"), F.lit(True).alias("is_secret"))
    sample = [known.filter(F.col("label") == c).orderBy(F.xxhash64("row", "word_no", "run_no"), "row", "word_no", "run_no").limit(n)
              .withColumn("weight", F.lit(max(found.values()) / n)) for c, n in sorted(found.items())]
    known = stored(sample[0].unionByName(sample[1]), "training-findings")
    seen = FEATURES if labelled is not None else [c for c in FEATURES if c not in CONTEXT]
    assemble = VectorAssembler(inputCols=seen, outputCol="features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, weightCol="weight").fit(assemble.transform(known))
    p = vector_to_array("probability")[1]
    return (forest.transform(assemble.transform(scored)).withColumn("p", p)
            .select("doc_id", "word_no", "run_no", "candidate", F.col("p").alias("probability"), (F.col("p") >= threshold).alias("is_secret")))
