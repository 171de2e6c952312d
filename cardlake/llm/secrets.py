"""Secret scan: candidates by pattern, false positives removed by a random forest. DataFrame functions and MLlib only.

A candidate is a run of at least 16 letters, digits and signs, or a value of at least 6 characters without space behind a
credential word (``KEY``), whatever its signs. Its features are its length, shares and transitions of character classes, coverage by
dictionary words, path signs, and the words before and after it. The forest learns from labelled findings (text around a
candidate, label). Without a table of findings, ``planted_findings`` derives one: real text from any place of the documents with
credentials and look-alikes (digests, identifiers, paths, placeholders, words) set into it, whose labels are known; a table with few
texts gets fixed ones besides. The number of these findings is bounded (``FINDINGS`` texts of ``WINDOW`` characters); dictionary words are
counted over all texts, and the scan covers every text whole.

Texts are cut into candidates and the pieces between them in one pass of the pattern; texts without a candidate never move.

Defined cases: null and empty texts have no findings; a candidate that occurs twice is two findings; repeated rows are scanned row by
row; a row without secrets keeps its text unchanged; empty tables give no rows; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlake.session import stage

CHARS = r"[A-Za-z0-9+/_=-]"
KEY = r"(?i:passw(?:or)?d|passphrase|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|auth|bearer|credential)"
VALUE = r"""[^\s"':=>](?:[^\s"']|["'](?=[A-Za-z0-9])){4,}[^\s"'.,;:)\]}]"""
BEHIND = (rf"(?<![\w-])[\w-]{{0,40}}?{KEY}[\w-]{{0,12}}[\"']?(?:\s{{0,3}}(?:[:=]=?>?|->)\s{{0,3}}|\s{{1,3}}(?:is\s{{1,3}})?)"
          rf"(?:(?i:bearer|basic)\s{{1,3}})?[\"']?(?={VALUE})")
CANDIDATE = rf"(?:{BEHIND}{VALUE}|(?<!{CHARS})(?=[+/_=-]*[A-Za-z0-9]){CHARS}{{16,}})"
TREES, DEPTH, SEED = 30, 8, 11
FINDINGS, WINDOW, FEWEST = 2_000, 240, 200  # texts that planted findings are set into, their characters; with fewer, FIXED is used too
WORDS = 400  # dictionary words
FIXED = "The server reads its settings from a file and writes a report of what it did to another place when the work has come to an end."
MARK = "<secret>"
THRESHOLD = 0.5
# Neighbouring words that speak for and against a credential.
FOR = r"(?i)(secret|token|passw|pwd|api.?key|access.?key|auth|bearer|credential|private)"
AGAINST = r"(?i)(commit|sha\d*|md5|checksum|digest|uuid|guid|build|version|revision|etag|hash|path|file|href|src)"
PLACEHOLDER = r"(?i)(example|sample|dummy|your|placeholder|changeme|xxxx|test|1234567|abcdef)"


def has_candidate(text: Column) -> Column:
    return F.coalesce(text.rlike(CANDIDATE), F.lit(False))


def _candidates(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per candidate of ``text``: the kept columns, at (0-based place), start (1-based), found, before, after."""
    found = F.regexp_extract_all("text", F.lit(f"({CANDIDATE})"), 1)
    cut = rows.select(*keep, found.alias("hits"), F.split("text", CANDIDATE, -1).alias("gaps"))
    # The start of a candidate: all gaps up to it and all candidates before it.
    starts = F.aggregate(
        F.arrays_zip(F.slice("gaps", 1, F.size("hits")).alias("gap"), F.col("hits").alias("hit")),
        F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("all")),
        lambda done, x: F.struct((done["next"] + F.length(x["gap"]) + F.length(x["hit"])).alias("next"),
                                 F.concat(done["all"], F.array(done["next"] + F.length(x["gap"]))).alias("all")))["all"]
    lead = F.regexp_extract("hit", rf"^({BEHIND})", 1)  # the credential word and what stands up to its value
    return (cut.withColumn("starts", starts).select(*keep, F.col("gaps"), "starts", F.posexplode("hits").alias("at", "hit"))
            .withColumn("lead", lead)
            .select(*keep, "at", (F.element_at("starts", F.col("at") + 1) + F.length("lead")).alias("start"),
                    F.expr("substring(hit, length(lead) + 1)").alias("found"),
                    F.expr("right(concat(right(gaps[at], 48), lead), 48)").alias("before"), F.expr("left(gaps[at + 1], 24)").alias("after")))


def _share(column: Column, pattern: str) -> Column:
    return F.lit(1.0) - F.length(F.regexp_replace(column, pattern, "")) / F.length(column)


def _features(words: list[str]) -> Column:
    x, before, after = F.col("found"), F.col("before"), F.col("after")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        x, "[0-9]", "9"), "[a-z]", "8"), "[A-Z]", "7"), "[^789]", "6")
    runs = F.length(F.regexp_replace(classes, r"(.)\1+", "$1"))
    covered = _share(F.lower(x), "|".join(sorted(words, key=lambda w: (-len(w), w)))) if words else F.lit(0.0)
    last_word = F.regexp_extract(before, r"([\p{L}\p{N}_-]+)[^\p{L}\p{N}]*$", 1)
    flag = lambda c: c.cast("double")
    return F.array(*[c.cast("double") for c in (
        F.log1p(F.length(x)), _share(x, "[0-9]"), _share(x, "[A-Z]"), _share(x, "[a-z]"), _share(x, "[^A-Za-z0-9]"),
        runs / F.length(x), _share(F.lower(x), "[aeiou][^aeiou0-9]"), _share(F.lower(x), "[^aeiou0-9]{4,}"),
        F.size(F.array_distinct(F.split(x, ""))) / F.length(x), flag(x.rlike("^[0-9a-fA-F]+$")), flag(x.rlike("^[0-9-]+$")),
        covered, flag(x.rlike(r"[/_-][A-Za-z]{3,}[/_-]")), _share(x, "/"), flag(before.rlike(r"(://|[/\\.])[^\s]*$")),
        flag(after.rlike(r"^\.[a-z]{1,4}\b")), flag(before.rlike(r"[:=]\s*[\"']?$")), flag(before.rlike("[\"']$") & after.rlike("^[\"']")),
        flag(last_word.rlike(FOR)), flag(before.rlike(FOR)), flag(last_word.rlike(AGAINST)), flag(before.rlike(AGAINST)),
        flag(x.rlike(PLACEHOLDER)), flag(x.rlike(r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-")),
        flag(x.rlike("^[a-z]+$")), flag(x.rlike(r"^\p{Lu}?[\p{Ll}-]+$")), flag(x.rlike(r"[(){}<>\[\]]|^\$")), flag(x.rlike(r"(.)\1{3,}")),
        flag(before.rlike(rf"{KEY}[\w-]{{0,12}}[\"']?\s*[:=]")), flag(x.rlike("^(AKIA|ghp_|gho_|xox|sk_|pk_|eyJ|AIza)")))])


def _window(text: str) -> Column:
    """WINDOW characters from any place of a text, chosen by its hash."""
    return F.expr(f"substring({text}, 1 + cast(pmod(xxhash64({text}), greatest(1, length({text}) - {WINDOW - 1})) as int), {WINDOW})")


def planted_findings(docs: DataFrame, text: str = "text", bound: int = FINDINGS) -> DataFrame:
    """(text, label, first, last): for at most ``bound`` texts, least by hash, each kind of credential and look-alike set between their
    words, and the places (1-based) of what was set in."""
    base = (docs.select(F.col(text).cast("string").alias("text")).select(_window("text").alias("text")).filter("length(text) >= 40").distinct()
            .withColumn("h", F.xxhash64("text")).orderBy("h").limit(bound))
    hexes = F.sha2(F.concat(F.col("h").cast("string"), F.col("kind").cast("string")).cast("binary"), 256)
    mixed = F.regexp_replace(F.base64(F.unhex(hexes)), "=+$", "")
    upper = F.upper(F.regexp_replace(mixed, "[+/]", "7"))
    word = F.regexp_extract("text", r"([A-Za-z]{3,})", 1)
    q = F.lit('"')
    letters = F.translate(mixed, "0123456789+/", "qXvZkWjHyGpF")
    credentials = (
        F.concat(F.lit("token = "), q, F.substring(hexes, 1, 40), q), F.concat(F.lit("api_key: '"), F.substring(mixed, 1, 32), F.lit("'")),
        F.concat(F.lit("password="), F.substring(mixed, 1, 18)), F.concat(F.lit("secret: "), F.substring(hexes, 1, 32)),
        F.concat(F.lit("aws_access_key_id = AKIA"), F.substring(upper, 1, 16)), F.concat(F.lit("Authorization: Bearer "), mixed),
        F.concat(F.lit("ghp_"), F.regexp_replace(F.substring(mixed, 1, 36), "[+/]", "x")),
        F.concat(F.lit("token = "), q, F.substring(hexes, 5, 40), q),
        F.concat(F.lit("password: "), F.lower(word), F.regexp_replace(F.substring(hexes, 1, 2), "[a-f]", "2")),
        F.concat(F.lit("pwd "), q, F.substring(mixed, 1, 5), F.lit("&"), F.substring(mixed, 6, 4), F.lit("!"), q),
        F.concat(F.lit("db_password="), F.substring(mixed, 1, 4), F.lit("$"), F.substring(mixed, 5, 3)),
        F.concat(F.lit("my password is "), F.substring(mixed, 1, 9)), F.concat(F.lit("secret: '"), F.substring(letters, 1, 12), F.lit("'")),
        F.concat(F.lit("api_key="), F.substring(letters, 1, 28)), F.concat(F.lit("key "), F.substring(letters, 1, 32)),
        F.concat(F.lit("eyJ"), F.substring(letters, 1, 20), F.lit(".eyJ"), F.substring(letters, 9, 30), F.lit("."), F.substring(mixed, 1, 40)))
    others = (
        F.concat(F.lit("commit "), F.substring(hexes, 1, 40)), F.concat(F.lit("sha256: "), hexes), F.concat(F.lit("md5 "), F.substring(hexes, 1, 32)),
        F.concat(F.lit("id "), F.substring(hexes, 1, 8), F.lit("-"), F.substring(hexes, 9, 4), F.lit("-"), F.substring(hexes, 13, 4),
                 F.lit("-"), F.substring(hexes, 17, 4), F.lit("-"), F.substring(hexes, 21, 12)),
        F.concat(F.lit("/usr/lib/"), word, F.lit("/include/"), word, F.lit("-1.2")), F.concat(F.lit("https://host/"), word, F.lit("/page-2/"), word, F.lit("_3")),
        F.concat(F.lit("token = "), q, F.lit("YOUR_API_KEY_HERE_1"), q), F.concat(word, word, F.lit("-"), word, F.lit("-2024-"), word),
        F.concat(F.lit("call 2024-01-02-"), F.translate(F.substring(hexes, 1, 12), "abcdef", "123456")),
        F.concat(F.lit("number "), F.translate(F.substring(hexes, 1, 18), "abcdef", "123456")),
        F.lit("the password protected pages"), F.concat(F.lit("a token "), word, word), F.concat(F.lit("password is "), word, F.lit("able")),
        F.lit("password: required"), F.lit("token: string"), F.concat(F.lit("password=get"), word, F.lit("()")), F.lit("secret: ${SECRET_VALUE}"),
        F.lit("password: ********"), F.concat(word, F.lit("-"), word, F.lit("-"), word, F.lit("-"), word, F.lit("-"), word),
        F.concat(F.lower(word), F.lower(word), F.lower(word), F.lower(word), F.lower(word), F.lower(word)),
        F.concat(F.lit("see "), word, F.lit("/"), word, F.lit("/"), word, F.lit("/"), word, F.lit("/"), word))
    kinds = [*credentials, *others]
    rows = base.withColumn("kind", F.explode(F.array(*[F.lit(i) for i in range(len(kinds))])))
    snippet = F.coalesce(*[F.when(F.col("kind") == i, k) for i, k in enumerate(kinds)])
    half = F.expr("greatest(20, cast(length(text) / 2 as int))")
    set_in = F.concat(F.expr("left(text, greatest(20, cast(length(text) / 2 as int)))"), F.lit(" "), snippet, F.lit(" "),
                      F.substring("text", half + 1, F.lit(240)))
    first = F.expr("length(left(text, greatest(20, cast(length(text) / 2 as int))))") + 2
    return rows.select(set_in.alias("text"), (F.col("kind") < len(credentials)).cast("double").alias("label"), first.alias("first"),
                       (first + F.length(snippet) - 1).alias("last"))


class SecretModel:
    """A fitted false-positive filter."""

    def __init__(self, forest, words: list[str], threshold: float):
        self.forest, self.words, self.threshold = forest, words, threshold

    def judge(self, candidates: DataFrame) -> DataFrame:
        """The candidates with ``score`` (0 to 1) and ``secret`` (0 or 1)."""
        out = self.forest.transform(candidates.withColumn("vector", array_to_vector(_features(self.words))))
        return (out.withColumn("score", vector_to_array("probability")[1]).drop("vector", "rawPrediction", "probability", "prediction")
                .withColumn("secret", (F.col("score") >= self.threshold).cast("int")))


def fit_secrets(findings: DataFrame, dictionary: DataFrame, threshold: float = THRESHOLD) -> SecretModel:
    """``findings``: text, label (1 credential, 0 not), maybe first and last (where the label holds; words elsewhere are none, other
    candidates there are left out); ``dictionary``: texts whose most frequent words are known words."""
    words = [r["word"] for r in dictionary.select(F.explode(F.split(F.lower("text"), r"[^a-z]+")).alias("word"))
             .filter("length(word) between 4 and 12").groupBy("word").count().orderBy(F.desc("count"), "word").limit(WORDS).collect()]
    placed = [c for c in ("first", "last") if c in findings.columns]
    rows = _candidates(findings.filter("text is not null and label is not null"), "label", *placed)
    if len(placed) == 2:
        inside = F.col("start").between(F.col("first"), F.col("last"))
        rows = rows.filter(inside | ~F.col("found").rlike("[0-9]")).withColumn("label", F.when(inside, F.col("label")).otherwise(0.0))
    rows = rows.withColumn("vector", array_to_vector(_features(words)))
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return SecretModel(forest.fit(stage(rows.select("label", "vector"), "findings")), words, threshold)


def fit_planted(docs: DataFrame, text: str = "text") -> SecretModel:
    """A model from ``planted_findings``, in fixed text too if the table has less than FEWEST texts to plant them in."""
    base = docs.filter(F.length(text) >= 40).select(F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    # The least texts by hash, cut on the hash alone; at most twice the bound of them is read.
    cut = base.select("h").distinct().orderBy("h").limit(2 * FINDINGS).agg(F.max("h"), F.count("*")).first()
    some = base.filter(F.col("h") <= cut[0]) if cut[1] else base.limit(0)
    some = stage(some.select(_window("text").alias("text")).distinct(), "planted")
    if cut[1] < FEWEST:
        fixed = docs.sparkSession.range(FEWEST).select(F.concat(F.lit(FIXED + " "), F.col("id").cast("string"), F.lit(". " + FIXED)).alias("text"))
        some = some.unionByName(fixed)
    return fit_secrets(planted_findings(some), docs.select(F.col(text).alias("text")))


def find_secrets(docs: DataFrame, model: SecretModel | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per candidate: the kept columns, start, found, score, secret."""
    inner = [f"keep_{i}" for i in range(len(keep))]
    rows = docs.filter(has_candidate(F.col(text))).select(*[F.col(c).alias(i) for c, i in zip(keep, inner)], F.col(text).alias("text"))
    found = _candidates(rows, *inner)
    judged = model.judge(found) if model else found.withColumn("score", F.lit(1.0)).withColumn("secret", F.lit(1))
    return judged.select(*[F.col(i).alias(c) for c, i in zip(keep, inner)], "start", "found", "score", "secret")


def redact(docs: DataFrame, model: SecretModel | None, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs``; each secret in ``text`` is replaced by MARK. Only texts with candidates move."""
    rest = docs.filter(~has_candidate(F.col(text)))
    some = stage(docs.filter(has_candidate(F.col(text))).withColumn("secret_row", F.monotonically_increasing_id()), "with-candidates")
    found = find_secrets(some, model, text, keep=("secret_row",))
    marks = found.filter("secret = 1").groupBy("secret_row").agg(
        F.sort_array(F.collect_list(F.struct("start", F.length("found").alias("size")))).alias("secret_spans"))
    body = F.col(text)
    parts = F.aggregate("secret_spans", F.struct(F.lit(1).alias("next"), F.lit("").alias("out")),
                        lambda done, x: F.struct((x["start"] + x["size"]).alias("next"), F.concat(
                            done["out"], F.substring(body, done["next"], x["start"] - done["next"]), F.lit(MARK)).alias("out")))
    clean = F.concat(parts["out"], F.substring(body, parts["next"], F.length(body)))
    changed = some.join(marks, "secret_row", "left").withColumn(text, F.when(F.col("secret_spans").isNull(), body).otherwise(clean))
    return rest.unionByName(changed.select(*docs.columns))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_secrets(docs, fit_planted(docs))
    return found.select("doc_id", "start", F.length("found").cast("long").alias("n_chars"),
                        F.sha2(F.col("found").cast("binary"), 256).alias("found_sha256"), "score", "secret")
