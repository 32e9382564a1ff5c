"""Secret scan: candidates by assignment and by shape, and a random forest that takes the false positives out.

DataFrame and SQL functions and Spark's own forest only. The forest sees a candidate's length,
character classes and transitions, how likely its letter pairs are in the corpus, how much of it the
corpus dictionary covers, whether and to what kind of name it is assigned, and how often its path, the
words beside it and the value itself belonged to secrets among labelled findings.

Without a table of reviewed findings the labels come from values planted into a sample of the texts: what is
planted is known, whatever the features say. Secrets and near misses share their names, separators,
quotes and shapes, so no single feature tells them apart.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import lower_ascii
from tidewatch.shared import durable, scratch_path

SPACE = r"[\x20\x09-\x0D]+"
# What stands alone must look like a key; what is assigned to a name of secrets may look like anything.
CANDIDATE = "[A-Za-z0-9_+/.@-]{12,}={0,2}"
KEY_LIKE = "[0-9]|^(?=.*[A-Z]{2}).{16}"  # a digit, or from 16 characters on two capitals side by side
# Fixed words that names of secrets end in.
SECRET_NAMES = ("token", "secret", "password", "passwd", "pwd", "passphrase", "key", "auth", "credential")
ASSIGNMENTS = ("=", ":", ":=", "=>")
QUOTED_PIECES = 8  # a quoted value with spaces closes within so many pieces, or only its first piece counts
DICTIONARY_COUNT = 5  # occurrences in the corpus that make a run of letters a word
SAMPLE_ROWS = 10_000  # labelled findings of each kind that the tables and the forest are fitted on
SAMPLE_DOCS, SAMPLE_CHARS, PLANTED = 1_500, 4_000, 6_000  # texts, characters of each, and values planted in them
TREES, DEPTH, SEED = 40, 8, 7
THRESHOLD = 0.5

_ENDS = f"(?i)(?:{'|'.join(SECRET_NAMES)})s?"
_CLOSE, _SEP = r"[0-9_.-]*[\"'\])]*", "(?::=|=>|=|:)"
_NAME = "(?<![A-Za-z])([A-Za-z]+)" + _CLOSE  # starts at whole runs of letters only, so it stays linear
_INSIDE = f"(?s){_NAME}{_SEP}(?![=:>]|//)(.+)$"
_NEXT_PAIR = r"[&;,](?=[\"']?[A-Za-z_][A-Za-z0-9_.-]{0,40}[\"']?[=:])"
_QUOTED = r"(?s)^([\"'`])(.*?)\1"
_OPENING, _CLOSING = r"^[(\"'`<\[{]+", r"(?<![\"'`,;.)\]}>])[\"'`,;.)\]}>]+$"

_PAIRS = [a + b for a in "luds" for b in "luds"]
_BESIDE = ("before", "name", "after", "path", "same")
FEATURES = [
    "length", "digits", "uppers", "symbols", "distinct", *(f"to_{p}" for p in _PAIRS), "likely", "covered", "assigned", "secret_name",
    "sample_path",
] + [f"odds_{c}" for c in _BESIDE]
_FINDING = ["doc_id", "word", "value", "assigned", *_BESIDE]


def secret_candidates(docs: DataFrame) -> DataFrame:
    """doc_id, word, value, assigned, and what stands beside: every value that may be a secret.

    ``word`` counts the pieces of the whole text between white space from 0. A piece is cut where ``&``, ``;`` or ``,``
    starts a further pair. A value is assigned if a name and a separator stand before it, in the same piece or in
    the one or two pieces before. Assigned to a name that ends in one of ``SECRET_NAMES``, any value counts, of any length
    and with any characters, without the quotes and brackets around it; else every run of ``CANDIDATE`` does that is ``KEY_LIKE``.
    ``name`` is the last run of letters of the name, ``before`` and ``after`` are the pieces around (letters only), all in
    lower case; ``same`` is the value itself in lower case.
    """
    words = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("path"),
        F.split(F.coalesce("text", F.lit("")), SPACE).alias("words"),
    )
    piece = lambda i: F.get("words", i)
    ends = lambda c: c.endswith("=") | c.endswith(":") | c.endswith(">")
    places = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: ((F.length(piece(i)) >= 12) & piece(i).rlike("[0-9]|[A-Z]{2}"))
        | ((piece(i).contains("=") | piece(i).contains(":")) & piece(i).rlike(_ENDS + _CLOSE + _SEP + "."))
        | (ends(piece(i - 1)) & (
            piece(i - 1).rlike(_ENDS + _CLOSE + _SEP + "$")
            | (piece(i - 1).isin(*ASSIGNMENTS) & piece(i - 2).rlike(_ENDS + _CLOSE + "$")))),
    )
    at = F.explode(F.transform(places, lambda i: F.struct(
        i.alias("word"), piece(i).alias("piece"), piece(i - 1).alias("p1"), piece(i - 2).alias("p2"), piece(i - 3).alias("p3"),
        piece(i + 1).alias("after"),
        # Further pieces only where an open quote may need them.
        F.when(piece(i).rlike("[\"'`]"), F.concat_ws(" ", F.slice("words", i + 2, QUOTED_PIECES - 1))).alias("more"),
    )))
    found = words.select("doc_id", "path", at.alias("at")).select("doc_id", "path", "at.*")
    found = found.select("*", F.posexplode(F.split("piece", _NEXT_PAIR)).alias("part_number", "part"))
    first = F.col("part_number") == 0
    inside = F.regexp_extract("part", _INSIDE, 1)
    beside = F.when(first & ends(F.col("p1")), F.regexp_extract("p1", f"{_NAME}{_SEP}$", 1))
    apart = F.when(first & F.col("p1").isin(*ASSIGNMENTS), F.regexp_extract("p2", _NAME + "$", 1))
    filled = lambda c: F.when(c != "", c)
    found = found.withColumn("name", lower_ascii(F.coalesce(filled(inside), filled(beside), filled(apart), F.lit(""))))
    before = F.when(inside != "", F.when(first, F.col("p1"))).when(filled(beside).isNotNull(), F.col("p2"))
    before = before.when(filled(apart).isNotNull(), F.col("p3")).otherwise(F.col("p1"))
    rest = F.when(inside != "", F.regexp_extract("part", _INSIDE, 2)).otherwise(F.col("part"))
    found = found.withColumns({"before": before, "rest": rest, "named": F.col("name").rlike(_ENDS + "$")})
    closed = F.regexp_extract(F.concat_ws(" ", "rest", "more"), _QUOTED, 2)
    single = F.regexp_extract("rest", _QUOTED, 2)
    whole = F.coalesce(filled(single), filled(closed), F.regexp_replace(F.regexp_replace("rest", _OPENING, ""), _CLOSING, ""))
    alone = F.filter(F.regexp_extract_all("part", F.lit(CANDIDATE), F.lit(0)), lambda v: v.rlike(KEY_LIKE))
    values = F.when(F.col("named"), F.filter(F.array(whole), lambda v: v.rlike("[^=:>]"))).otherwise(alone)
    bare = lambda c: F.coalesce(F.regexp_replace(lower_ascii(F.col(c)), r"[^a-z\x{80}-\x{10FFFF}]", ""), F.lit(""))
    return found.select(
        "doc_id", "word", F.explode(values).alias("value"), (F.col("name") != "").cast("int").alias("assigned"), "name",
        bare("before").alias("before"), bare("after").alias("after"), F.coalesce("path", F.lit("")).alias("path"),
    ).withColumn("same", lower_ascii(F.col("value")))


# ---------------------------------------------------------------------------------------------
# Planted findings

# What values are made of: a hash of the place (hex), letters and digits from it (b64), digits (num), n from 0 to 999, words
# of the text (w1 to w3) and, chosen by the hash, the names, separators and marks below.
_CHOICES = {
    "cue": ("token", "secret", "password", "passwd", "pwd", "key", "api_key", "access_token", "auth", "credentials", "Password", "SECRET_KEY"),
    "prefix": ("", "", "db_", "aws_", "my", "service-", "X_"),
    "plain": ("id", "hash", "checksum", "file", "version", "build", "ref", "name", "user", "etag", "digest", "item"),
    "assign": ("=", ":", " = ", ": ", " := ", " : ", " => ", "= "),
    "quote": ("", "", '"', "'"),
    "sym": ("!", "$", "#", "%", "&", "*", "?", "_"),
    "number_cue": ("order ", "invoice ", "card ", "no ", "", "", ""),
    "revision_cue": ("commit ", "revision ", "sha ", "tree ", "", ""),
    "id_prefix": ("ghp_", "sk_live_", "xoxb-", "glpat-", "AIza"),
    "filler": ("changeme", "<password>", "your_token_here", "xxxxxxxx", "none", "null", "${PASSWORD}", "********", "example", "required"),
    "glue": ("", "", "", ".", ",", ")"),
}
_TO_SECRET, _TO_PLAIN = "concat(prefix, cue, assign, quote)", "concat(plain, assign, quote)"
# form: whether it is a secret, what stands before the value, the value, what stands behind it; SQL over the columns above.
FORMS = {
    "hex": (1, _TO_SECRET, "left(hex, 16 + n % 49)", "quote"),
    "base64": (1, _TO_SECRET, "left(b64, 20 + n % 16)", "quote"),
    "word and digits": (1, _TO_SECRET, "concat(w1, left(num, 1 + n % 4), sym)", "quote"),
    "mixed": (1, _TO_SECRET, "concat(left(w1, 2), left(num, 2), sym, initcap(left(w2, 4)), right(num, 1))", "quote"),
    "joined words": (1, _TO_SECRET, "concat(w1, w2, w3)", "quote"),
    "dashed words": (1, _TO_SECRET, "concat_ws('-', w1, w2, w3)", "quote"),
    "spaced words": (1, "concat(prefix, cue, assign, '\"')", "concat_ws(' ', w1, w2, w3)", "'\"'"),
    "digits": (1, _TO_SECRET, "left(num, 4 + n % 12)", "quote"),
    "capital hex": (1, _TO_SECRET, "upper(left(hex, 20 + n % 21))", "quote"),
    "parted hex": (1, _TO_SECRET, "concat_ws('-', left(hex, 8), substr(hex, 9, 4), substr(hex, 13, 4), substr(hex, 17, 12))", "quote"),
    "cloud id": (1, "''", "concat('AKIA', upper(left(b64, 16)))", "''"),
    "prefixed": (1, "''", "concat(id_prefix, left(b64, 24 + n % 12))", "''"),
    "bearer": (1, "'Authorization: Bearer '", "left(b64, 40)", "''"),
    "bare base64": (1, "''", "left(b64, 32 + n % 8)", "''"),
    "revision": (0, "revision_cue", "left(hex, 40)", "''"),
    "digest": (0, _TO_PLAIN, "left(hex, 16 + n % 49)", "quote"),
    "plain value": (0, _TO_PLAIN, "concat(w1, w2, left(num, 3))", "quote"),
    "plain base64": (0, _TO_PLAIN, "left(b64, 20 + n % 16)", "quote"),
    "plain number": (0, _TO_PLAIN, "left(num, 12 + n % 8)", "quote"),
    "capitals": (0, "''", "upper(concat(w1, '_', w2, '_', w3))", "''"),
    "uuid": (0, "''", "concat_ws('-', left(hex, 8), substr(hex, 9, 4), substr(hex, 13, 4), substr(hex, 17, 4), substr(hex, 21, 12))", "''"),
    "card": (0, "number_cue", "left(num, 16)", "''"),
    "number": (0, "number_cue", "left(num, 12 + n % 8)", "''"),
    "mail": (0, "''", "concat(w1, '.', left(num, 2), '@', w2, right(num, 1), '.example.com')", "''"),
    "address": (0, "''", "concat_ws('.', 100 + n % 100, 100 + n % 87, 10 + n % 71, 100 + n % 67)", "''"),
    "day and time": (0, "''", "concat('20', left(num, 2), '-0', 1 + n % 9, '-1', n % 9, 'T1', n % 7, ':', 10 + n % 50)", "''"),
    "file": (0, "''", "concat(w1, '_', w2, '_20', left(num, 6), '.txt')", "''"),
    "link": (0, "''", "concat('www.', w1, left(num, 2), '.example/', w2, '/', substr(num, 5, 4))", "''"),
    "release": (0, "''", "concat(w1, '-', w2, '-', n % 9, '.', n % 31, '.', n % 17, '-rc', n % 5)", "''"),
    "filler": (0, _TO_SECRET, "filler", "quote"),
    "prose": (0, "concat(cue, ': ')", "w1", "''"),
    "lookup": (0, _TO_SECRET, "concat('env.', w1, '.', cue)", "quote"),
    "variable": (0, _TO_SECRET, "concat('$', upper(w1), '_', upper(cue))", "quote"),
}


def planted_texts(docs: DataFrame, forms: Iterable[str] = tuple(FORMS)) -> DataFrame:
    """doc_id, source and text around a ``planted`` value each, with its ``form`` and whether it is a ``secret``.

    At most ``PLANTED`` values (64 in one text) between pieces of at most ``SAMPLE_DOCS`` texts by a hash, of their
    first ``SAMPLE_CHARS`` characters.
    """
    forms = list(forms)
    rows = docs.select(F.xxhash64(F.col("doc_id").cast("long"), "text").alias("number"), "source", F.left("text", F.lit(SAMPLE_CHARS)).alias("text"))
    total = docs.count()
    if total > SAMPLE_DOCS:
        rows = rows.where(F.pmod("number", F.lit(1 << 20)) < int(2 * SAMPLE_DOCS / total * (1 << 20)) + 1)
    rows = rows.orderBy("number", "source").limit(SAMPLE_DOCS)
    each = min(64, -(-PLANTED // max(1, min(total, SAMPLE_DOCS))))
    rows = rows.select(
        "number", "source", F.split(F.coalesce("text", F.lit("")), SPACE).alias("pieces"),
        F.filter(F.split(lower_ascii(F.coalesce("text", F.lit(""))), "[^a-z]+"), lambda w: F.length(w).between(4, 12)).alias("letters"),
        F.explode(F.sequence(F.lit(1), F.lit(each))).alias("k"),
    ).withColumn("place", F.concat_ws(":", "number", "k"))

    def chosen(salt: str, size: Column | int) -> Column:
        return F.pmod(F.xxhash64("place", F.lit(salt)), F.lit(size) if isinstance(size, int) else size).cast("int")

    digest = lambda salt: F.sha2(F.concat("place", F.lit(salt)), 256)
    spare = {"w1": "harbor", "w2": "meadow", "w3": "lantern"}
    rows = rows.withColumns({
        "hex": digest("h"),
        "b64": F.regexp_replace(F.base64(F.concat(F.unhex(digest("b")), F.unhex(digest("c")))), "[^A-Za-z0-9]", ""),
        "num": F.translate(digest("n"), "abcdef", "123456"),
        "n": chosen("s", 1000),
        **{w: F.coalesce(F.get("letters", chosen(w, F.greatest(F.size("letters"), F.lit(1)))), F.lit(word)) for w, word in spare.items()},
        **{c: F.get(F.array(*map(F.lit, options)), chosen(c, len(options))) for c, options in _CHOICES.items()},
        "form": F.get(F.array(*map(F.lit, forms)), chosen("form", len(forms))),
        "at": chosen("at", F.size("pieces")),
    })

    def by_form(part: int) -> Column:
        return reduce(lambda c, f: c.when(F.col("form") == f, F.expr(str(FORMS[f][part]))), forms, F.when(F.lit(False), F.expr(str(FORMS[forms[0]][part]))))

    left = F.slice("pieces", F.greatest(F.col("at") - 6, F.lit(1)), F.least(F.col("at"), F.lit(6)))
    planted = rows.select(
        F.xxhash64("place").alias("doc_id"), "form", by_form(0).alias("secret"), by_form(2).alias("planted"), F.col("source"),
        F.concat_ws(" ", left, F.concat(by_form(1), by_form(2), by_form(3), "glue"), F.slice("pieces", F.col("at") + 1, 6)).alias("text"),
    )
    return planted.dropDuplicates(["doc_id"])


def planted_findings(docs: DataFrame, forms: Iterable[str] = tuple(FORMS)) -> DataFrame:
    """The candidates in planted texts, with ``form`` and ``secret``: findings whose truth is known.

    A candidate counts if it is the planted value or part of it, or has it as a part.
    """
    planted = durable(planted_texts(docs, forms))
    truth = planted.select("doc_id", "form", "secret", "planted")
    found = secret_candidates(planted).join(truth, "doc_id")
    return found.where(F.col("planted").contains(F.col("value")) | F.col("value").contains(F.col("planted"))).drop("planted")


# ---------------------------------------------------------------------------------------------
# Features and forest


def corpus_words(docs: DataFrame) -> DataFrame:
    """word and n: every run of a-z (A-Z in lower case) of all texts, with its number of places.

    :func:`scan_secrets` keeps those with two places or more, for the dictionary and the letter pairs alike:
    the values that are looked for stand once, and would make their own pairs likely.
    """
    words = docs.select(F.explode(F.split(lower_ascii(F.coalesce("text", F.lit(""))), "[^a-z]+")).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _letter_pairs(column: Column) -> Column:
    """All pairs of neighbouring letters of every run of letters in the column."""
    runs = F.filter(F.split(column, "[^a-z]+"), lambda r: F.length(r) > 1)
    return F.flatten(F.transform(runs, lambda r: F.transform(
        F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, F.lit(2))
    )))


def value_features(values: DataFrame, words: DataFrame) -> DataFrame:
    """The features of every distinct ``value`` that follow from its characters."""
    lower = lower_ascii(F.col("value"))
    classes = F.translate(
        "value", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "l" * 26 + "u" * 26 + "d" * 10
    )
    classes = F.regexp_replace(classes, "[^lud]", "s")
    shaped = values.select("value").distinct().withColumns({"length": F.length("value").cast("double"), "classes": classes})
    distinct = F.size(F.array_distinct(F.split("value", ""))) / F.col("length")
    share = lambda pattern: F.regexp_count("classes", F.lit(pattern)) / F.col("length")
    shaped = shaped.select(
        "value", "length", share("d").alias("digits"), share("u").alias("uppers"), share("s").alias("symbols"), distinct.alias("distinct"),
        *[share(f"{p[0]}(?={p[1]})").alias(f"to_{p}") for p in _PAIRS],
    )

    # At most 26 x 26 rows.
    counts = words.select("n", F.explode(_letter_pairs(F.col("word"))).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 1
    counts = counts.select("pair", F.log2(F.col("n") / total * 676).alias("weight"))
    pairs = values.select("value").distinct().select("value", F.explode(_letter_pairs(lower)).alias("pair"))
    likely = pairs.join(F.broadcast(counts), "pair", "left").groupBy("value")
    likely = likely.agg(F.avg(F.coalesce("weight", F.lit(-10.0))).alias("likely"))

    runs = values.select("value").distinct().select("value", F.explode(F.split(lower, "[^a-z]+")).alias("word"))
    known = words.where(F.col("n") >= DICTIONARY_COUNT).select("word")
    covered = runs.where(F.length("word") >= 3).join(known, "word").groupBy("value")
    covered = covered.agg(F.sum(F.length("word")).alias("covered"))
    return shaped.join(likely, "value", "left").join(covered, "value", "left").withColumns({
        "likely": F.coalesce("likely", F.lit(0.0)), "covered": F.coalesce(F.col("covered") / F.col("length"), F.lit(0.0)),
    })


def with_odds(candidates: DataFrame, findings: DataFrame) -> DataFrame:
    """The candidates with smoothed log-odds of the path and of each word beside them among ``findings``.

    The tables have a row per value among at most 2 x ``SAMPLE_ROWS`` findings, so they are broadcast.
    """
    good = F.sum("secret")
    for column in _BESIDE:
        odds = F.log((good + 2) / (F.count(F.lit(1)) - good + 2)).alias(f"odds_{column}")
        candidates = candidates.join(F.broadcast(findings.groupBy(column).agg(odds)), column, "left")
    return candidates.fillna(0.0, [f"odds_{c}" for c in _BESIDE])


def _sample(findings: DataFrame, remainder: int) -> DataFrame:
    """At most ``SAMPLE_ROWS`` findings of each kind, by a hash, of ids whose crc32 has this remainder by 3."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == remainder
    kinds = [
        findings.where(fold & (F.col("secret") == kind)).orderBy(F.xxhash64("doc_id", "word", "value"), "doc_id", "word", "value").limit(SAMPLE_ROWS)
        for kind in (0, 1)
    ]
    return reduce(DataFrame.unionByName, kinds)


class SecretForest:
    """The tables of odds and the forest that are learned from labelled findings, with the corpus words they need."""

    def __init__(self, findings: DataFrame, words: DataFrame):
        self.words = words
        columns = findings.select(*_FINDING, F.col("secret").cast("int").alias("secret"))
        self.tables, taught = (durable(_sample(columns, r)) for r in (0, 2))
        lessons, good = taught.agg(F.count(F.lit(1)), F.coalesce(F.sum("secret"), F.lit(0))).first()
        self.share = (good + 0.5) / (lessons + 1) if lessons else 0.5
        self.model = None
        if 0 < good < lessons:
            forest = RandomForestClassifier(labelCol="secret", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
            # A bounded sample, in one order, so that the same trees grow again.
            order = ["doc_id", "word", "value"]
            ordered = self._described(taught).select("features", "secret", *order).coalesce(1)
            self.model = forest.fit(ordered.sortWithinPartitions(*order))

    def _described(self, candidates: DataFrame) -> DataFrame:
        sample_path = lower_ascii(F.col("path")).rlike("test|example|sample|mock|fixture|doc").cast("int")
        known = candidates.withColumns({
            "sample_path": sample_path, "secret_name": F.col("name").rlike(_ENDS + "$").cast("int"),
        })
        shaped = durable(value_features(candidates, self.words))
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_odds(known, self.tables).join(shaped, "value"))

    def score(self, candidates: DataFrame) -> DataFrame:
        """The candidates with ``score`` (0 to 1)."""
        if self.model is None:
            return candidates.withColumn("score", F.lit(self.share))
        return self.model.transform(self._described(candidates)).withColumn("score", vector_to_array("probability")[1])


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """doc_id, word, value, score (0 to 1) and secret (1: score of ``THRESHOLD`` or more) of all candidates.

    ``findings`` are labelled candidates: the columns of :func:`secret_candidates` with ``secret`` (default:
    :func:`planted_findings`). The tables of odds are learned from those of ids whose crc32 (as text) has the
    remainder 0 by 3, the forest from those with 2; those with 1 are never learned from. Without findings of both kinds the
    score is the share of secrets. Null text is empty, a null source an empty path, and a null ``doc_id`` is kept
    but never learned from. Repeated rows are reported each; values at one place are a row each; a text of any length is read
    whole; other columns are ignored; a table without candidates gives no row.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "words")
    corpus_words(docs).where(F.col("n") > 1).write.parquet(path)
    found = durable(secret_candidates(docs))
    findings = planted_findings(docs) if findings is None else findings
    scored = SecretForest(findings, spark.read.schema("word string, n long").parquet(path)).score(found)
    return scored.select("doc_id", "word", "value", "score", (F.col("score") >= THRESHOLD).cast("int").alias("secret"))
