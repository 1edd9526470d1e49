"""Operator 9: secret scan, with a random forest that removes false positives.

DataFrame functions only. Candidates are long runs of the characters that keys are made of, and
values of SHORT characters or more, of any kind, that follow a key word and = or a colon;
a forest judges each by its length, its marks and vowels, its changes between kinds of characters, the share of it
that dictionary words cover, whether it is part of a path, and the words before and after
it. The dictionary is the words of the candidate's own document and a few fixed ones.
The forest is trained from labelled findings: rows of `before`, `word`, `after`, `known`, `twice`
(the letter runs of the word that its document has as words, once or twice at least),
`candidate`, `label`. Without a table of such, `labelled_findings` makes some from a bounded
sample of documents: keys of usual shapes and, as false positives, digests and numbers
without a key's context, hosts, paths, dates, versions, placeholders and joined words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.session import scratch_dir

LEAST, SHORT = 16, 8
SAMPLE_DOCUMENTS = 1500
TREES, DEPTH = 40, 8
REPLACEMENT = "[SECRET]"

_CANDIDATE = rf"[A-Za-z0-9+/_.\-]{{{LEAST},}}={{0,2}}"
# Fixed words: of paths, hosts, placeholders and settings.
_WORDS = (
    "account bucket change client config data default demo dummy example file foo bar home host http https "
    "index key lib local mail main name page password path placeholder sample secret server share test token "
    "usr user value version www your"
).split()
# Fixed words before a key.
_KEY_WORDS = (
    r"(?i)(token|secret|passw(or)?d|passwd|pwd|api[_\-]?key|access[_\-]?key|private[_\-]?key|auth|bearer|"
    r"credential|signature)"
)
# A value after a key word and = or a colon, up to its quote or the next parameter, in the last word of
# a few; the third group. Stops that end a sentence are not part of it.
_VALUE = r"(?:(?!&[A-Za-z_]+=)[^\s\"'`<>,;(){}\[\]])"
_ASSIGNED = (
    _KEY_WORDS.replace("(?i)", "(?i:") + r")[A-Za-z0-9_\-]*[\"'`\]]* ?(?:=>|:=|==?|:) ?[\"'`]*"
    rf"({_VALUE}{{{SHORT - 1},}}(?![.:?]){_VALUE})(?=[^ ]*$)"
)
FEATURES = (
    "length marks vowels changes digits uppers distinct hexadecimal numeric coverage path prefixed assigned quoted key_near "
    "key_before hash_before"
).split()


_SPLIT = r"[\x20\x09-\x0D]+"


def _parts(word: Column) -> Column:
    return F.regexp_extract_all(F.lower(word), F.lit("[a-z]{3,}"), 0)


def _lowered(words: Column) -> Column:
    return F.split(F.lower(F.concat_ws(" ", words)), " ")


def _repeated(words: Column) -> Column:
    """Words that are there twice or more: equal neighbours in order."""
    ordered = F.array_sort(words)
    pairs = F.arrays_zip(ordered.alias("one"), F.slice(ordered, 2, F.greatest(F.size(ordered), F.lit(1))).alias("next"))
    return F.array_distinct(F.transform(F.filter(pairs, lambda z: z["one"] == z["next"]), lambda z: z["one"]))


def _context(docs: DataFrame) -> DataFrame:
    """Documents with candidates: one row for each, with the words around it.

    `known` and `twice` have the letter runs of the candidate's word that are words of the document, once
    or more and twice or more. A document's words are looked up once for all of its candidates, and
    no row carries them.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.split(text, _SPLIT)
    # The words are the function's argument, not looked up in it: that would split anew for each.
    blank = F.lit("")
    near = F.arrays_zip(words, F.concat(F.array(blank), words), F.concat(F.array(blank, blank), words))

    def chosen(z: Column, i: Column) -> Column:
        long = (F.length(z["0"]) >= LEAST) & z["0"].rlike(r"[0-9]|[a-z][A-Z]")
        said = F.concat_ws(" ", z["2"], z["1"], z["0"])
        # Cheap tests go first: the pattern has a sign, = or a colon, that few words are near to.
        signed = F.contains(said, F.lit("=")) | F.contains(said, F.lit(":"))
        assigned = (F.length(z["0"]) >= SHORT) & signed & said.rlike(_ASSIGNED)
        return F.when(long | assigned, i)

    long = F.array_compact(F.transform(near, chosen))
    rows = docs.select("doc_id", words.alias("words"), long.alias("places")).filter(F.size("places") > 0)
    parts = F.array_distinct(F.flatten(F.transform("places", lambda i: _parts(F.get("words", i)))))
    rows = rows.withColumn("parts", parts).withColumn("lowered", _lowered(F.col("words")))
    rows = rows.withColumn("known", F.array_intersect("parts", "lowered"))
    rows = rows.withColumn("twice", F.array_intersect("known", _repeated(F.col("lowered"))))

    def around(i: Column) -> Column:
        word = lambda shift: F.coalesce(F.get("words", i + shift), F.lit(""))
        return F.struct(
            i.cast("long").alias("word_no"),
            F.concat_ws(" ", word(-3), word(-2), word(-1)).alias("before"),
            word(0).alias("word"),
            word(1).alias("after"),
            F.array_intersect(_parts(word(0)), F.col("known")).alias("known"),
            F.array_intersect(_parts(word(0)), F.col("twice")).alias("twice"),
            F.concat_ws(" ", word(-2), word(-1), word(0)).alias("near"),
        )

    rows = rows.select("doc_id", F.inline(F.transform("places", around)))
    rows = rows.withColumn("assigned", F.regexp_extract_all("near", F.lit(_ASSIGNED), 3))
    # Runs within an assigned value are no candidates of their own.
    runs = F.filter(
        F.regexp_extract_all("word", F.lit(_CANDIDATE), 0),
        lambda run: run.rlike(r"[0-9]|[a-z][A-Z]")
        & ~F.exists("assigned", lambda value: F.contains(value, F.regexp_replace(run, r"[.]+$", ""))),
    )
    rows = rows.withColumn("candidate", F.explode(F.array_distinct(F.concat("assigned", runs))))
    return rows.drop("near", "assigned")


def _removed(value: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(value, pattern, ""))


def with_features(rows: DataFrame) -> DataFrame:
    """Rows of `before`, `word`, `after`, `known`, `twice`, `candidate` with the columns FEATURES."""
    candidate, size = F.col("candidate"), F.length("candidate")
    kinds = reduce(
        lambda value, step: F.regexp_replace(value, *step),
        [("[0-9]", "0"), ("[a-z]", "a"), ("[A-Z]", "A"), ("[^0aA]", "-")],
        candidate,
    )
    runs = F.length(F.regexp_replace(kinds, r"(.)\1*", "x"))
    # A word of the document that is the candidate alone covers it only if it is there again.
    dictionary = F.concat(
        F.array(*map(F.lit, _WORDS)), "twice", F.array_remove("known", F.lower("word"))
    )
    covered = F.length(F.concat_ws("", F.array_intersect(_parts(candidate), dictionary)))
    named = F.concat_ws(" ", "before", "word")
    head = F.call_function("substring_index", F.col("word"), F.col("candidate"), F.lit(1))
    features = {
        "length": size,
        "marks": 1 - _removed(candidate, "[^A-Za-z0-9]") / size,
        "vowels": 1 - _removed(candidate, "(?i)[aeiou]") / size,
        "changes": (runs - 1) / size,
        "digits": 1 - _removed(candidate, "[0-9]") / size,
        "uppers": 1 - _removed(candidate, "[A-Z]") / size,
        "distinct": F.size(F.array_distinct(F.split("candidate", ""))) / size,
        "hexadecimal": candidate.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "numeric": candidate.rlike(r"^[0-9.\-/]+$"),
        "coverage": covered / size,
        "path": candidate.rlike(r"(/[A-Za-z0-9_.\-]+){2}|\.[a-z]{2,4}$|\.[a-z]+[/.]") | F.col("word").rlike("://|@"),
        "prefixed": candidate.rlike(r"^(AKIA|ASIA|gh[pousr]_|glpat-|sk[-_]|pk_|xox[abpr]-|AIza|eyJ)"),
        "assigned": F.concat(F.element_at(F.split("before", " "), -1), head).rlike(r"[=:]\s*[\"'`]?$"),
        "quoted": head.rlike("[\"'`]$"),
        "key_near": named.rlike(_KEY_WORDS),
        "key_before": F.concat_ws(" ", F.slice(F.split("before", " "), -2, 2), head).rlike(_KEY_WORDS),
        "hash_before": named.rlike(r"(?i)\b(commit|sha-?1|sha-?256|md5|checksum|digest|revision|etag|uuid|isbn)\b"),
    }
    return rows.withColumns({name: value.cast("double") for name, value in features.items()})


def sampled_texts(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """About `sample` distinct whole texts, chosen by their hashes."""
    rows = docs.filter("text is not null").select("text")
    share = sample / max(sample, rows.select(F.xxhash64("text")).distinct().count())
    place = F.pmod(F.xxhash64("text", F.lit("secrets")), F.lit(1 << 30))
    return rows.filter(place < int(share * (1 << 30))).distinct()


def labelled_findings(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """Labelled findings made from `sampled_texts`.

    Every sampled text gives a key or a false positive of each kind below, drawn from a
    digest of its text, between words of its own.
    """
    rows = sampled_texts(docs, sample).select(
        F.split("text", _SPLIT).alias("words"),
        F.sha2("text", 512).alias("hex"),
        F.md5("text").alias("md5"),
        F.base64(F.unhex(F.sha2("text", 512))).alias("b64"),
        F.conv(F.substring(F.sha2("text", 256), 1, 15), 16, 10).alias("number"),
        F.pmod(F.xxhash64("text"), F.lit(6)).cast("int").alias("draw"),
    )
    own = [F.coalesce(F.get("words", F.lit(i)), F.lit("text")) for i in range(5)]
    plain = F.concat_ws(" ", *own[:3])
    name = F.get(F.array(*map(F.lit, ["token", "secret", "api_key", "password", "ACCESS_KEY", "auth_token"])), "draw")
    equals, colon = F.concat_ws(" ", own[0], name, F.lit("=")), F.concat_ws(" ", own[0], own[1], F.concat(name, F.lit(":")))
    quote, none = F.lit('"'), F.lit("")
    random = F.regexp_replace(F.substring("b64", 1, 32), "[+/=]", "x")
    letters = F.concat(*[F.lower(F.regexp_replace(w, "[^A-Za-z]", "")) for w in own])
    # Short values: letters of one case, letters and digits, with marks; and a longer word of the text.
    size = F.lit(SHORT) + F.pmod(F.xxhash64("hex"), F.lit(8)).cast("int")
    low = F.lower(F.regexp_replace("b64", "[^A-Za-z]", ""))
    marked = F.translate(F.regexp_replace("b64", "[+/=]", "!"), "AbCdEfGh", "!@#$%&*?")
    usual = F.coalesce(F.get(F.filter("words", lambda w: w.rlike("^[A-Za-z]{8,}$")), F.lit(0)), F.lit("required"))
    assign, then = F.concat(name, F.lit("=")), F.concat_ws(" ", own[0], own[1], F.concat(name, F.lit(":")))
    kinds = [
        # before, what stands before the candidate in its word, candidate, label
        (equals, quote, F.substring("hex", 1, 40), 1),
        (equals, quote, F.substring("hex", 1, 64), 1),
        (colon, none, F.col("md5"), 1),
        (equals, quote, random, 1),
        (colon, quote, F.substring("b64", 3, 43), 1),
        (plain, F.concat(name, F.lit("=")), random, 1),
        (plain, none, F.concat(F.lit("AKIA"), F.upper(F.substring("md5", 1, 16))), 1),
        (plain, none, F.concat(F.lit("ghp_"), random), 1),
        (F.concat_ws(" ", own[0], F.lit("Authorization:"), F.lit("Bearer")), none, F.substring("b64", 1, 40), 1),
        (plain, assign, F.substring(random, F.lit(1), size), 1),
        (plain, assign, F.substring(marked, F.lit(1), size), 1),
        (then, none, F.substring(marked, F.lit(5), size), 1),
        (then, quote, F.substring(marked, 9, 28), 1),
        (equals, quote, F.substring(low, F.lit(1), size), 1),
        (plain, assign, F.substring(low, 9, 24), 1),
        (then, none, F.upper(F.substring(low, F.lit(4), size)), 1),
        (then, none, usual, 0),
        (plain, assign, usual, 0),
        (equals, quote, F.lit("password"), 0),
        (then, none, F.lit("required"), 0),
        (plain, assign, F.lit("xxxxxxxx"), 0),
        (plain, assign, F.lit("********"), 0),
        (plain, assign, F.lit("${PASSWORD}"), 0),
        (equals, quote, F.lit("your-password"), 0),
        (F.concat_ws(" ", own[0], own[1], F.lit("commit")), none, F.substring("hex", 1, 40), 0),
        (F.concat_ws(" ", own[0], own[1], F.lit("sha256")), none, F.substring("hex", 1, 64), 0),
        (F.concat_ws(" ", own[0], F.lit("md5"), F.lit("=")), quote, F.col("md5"), 0),
        (plain, none, F.rpad("number", 16, "7"), 0),
        (plain, none, F.rpad("number", 19, "3"), 0),
        (plain, F.lit("no."), F.concat(F.substring("number", 1, 4), F.lit("-0000-1111-2222")), 0),
        (plain, F.concat(own[3], F.lit("@")), F.concat(F.lit("mail"), F.substring("number", 1, 1), F.lit(".example.com")), 0),
        (plain, none, F.concat(letters, F.lit("."), F.substring("number", 1, 3)), 0),
        (plain, none, F.concat(letters, F.substring("number", 1, 2)), 0),
        (plain, F.lit("https://"), F.concat(F.lit("www.example.com/"), letters, F.lit("/"), F.substring("md5", 1, 12)), 0),
        (plain, none, F.concat(F.lit("/usr/share/"), letters, F.lit("-1.2.3/index.html")), 0),
        (plain, none, F.concat(F.lit("2024-01-02T03:04:"), F.substring("number", 1, 2)), 0),
        (equals, quote, F.concat(F.lit("your_"), F.lower(name), F.lit("_here_123456")), 0),
        (equals, quote, F.lit("xxxxxxxxxxxxxxxxxxxx0000"), 0),
        (equals, quote, F.lit("example-password-1234"), 0),
    ]
    finding = F.explode(
        F.array(
            *[
                F.struct(
                    before.alias("before"),
                    F.concat(head, candidate, F.when(head == quote, quote).otherwise(none)).alias("word"),
                    own[4].alias("after"),
                    candidate.alias("candidate"),
                    F.lit(label).alias("label"),
                )
                for before, head, candidate, label in kinds
            ]
        )
    )
    rows = rows.withColumn("lowered", _lowered(F.col("words"))).withColumn("repeated", _repeated(F.col("lowered")))
    rows = rows.select("lowered", "repeated", finding.alias("finding")).select("lowered", "repeated", "finding.*")
    parts = _parts(F.col("word"))
    rows = rows.withColumn("known", F.array_intersect(parts, "lowered"))
    rows = rows.withColumn("twice", F.array_intersect(parts, "repeated")).drop("lowered", "repeated")
    assigned = F.concat_ws(" ", "before", "word").rlike(_ASSIGNED)
    return rows.filter(F.col("candidate").rlike(f"^{_CANDIDATE}$") | assigned)


def train_forest(findings: DataFrame) -> RandomForestClassificationModel | None:
    """A forest from labelled findings; none without findings of both labels.

    It is written and read back: the fitted one holds its training summary, and with it the session,
    which cannot be sent to tasks once the session has observed a write.
    """
    spark, folder = findings.sparkSession, scratch_dir(findings.sparkSession, "forest")
    rows = with_features(findings).select(*FEATURES, F.col("label").cast("double").alias("label"))
    # Every pass of the training reads the features written here.
    rows.write.parquet(f"{folder}/features")
    rows = spark.read.schema(rows.schema).parquet(f"{folder}/features")
    if rows.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", "label")
    RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=9, subsamplingRate=0.8).fit(rows).save(f"{folder}/model")
    return RandomForestClassificationModel.load(f"{folder}/model")


def find_secrets(
    docs: DataFrame, forest: RandomForestClassificationModel | None, threshold: float = 0.5
) -> DataFrame:
    """Candidates that the forest takes for secrets.

    docs: `doc_id`, `text`; other columns are ignored. One row for each: `doc_id`, `word_no`
    (place among the text's words, from 0), `candidate`, `score` (0 to 1, at least
    threshold). Without a forest every candidate stays, with score 1. Null and empty texts
    have none; repeated rows are reported each; null ids are kept. Whole texts are searched.
    """
    rows = _context(docs)
    if forest is None:
        return rows.select("doc_id", "word_no", "candidate", F.lit(1.0).alias("score"))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    rows = PipelineModel([assembler, forest]).transform(with_features(rows))
    score = F.get(vector_to_array("probability"), F.lit(1))
    rows = rows.select("doc_id", "word_no", "candidate", score.alias("score"))
    return rows.filter(F.col("score") >= threshold)


def redact(docs: DataFrame, secrets: DataFrame) -> DataFrame:
    """The documents, with all their columns, each secret found in a document's text replaced there.

    `n_chars`, where there is one, follows the text. Documents without findings are unchanged.
    """
    found = secrets.groupBy(F.col("doc_id").alias("_found_id")).agg(F.array_sort(F.collect_set("candidate")).alias("_found"))
    rows = docs.join(found, docs["doc_id"].eqNullSafe(found["_found_id"]), "left")
    by_length = F.array_sort("_found", lambda a, b: F.length(b) - F.length(a))
    clean = F.aggregate(by_length, F.col("text"), lambda text, one: F.replace(text, one, F.lit(REPLACEMENT)))
    changed = {"text": F.when(F.col("_found").isNotNull(), clean).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("_found").isNotNull(), F.length(clean).cast(kind)).otherwise(F.col("n_chars"))
    return rows.withColumns(changed).select(*docs.columns)
