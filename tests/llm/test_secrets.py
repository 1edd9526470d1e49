"""Secret scan: planted keys are found, look-alikes are not; native plans; redaction."""

import hashlib
import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from storeledger.llm import secrets as S

SF = "/root/testdata/sf0.01"
HEX = hashlib.sha1(b"one").hexdigest()
MIXED = "q7Rz0LmX2vKc9TbY4nWd8JsH1gPf5AeU"
CASES = [
    (1, f'some words token = "{HEX}" and more', [HEX]),
    (2, f"set api_key={MIXED} now", [MIXED]),
    (3, "card 4929963689861572 and 9739312764672899", []),
    (4, "mail mailto me.09@mail2.example.com or https://www.example.com/docs/page12.html", []),
    (5, f"see commit {HEX} of the day", []),
    (6, 'password = "your_password_here_123456"', []),
    (7, None, []),
    (8, "", []),
    (9, "plain words only " * 5000 + f'secret: "{MIXED}"', [MIXED]),
    (None, f'token = "{HEX}"', [HEX]),
    (1, f'some words token = "{HEX}" and more', [HEX]),
]


@pytest.fixture(scope="module")
def forest(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return S.train_forest(S.labelled_findings(docs, 300))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, len(t or ""), 0.0) for d, t, _ in CASES], "doc_id long, text string, n_chars int, score double")


def test_findings(spark, docs, forest):
    rows = S.find_secrets(docs, forest).collect()
    assert sorted((r["doc_id"] or 0, r["candidate"]) for r in rows) == sorted((d or 0, c) for d, _, found in CASES for c in found)
    assert next(r["word_no"] for r in rows if r["doc_id"] == 9) == 15_001
    assert all(0.5 <= r["score"] <= 1 for r in rows)


def test_after_an_observed_write(spark, docs, tmp_path):
    """The trained forest reaches the tasks also of a session that has observed a write."""
    seen = Observation("rows")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(str(tmp_path / "seen"))
    assert seen.get == {"n": 3}
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(100)
    assert S.find_secrets(docs, S.train_forest(S.labelled_findings(table, 100))).count() >= 0


def test_planted_keys(spark, forest):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = {(r["doc_id"], k) for r in table.collect() for k in re.findall(r'(?i)token = "([0-9a-f]{40})"', r["text"])}
    got = {(r["doc_id"], r["candidate"]) for r in S.find_secrets(table, forest).collect()}
    assert want == got and len(want) > 5


SHORT = [
    ("the password=Tr0ub4dor3 of the host", "Tr0ub4dor3"),
    ("log in with pwd:k9$Lw!2z now", "k9$Lw!2z"),
    ('my secret: "qzxvkwpjtr" here', "qzxvkwpjtr"),
    ('an api_key = "aB3$kL9!mN2@pQ7&rS5%tU1#" there', "aB3$kL9!mN2@pQ7&rS5%tU1#"),
    ("set token=zkqwxvbnmrtplkjhgfds and go", "zkqwxvbnmrtplkjhgfds"),
    ("a password: Xk8rQ2mv. Then more", "Xk8rQ2mv"),
    ("the secret: everything is in the garden and everything is well", None),
    ('a password = "password" is bad', None),
]


def test_short_and_marked_values(spark, forest):
    table = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(SHORT)], "doc_id long, text string")
    got = {(r["doc_id"], r["candidate"]) for r in S.find_secrets(table, forest).collect()}
    assert got == {(i, key) for i, (_, key) in enumerate(SHORT) if key}
    for r in S.redact(table, S.find_secrets(table, forest)).collect():
        key = SHORT[r["doc_id"]][1]
        assert (key is None) == ("[SECRET]" not in r["text"]) and (key is None or key not in r["text"])


def test_native_plan(spark, docs, forest):
    plan = S.redact(docs, S.find_secrets(docs, forest))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_redaction(spark, docs, forest):
    clean = S.redact(docs, S.find_secrets(docs, forest))
    assert clean.columns == docs.columns and clean.count() == len(CASES)
    for r in clean.collect():
        text = r["text"]
        assert text is None or (HEX not in text or r["doc_id"] == 5) and MIXED not in text
        assert r["n_chars"] == len(text or "")
    assert next(r["text"] for r in clean.collect() if r["doc_id"] == 2) == "set api_key=[SECRET] now"


def test_sample_is_of_distinct_whole_texts(spark):
    texts = ["one text many times"] * 200 + [f"text {i} " + "of words " * 200 for i in range(20)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = S.sampled_texts(table, 21).groupBy("text").count().collect()
    assert {r["text"] for r in rows} == set(texts) and max(r["count"] for r in rows) < 100


def test_without_findings(spark, docs):
    assert S.train_forest(S.labelled_findings(docs.limit(0))) is None
    assert S.find_secrets(docs, None).filter("doc_id = 3").count() == 2
    assert S.find_secrets(docs.limit(0), None).count() == 0
    assert S.redact(docs.limit(0), S.find_secrets(docs, None)).count() == 0


def plain_candidates(text):
    """Word number and candidate, by every pattern on every word."""
    words, found = re.split(r"[\x20\x09-\x0D]+", text or ""), set()
    for i, word in enumerate(words):
        near = " ".join([words[j] if j >= 0 else "" for j in (i - 2, i - 1, i)])
        values = [m.group(3) for m in re.finditer(S._ASSIGNED, near)] if len(word) >= S.SHORT else []
        if values or len(word) >= S.LEAST and re.search("[0-9]|[a-z][A-Z]", word):
            runs = [m.group() for m in re.finditer(S._CANDIDATE, word)]
            runs = [r for r in runs if re.search("[0-9]|[a-z][A-Z]", r) and not any(r.rstrip(".") in v for v in values)]
            found |= {(i, c) for c in values + runs}
    return found


def test_candidates_like_plain_version(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = table.collect() + [(10**6 + i, t) for i, (_, t, _) in enumerate(CASES)] + [(10**7 + i, t) for i, (t, _) in enumerate(SHORT)]
    frame = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string").repartition(4)
    got = {}
    for r in S._context(frame).select("doc_id", "word_no", "candidate").collect():
        got.setdefault(r["doc_id"], set()).add((r["word_no"], r["candidate"]))
    want = {i: c for i, t in map(tuple, rows) if (c := plain_candidates(t))}
    assert got == want and len(want) > 50


def test_dictionary_of_a_document(spark):
    """Letter runs of a candidate's word that are words of its document, once or twice and more."""
    text = "key key Word other alpha-beta9/gamma42 beta x alphakey=aKEYword123456789 Other"
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string").filter("doc_id > 0")
    found = {r["word_no"]: (r["known"], r["twice"]) for r in S._context(rows).collect()}
    assert found[4] == (["beta"], [])
    assert set(found) == {4, 7} and found[7] == ([], [])
    many = spark.createDataFrame([(1, " ".join(f"a{i}b-key{i}Xy/zz-word" for i in range(3000)) + " word word key")], rows.schema)
    rows = S._context(many)
    assert "words" not in rows.columns and rows.count() == 3000
    assert rows.selectExpr("max(size(known))", "max(size(twice))").first()[:] == (2, 1)
