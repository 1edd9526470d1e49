"""The pipeline's stages, each on what the one before kept."""

import random
import re

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as P
from storeledger.llm.packing import tokenizer_path
from storeledger.llm.queries import QUERIES
from test_decontaminate import plain_tiles
from test_jaccard_join import LOWER, shingles

SF = "/root/testdata/sf0.001"


def test_registered():
    assert [name for name in QUERIES] == sorted(QUERIES, key=lambda n: (n == "pipeline", int(n[2:].split("_")[0]) if n != "pipeline" else 0))
    assert len(QUERIES) == 14


def test_stages(spark, tmp_path):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    extra = rows.limit(1).selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars")
    junk = spark.createDataFrame([(10**6, "12 34 5678", "en", "s", 10), (10**6 + 1, None, None, None, None)], rows.schema)
    rows = rows.unionByName(rows.filter("doc_id < 3")).unionByName(extra).unionByName(junk)
    kept = {}
    for name, stage in P.STAGES:
        out = str(tmp_path / name)
        stage(spark, rows, SF).write.parquet(out)
        result = spark.read.parquet(out)
        kept[name] = {r["doc_id"] for r in result.select("doc_id").collect()}
        if name != "packing":
            assert result.columns == rows.columns
        rows = result
    assert not kept["language"] & {10**6, 10**6 + 1} and None in kept["language"]
    assert kept["near_duplicates"] < kept["language"] and None in kept["near_duplicates"]
    assert kept["decontamination"] < kept["near_duplicates"]
    assert kept["secrets"] == kept["decontamination"] == kept["packing"]


def test_empty_tables(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, rows, SF).count() == 0


def test_texts_under_one_id(spark):
    """A text of its own is kept under an id whose other text repeats another document's."""
    words = lambda start: " ".join(f"w{i}" for i in range(start, start + 60))
    rows = [(3, words(0)), (5, words(0)), (5, words(500)), (5, words(500)), (7, words(500) + " more"), (8, ""), (None, words(0))]
    frame = spark.createDataFrame([(d, t, {"a": 1}) for d, t in rows], "doc_id long, text string, key map<string, int>")
    near_duplicates = dict(P.STAGES)["near_duplicates"]
    got = near_duplicates(spark, frame, SF)
    assert got.columns == frame.columns
    found = sorted(((r["doc_id"] or 0, r["text"]) for r in got.collect()))
    assert found == sorted([(3, words(0)), (5, words(500)), (8, ""), (0, words(0))])


# A plain version of the stages after the language: groups by all pairs, tiles by all places, texts by the tokenizer.


def plain_groups(rows):
    """Of each group of similar texts the least id, of equal rows one."""
    texts = sorted({(d, t) for d, t in rows if d is not None}, key=lambda r: (r[0], r[1] or ""))
    sets = [shingles(t) for _, t in texts]
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 80 * len(x | sets[j]):
                low, high = sorted((top(i), top(j)))
                parent[high] = low
    return [r for i, r in enumerate(texts) if top(i) == i] + [r for r in rows if r[0] is None]


def plain_words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").translate(LOWER))


def plain_clean(text, items):
    words = plain_words(text)
    for item in filter(None, map(plain_words, items)):
        least = min(5, len(item))
        grams = {tuple(item[i : i + least]) for i in range(len(item) - least + 1)}
        if any(tuple(words[i : i + least]) in grams for i in range(len(words) - least + 1)):
            if 2 * sum(plain_tiles(words, item, least)) >= len(item):
                return False
    return True


def test_run_like_plain_version(spark, tmp_path):
    rng = random.Random(12)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars < 1500").collect()]
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").limit(12).collect()]
    longest = [t.split() for _, t in rows if len(t.split()) > 40]
    for i in range(30):
        words = list(rng.choice(longest))
        words[rng.randrange(len(words))] = "changed"
        rows.append((10_000 + i, " ".join(words)))
        rows.append((20_000 + i, " ".join(rng.choice(longest)[:30]) + " " + rng.choice(items)))
    rows += [(5, rows[7][1]), (None, rows[9][1]), rows[3], (30_000, "12 34"), (30_001, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    frame = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], schema)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stages = dict(P.STAGES)
    spoken = [(r["doc_id"], r["text"]) for r in stages["language"](spark, frame, str(tmp_path)).collect()]
    want = [(d, t) for d, t in plain_groups(spoken) if plain_clean(t, items)]
    assert len(rows) > len(spoken) > len(want) > 20
    # The secrets found by the stage itself; all else of a text stays.
    clean = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in want], schema)
    want = [(r["doc_id"], r["text"]) for r in stages["secrets"](spark, clean, str(tmp_path)).collect()]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = sorted((d or -1, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for d, t in want)
    pieces = {}
    for r in P.run(spark, str(tmp_path)).collect():
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], bytes(r["ids"])))
    got = sorted((d or -1, b"".join(part for _, part in sorted(own))) for (d, _), own in pieces.items())
    assert got == ids
