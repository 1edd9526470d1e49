"""License scan against a plain search, and its spans on altered notices."""

import random
import re

from storeledger.llm.license_scan import COVERAGE, DRIFT, NOTICE, TEMPLATES, Template, license_scan, spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLUMNS = "n_words n_base first_word last_word base_labels labels score".split()


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_spans(words, template):
    """Start and coverage of each span, by a search of every gram at every place."""
    diagonals = {}
    for word in range(len(words)):
        for at, gram in template.places():
            if words[word : word + template.k] == gram:
                diagonals.setdefault(word - at, {})[at] = word
    merged, last = [], None
    for diagonal in sorted(diagonals):
        if last is None or diagonal - last > (0 if template.base else DRIFT):
            merged.append({})
        for at, word in diagonals[diagonal].items():
            merged[-1][at] = min(word, merged[-1].get(at, word))
        last = diagonal
    held = lambda places: len({at + i for at in places for i in range(template.k)})
    return [(min(places.values()), held(places) / len(template.words)) for places in merged]


def plain(text):
    words, base, every = plain_words(text), [], []
    for template in TEMPLATES:
        for start, share in plain_spans(words, template):
            if share >= (1 if template.base else COVERAGE):
                every.append((template.label, share))
                if template.base:
                    base.append((template.label, start))
    joined = lambda labels: ",".join(sorted(set(labels)))
    starts = [s for _, s in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None), joined(x for x, _ in base),
        joined(x for x, _ in every), max((x for _, x in every), default=0.0),
    )


def answers(spark, texts, more=False):
    frame = spark.createDataFrame(list(texts), "doc_id long, text string")
    if more:
        frame = frame.selectExpr("doc_id", "text", "1 AS word", "map('a', 1) AS template", "'x' AS gram")
    return [tuple(r[c] for c in ["doc_id", *COLUMNS]) for r in license_scan(frame).collect()]


def same(got, texts):
    key = lambda r: (r[0] is None, r[0] or 0, str(r))
    assert sorted(got, key=key) == sorted([(i, *plain(t)) for i, t in texts], key=key)


def test_edges(spark):
    texts = [
        (1, None), (2, ""), (3, " .,;\n"), (None, "cc"), (None, "CC BY"), (5, "CC-BY cc.by ccby CC BY"), (6, "x " * 20_000 + "cc by"),
        (7, "All rights reserved. " * 500), (7, "All rights reserved. " * 500), (8, "GNU General Public  License, general public"),
        (9, "cc cc by by cc by"), (10, "by cc"), (11, "ℬcc by K"), (12, "ALL RIGHTS\tRESERVED\x00all rights"),
    ]
    same(answers(spark, texts, more=True), texts)


def test_empty_table(spark):
    assert answers(spark, []) == []


def test_altered_notices(spark):
    draw, texts = random.Random(7), []
    for i in range(300):
        words = ["so"] * draw.randrange(5)
        for _ in range(draw.randrange(1, 4)):
            own = list(draw.choice(TEMPLATES).words)
            for _ in range(draw.randrange(4)):
                at = draw.randrange(len(own) + 1)
                change = draw.randrange(3)
                if change == 0:
                    own.insert(at, "new")
                elif own and change == 1:
                    own.pop(min(at, len(own) - 1))
                elif own:
                    own[min(at, len(own) - 1)] = "Other"
            words += own + ["and"] * draw.randrange(3)
        texts.append((i, draw.choice([" ", ", ", "\n"]).join(words).title() if draw.random() < 0.5 else " ".join(words)))
    same(answers(spark, texts), texts)


def test_words_put_in_join_diagonals(spark):
    notice = next(t for t in TEMPLATES if t.label == "bsd" and len(t.words) > 15)
    words = list(notice.words)
    words[10:10] = ["very", "much"]
    frame = spark.createDataFrame([(1, "x y " + " ".join(words))], "doc_id long, text string")
    found = [r for r in spans(frame, [notice]).collect() if r["template"] is not None]
    assert [(r["start"], r["coverage"]) for r in found] == [(2, 1.0)]
    assert plain_spans(plain_words(f"x y {' '.join(words)}"), notice) == [(2, 1.0)]


def test_templates_fit_their_masks(spark):
    assert all(NOTICE < len(t.words) <= 60 or t.base for t in TEMPLATES)
    frame = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for text in ("one", " ".join(["w"] * 61)):
        try:
            license_scan(frame, [Template("x", text, True)])
            raise AssertionError(text)
        except ValueError:
            pass


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, "a")], "doc_id long, text string").filter("doc_id > 0")
    plan = license_scan(frame)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", plan)
